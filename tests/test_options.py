"""Operator options not exercised by the registered queries."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators import quality as Q
from tillroll.operators.change import price_change
from tillroll.operators.clean import rejected, with_price
from tillroll.schemas import BRONZE_PRICES


def test_max_gap_days_blanks_old_previous(spark):
    rows = [("p", Decimal("100.00"), dt.date(2026, 4, 1)), ("p", Decimal("110.00"), dt.date(2026, 4, 2)),
            ("p", Decimal("121.00"), dt.date(2026, 4, 20))]
    df = spark.createDataFrame(rows, "producto_id string, precio_normalizado decimal(18,2), fecha_extraccion date")
    got = [(r.cambio_diario, r.cambio_porcentual)
           for r in price_change(df, max_gap_days=1).orderBy("fecha_extraccion").collect()]
    assert got == [(None, None), (Decimal("10.00"), Decimal("10.00")), (None, None)]
    prev_record = [r.cambio_diario for r in price_change(df).orderBy("fecha_extraccion").collect()]
    assert prev_record == [None, Decimal("10.00"), Decimal("11.00")]


def test_rejected_limit_is_ordered(spark):
    rows = [(f"{i}x{i}", "S", None, "c") for i in range(30)]
    df = with_price(spark.createDataFrame(rows, "precio string, supermercado string, nombre string, categoria string"))
    got = [r.precio for r in rejected(df, limit=5, order_by=["precio"]).collect()]
    assert got == sorted(r[0] for r in rows)[:5]


def test_outlier_labels_per_row(spark):
    day = dt.date(2026, 4, 10)
    rows = [("S", f"n{i}", "d", str(100 + i), "c", "kg", "http://u", day, "b", dt.datetime(2026, 4, 10), day)
            for i in range(99)] + [("S", "huge", "d", "100000", "c", "kg", "http://u", day, "b",
                                    dt.datetime(2026, 4, 10), day)]
    labels = Q.outlier_labels(spark.createDataFrame(rows, BRONZE_PRICES))
    got = {r.nombre: r.precio_outlier for r in labels.collect()}
    assert got["huge"] == "OUTLIER_ALTO" and got["n0"] == "OUTLIER_BAJO" and got["n50"] == "PRECIO_NORMAL"
    assert labels.where(F.col("precio_outlier") == "OUTLIER_ALTO").count() == 1


def test_any_factor_and_scale(spark):
    from decimal import Decimal

    import pytest
    from pyspark.sql import functions as F

    from tillroll.operators.costing import _round_by
    from tillroll.operators.history import simulate_day
    day = dt.date(2026, 4, 10)
    silver = spark.createDataFrame([(Decimal("100.00"), day)], "precio_normalizado decimal(18,2), fecha_extraccion date")
    for factor, price in (("1.055", 105.5), ("12", 1200), ("0.05", 5)):
        assert float(simulate_day(silver, day, day, factor).first().precio_normalizado) == price
    scaled = spark.createDataFrame([(Decimal("2.34567"), s) for s in (0, 1, 2, 3, 4)], "x decimal(20,5), s int")
    got = [float(r[0]) for r in scaled.select(_round_by(F.col("x"), F.col("s"))).collect()]
    assert got == [2.0, 2.3, 2.35, 2.346, 2.3457]
    with pytest.raises(Exception, match="no such scale"):
        scaled.select(_round_by(F.col("x"), F.lit(30))).collect()
