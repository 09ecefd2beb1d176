import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillroll.operators.quality import iqr_outliers
from tillroll.operators.upsert import merge_into_path
from tillroll.plans.daily import run_daily
from tillroll.plans.silver import silver_from_bronze
from tillroll.schemas import BRONZE_PRICES


def _payload(price, name):
    inner = json.dumps({"precioLista": price})
    return json.dumps({"contents": [{"Main": [{"record": {"attributes": {
        "sku.dtoPrice": [inner], "product.displayName": [name]}}}]}]})


def _raw(spark, prices):
    rows = [(n, "StoreA", f"http://s/{n}", _payload(p, f"{n} 1kg") if p is not None else None, "Almacen", u)
            for n, p, u in prices]
    return spark.createDataFrame(rows, "corte string, supermercado string, url string, payload string, "
                                       "categoria string, unidad string")


def test_two_daily_runs(spark, scratch):
    day1 = [("Ajo", 300.0, "unidad"), ("Sal Fina", 900.0, "kg"), ("Perejil", None, "unidad")]
    run_daily(spark, _raw(spark, day1), scratch, "b1", dt.datetime(2026, 4, 15, 9))
    day2 = [("Ajo", 330.0, "unidad"), ("Sal Fina", 950.0, "kg"), ("Perejil", 500.0, "unidad")]
    m = run_daily(spark, _raw(spark, day2), scratch, "b2", dt.datetime(2026, 4, 16, 9)).first()
    assert (m.rows_success, m.rows_error) == (3, 0)
    silver = spark.read.parquet(f"{scratch}/silver")
    assert silver.count() == 5
    summary = spark.read.parquet(f"{scratch}/gold/resumen_costos_recetas")
    assert {r.fecha_extraccion for r in summary.collect()} == {dt.date(2026, 4, 15), dt.date(2026, 4, 16)}
    # a re-run of day 2 with new prices updates in place
    day2b = [("Ajo", 340.0, "unidad"), ("Sal Fina", 950.0, "kg"), ("Perejil", 500.0, "unidad")]
    run_daily(spark, _raw(spark, day2b), scratch, "b3", dt.datetime(2026, 4, 16, 18))
    s = spark.read.parquet(f"{scratch}/silver")
    assert s.count() == 5
    ajo = s.where((F.col("nombre") == "Ajo") & (F.col("fecha_extraccion") == dt.date(2026, 4, 16))).first()
    assert float(ajo.precio_normalizado) == 340.0


@pytest.mark.parametrize("fetched", [[("Ajo", None, "unidad")], []])
def test_empty_run_is_logged_and_raised(spark, scratch, fetched):
    with pytest.raises(ValueError, match="tabla vac"):
        run_daily(spark, _raw(spark, fetched), scratch, "b1", dt.datetime(2026, 4, 15, 9))
    logs = spark.read.parquet(f"{scratch}/bronze_run/audit/etl_logs").collect()
    assert [(r.status, r.error_type) for r in logs] == [("FAILED", "ValueError")]
    assert "Traceback" in logs[0].stacktrace and "tabla vac" in logs[0].stacktrace
    m = spark.read.parquet(f"{scratch}/bronze_run/audit/run_metrics").collect()
    assert [(r.batch_id, r.urls_target, r.success_rate_pct) for r in m] == [("b1", len(fetched), 0.0)]


def test_configured_targets_count_when_not_fetched(spark, scratch):
    from tillroll.sources.config import config_df, expand_targets
    config = config_df(spark, [{"key": n, "nombre": n, "unidad": "kg", "categoria": "Almacen",
                                "urls": {"StoreA": f"http://s/{n}"}} for n in ("Ajo", "Sal Fina", "Perejil")])
    raw = _raw(spark, [("Ajo", 300.0, "kg"), ("Otro", 5.0, "kg")])
    m = run_daily(spark, raw, scratch, run_at=dt.datetime(2026, 4, 15, 9), targets=expand_targets(config)).first()
    assert (m.products_configured, m.urls_target, m.rows_success, m.rows_error, m.success_rate_pct) == (3, 3, 1, 2, 33.33)
    assert len(m.batch_id) == 36
    errors = spark.read.parquet(f"{scratch}/bronze_run/audit/scraping_errors").collect()
    assert {(r.corte, r.error_type) for r in errors} == {("Perejil", "NoData"), ("Sal Fina", "NoData")}


def _dated(spark, day, prices, loaded):
    """Bronze rows of ``day`` that a run loads at ``loaded``."""
    rows = [("StoreA", n, f"{n} 1kg", str(p), "Almacen", "kg", f"http://s/{n}", day, f"b{loaded:%Y%m%d%H}", loaded, loaded.date())
            for n, p in prices]
    return spark.createDataFrame(rows, BRONZE_PRICES)


def test_a_day_observed_after_its_load_day_arrives(spark, scratch):
    raw = _raw(spark, [("Ajo", 300.0, "kg")]).withColumn("fecha_extraccion", F.lit(dt.date(2026, 4, 16)))
    run_daily(spark, raw, scratch, "b1", dt.datetime(2026, 4, 15, 9))
    assert [r.fecha_extraccion for r in spark.read.parquet(f"{scratch}/silver").collect()] == [dt.date(2026, 4, 16)]


def test_gold_follows_silver_date_by_date(spark, scratch):
    """Runs in any order (late days, older rows of a known day, new products)
    leave the same Gold as building it whole, and read only touched dates."""
    from tillroll.operators.change import price_change
    from tillroll.operators.costing import catalogue, ingredient_costs, recipe_summary
    from tillroll.operators.maintain import partition_values
    from tillroll.plans.daily import refresh_gold
    from tillroll.schemas import SILVER_STAMPS
    from tillroll.sources.recipes import reference_recipes

    def files(table):
        return set(spark.read.parquet(f"{scratch}/gold/{table}").inputFiles())

    day = lambda d: dt.date(2026, 4, d)
    at = lambda d, h=9: dt.datetime(2026, 4, d, h)
    runs = [(day(1), [("Ajo", 100), ("Sal Fina", 50)], at(1)), (day(5), [("Ajo", 110)], at(5)), (day(9), [("Ajo", 120), ("Sal Fina", 55)], at(9)),
            (day(3), [("Ajo", 90), ("Perejil", 7)], at(10)),                  # a late day
            (day(9), [("Ajo", 999), ("Sal Fina", 56)], at(8)),                # an older row of a known day: no change
            (day(9), [("Sal Fina", 60)], at(11)), (day(12), [("Perejil", 8), ("Ajo", 121)], at(12))]
    recipes = reference_recipes(spark)
    for d, prices, loaded in runs:
        silver = silver_from_bronze(_dated(spark, d, prices, loaded), loaded, stamps=True)
        dates = merge_into_path(spark, silver, f"{scratch}/silver", newer_by=SILVER_STAMPS)
        before = files("evolucion_precios") if loaded != at(1) else set()
        refresh_gold(spark, scratch, dates, recipes)
        if loaded == at(10):  # the late day is written, and the 5th, where Ajo's next record is; nothing else
            gone = {f.split("fecha_extraccion=")[1][:10] for f in before - files("evolucion_precios")}
            assert gone == {"2026-04-05"}
    silver = spark.read.parquet(f"{scratch}/silver")
    assert partition_values(silver, "fecha_extraccion") == ["2026-04-01", "2026-04-03", "2026-04-05", "2026-04-09", "2026-04-12"]
    assert {(r.nombre, float(r.precio_normalizado)) for r in silver.where("fecha_extraccion = '2026-04-09'").collect()} == {
        ("Ajo", 120.0), ("Sal Fina", 60.0)}
    cat = catalogue(silver)
    costs = ingredient_costs(cat, recipes)
    whole = {"catalogo_productos": cat, "costos_recetas": costs, "resumen_costos_recetas": recipe_summary(costs),
             "evolucion_precios": price_change(silver)}
    for name, want in whole.items():
        got = spark.read.parquet(f"{scratch}/gold/{name}")
        columns = got.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(columns).collect())), name


def test_the_daily_merge_reads_only_its_batch(spark, scratch):
    for d in (14, 15):
        run_daily(spark, _raw(spark, [("Ajo", 300.0 + d, "kg")]), scratch, f"b{d}", dt.datetime(2026, 4, d, 9))
    bronze = spark.read.parquet(f"{scratch}/bronze_run/bronze")
    loaded = bronze.where((F.col("load_date") == dt.date(2026, 4, 15)) & (F.col("batch_id") == "b15"))
    assert {r[0].split("load_date=")[1][:10] for r in loaded.select(F.input_file_name()).collect()} == {"2026-04-15"}


def test_full_refresh_and_approx_percentiles(spark, scratch):
    day = dt.date(2026, 4, 10)
    rows = [("StoreA", f"p{i}", "d", str(10 + i), "c", "kg", "http://u", day, "b", dt.datetime(2026, 4, 10), day)
            for i in range(20)] + [("StoreA", "big", "d", "5000", "c", "kg", "http://u", day, "b",
                                    dt.datetime(2026, 4, 10), day)]
    s = silver_from_bronze(spark.createDataFrame(rows, BRONZE_PRICES), dt.datetime(2026, 4, 10))
    path = f"{scratch}/silver"
    merge_into_path(spark, s, path)
    merge_into_path(spark, s.where(F.col("nombre") == "big"), path, full_refresh=True)
    assert spark.read.parquet(path).count() == 1
    exact = [r.nombre for r in iqr_outliers(s, day).collect()]
    approx = [r.nombre for r in iqr_outliers(s, day, approx=True).collect()]
    assert exact == approx == ["big"]
