import datetime as dt

from tillroll.schemas import BRONZE_PRICES
from tillroll.streaming.silver_stream import read_bronze_stream, start_silver_stream


def _rows(day, n, price="100", hour=10):
    return [("StoreA", f"p{i}", "d", price, "Carnes", "kg", f"http://x/{i}", day, "b",
             dt.datetime.combine(day, dt.time(hour)), day) for i in range(n)]


def test_stream_upserts_each_arrival(spark, scratch):
    landing, silver, ckpt = f"{scratch}/landing", f"{scratch}/silver", f"{scratch}/ckpt"
    d1, d2 = dt.date(2026, 4, 10), dt.date(2026, 4, 11)
    spark.createDataFrame(_rows(d1, 12), BRONZE_PRICES).write.mode("append").parquet(landing)
    q = start_silver_stream(read_bronze_stream(spark, landing), silver, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(silver).count() == 12
    spark.createDataFrame(_rows(d1, 12, "120") + _rows(d2, 12), BRONZE_PRICES).write.mode("append").parquet(landing)
    q = start_silver_stream(read_bronze_stream(spark, landing), silver, ckpt)
    q.awaitTermination(120)
    t = spark.read.parquet(silver)
    assert t.count() == 24
    assert {r[0] for r in t.where(t.fecha_extraccion == d1).select("precio_normalizado").collect()} == {120}


def test_newest_row_wins_in_any_order(spark, scratch):
    landing, silver, ckpt = f"{scratch}/landing", f"{scratch}/silver", f"{scratch}/ckpt"
    day = dt.date(2026, 4, 10)
    for price, hour in (("200", 12), ("100", 8)):
        spark.createDataFrame(_rows(day, 3, price, hour), BRONZE_PRICES).write.mode("append").parquet(landing)
        start_silver_stream(read_bronze_stream(spark, landing), silver, ckpt).awaitTermination(120)
    assert {float(r.precio_normalizado) for r in spark.read.parquet(silver).collect()} == {200.0}
