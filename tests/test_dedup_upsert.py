import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators.dedup import latest_per_key
from tillroll.operators.upsert import merge_into_path, upsert, upsert_counts
from tillroll.plans.silver import silver_from_bronze
from tillroll.schemas import BRONZE_PRICES, SILVER_PRICES

T0 = dt.datetime(2026, 4, 10, 0, 0)


def bronze_rows(day: dt.date, n: int, price: str = "22499", hour: int = 10, unit: str = "kg", start: int = 0):
    return [("StoreA", f"prod{i}", f"desc{i}", price, "Carnes", unit, f"http://x/{i}", day, "b1",
             dt.datetime.combine(day, dt.time(hour)), day) for i in range(start, start + n)]


def test_latest_per_key_keeps_newest(spark):
    day = dt.date(2026, 4, 10)
    rows = [("StoreA", "Asado", "d", p, "Carnes", "kg", "u", day, "b", dt.datetime(2026, 4, 10, h, m), day)
            for p, h, m in (("21999", 10, 0), ("22499", 10, 30), ("21799", 10, 15))]
    s = silver_from_bronze(spark.createDataFrame(rows, BRONZE_PRICES), T0)
    got = s.collect()
    assert len(got) == 1 and got[0].precio_normalizado == Decimal("22499.00")


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "c")], "k int, t int, v string")
    out = latest_per_key(df, ["k"], [F.col("t").desc(), F.col("v").desc()])
    assert sorted((r.k, r.v) for r in out.collect()) == [(1, "b"), (2, "c")]


def _silver(spark, rows, now=T0):
    return silver_from_bronze(spark.createDataFrame(rows, BRONZE_PRICES), now)


def test_upsert_scenarios_pure(spark):
    d1, d2, d3 = dt.date(2026, 4, 10), dt.date(2026, 4, 11), dt.date(2026, 4, 12)
    empty = spark.createDataFrame([], SILVER_PRICES)
    t = upsert(empty, _silver(spark, bronze_rows(d1, 12)))
    assert t.count() == 12
    # re-run of the same day: 12 updates, still 12 rows, unit kept
    again = _silver(spark, bronze_rows(d1, 12, price="30000", unit="gr"), T0 + dt.timedelta(hours=1))
    counts = upsert_counts(t, again).first()
    assert (counts.updated, counts.inserted) == (12, 0)
    t = upsert(t, again)
    rows = t.collect()
    assert len(rows) == 12
    assert {r.precio_normalizado for r in rows} == {Decimal("30000.00")}
    assert {r.unidad for r in rows} == {"kg"}
    t = upsert(t, _silver(spark, bronze_rows(d2, 12)))
    assert t.count() == 24
    t = upsert(t, _silver(spark, bronze_rows(d3, 13)))
    assert t.count() == 37
    # a product missing from the source keeps its history
    t2 = upsert(t, _silver(spark, bronze_rows(d3, 5)))
    assert t2.count() == 37
    assert t2.where((F.col("nombre") == "prod12")).count() == 1


def test_merge_into_path_rewrites_only_touched_dates(spark, scratch):
    path = f"{scratch}/silver"
    d1, d2, d3 = dt.date(2026, 4, 10), dt.date(2026, 4, 11), dt.date(2026, 4, 12)
    merge_into_path(spark, _silver(spark, bronze_rows(d1, 12)), path)
    assert spark.read.parquet(path).count() == 12
    merge_into_path(spark, _silver(spark, bronze_rows(d1, 12, price="30000", unit="gr")), path)
    merge_into_path(spark, _silver(spark, bronze_rows(d2, 12)), path)
    merge_into_path(spark, _silver(spark, bronze_rows(d3, 13)), path)
    t = spark.read.parquet(path)
    assert t.count() == 37
    day1 = t.where(F.col("fecha_extraccion") == d1).collect()
    assert {r.precio_normalizado for r in day1} == {Decimal("30000.00")}
    assert {r.unidad for r in day1} == {"kg"}
    # idempotent re-run
    merge_into_path(spark, _silver(spark, bronze_rows(d3, 13)), path)
    assert spark.read.parquet(path).count() == 37


def test_merge_refuses_duplicate_source_keys(spark, scratch):
    import pytest
    s = _silver(spark, bronze_rows(dt.date(2026, 4, 10), 2))
    with pytest.raises(ValueError):
        merge_into_path(spark, s.unionByName(s), f"{scratch}/dup")


def test_full_refresh_leaves_only_the_source(spark, scratch):
    from tillroll.sources.sinks import save_table
    days = [dt.date(2026, 4, d) for d in (10, 11, 12)]
    path = f"{scratch}/silver"
    for d in days:
        merge_into_path(spark, _silver(spark, bronze_rows(d, 3)), path)
    merge_into_path(spark, _silver(spark, bronze_rows(days[1], 2)), path, full_refresh=True)
    assert [(r[0], r[1]) for r in spark.read.parquet(path).groupBy("fecha_extraccion").count().collect()] == [(days[1], 2)]
    out = f"{scratch}/table"
    for rows in ([(1, "a"), (2, "b")], [(3, "c")]):
        save_table(spark.createDataFrame(rows, "n int, part string"), out, ["part"])
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(3, "c")]


def test_null_dates_are_rejected_and_refused(spark, scratch):
    import pytest
    day = dt.date(2026, 4, 10)
    rows = bronze_rows(day, 2)
    rows.append((*rows[0][:7], None, *rows[0][8:]))
    assert _silver(spark, rows).count() == 2
    bad = _silver(spark, bronze_rows(day, 2)).withColumn("fecha_extraccion", F.lit(None).cast("date"))
    with pytest.raises(ValueError):
        merge_into_path(spark, bad, f"{scratch}/nulls")


def test_rejected_rows_hold_null_dates(spark, monkeypatch):
    from tillroll.plans import qa
    rows = bronze_rows(dt.date(2026, 4, 10), 2)
    rows.append((*rows[0][:7], None, *rows[0][8:]))
    monkeypatch.setattr(qa, "bronze_rows", lambda spark, base: spark.createDataFrame(rows, BRONZE_PRICES))
    assert [(r.nombre, r.reject_reason) for r in qa.rejected_rows(spark, "").collect()] == [(rows[0][1], "date_null")]


def test_touched_dates_prune_the_history_scan(spark, scratch):
    from tillroll.operators.upsert import touched_dates
    path = f"{scratch}/silver"
    days = [dt.date(2026, 4, d) for d in range(1, 9)]
    merge_into_path(spark, _silver(spark, [r for d in days for r in bronze_rows(d, 2)]), path)
    dates = touched_dates(_silver(spark, bronze_rows(days[3], 2)), "fecha_extraccion")
    read = spark.read.parquet(path).where(F.col("fecha_extraccion").isin(dates))
    files = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert {f.split("fecha_extraccion=")[1][:10] for f in files} == {"2026-04-04"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "2026-04-04" in plan.split("PartitionFilters:")[1].split("]")[0] or "fecha_extraccion" in plan.split("PartitionFilters:")[1][:120]


def test_only_a_missing_path_means_no_table(spark, scratch):
    import os

    import pytest
    from pyspark.errors import AnalysisException
    os.makedirs(f"{scratch}/empty")
    with pytest.raises(AnalysisException):
        merge_into_path(spark, _silver(spark, bronze_rows(dt.date(2026, 4, 10), 2)), f"{scratch}/empty")
