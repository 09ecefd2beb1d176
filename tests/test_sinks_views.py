import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tillroll.operators import ingest as I
from tillroll.plans.views import register_views
from tillroll.schemas import ETL_LOGS, RUN_METRICS, SCRAPING_ERRORS, ensure_table
from tillroll.sources.payload import parse_shop
from tillroll.sources.recipes import REFERENCE_RECIPES, reference_recipes
from tillroll.sources.sinks import write_ingest_run


def _payload(price, name):
    inner = json.dumps({"precioLista": price})
    return json.dumps({"contents": [{"Main": [{"record": {"attributes": {
        "sku.dtoPrice": [inner], "product.displayName": [name]}}}]}]})


def _routed(spark, rows, batch, ts):
    raw = spark.createDataFrame(rows, "corte string, supermercado string, url string, payload string, "
                                      "categoria string, unidad string")
    parsed = parse_shop(raw)
    return I.with_status(I.stamp_batch(parsed, batch, ts))


def test_write_ingest_run_order_and_guard(spark, scratch):
    ok = _routed(spark, [("Bife", "StoreA", "u1", _payload(100.0, "Bife x kg"), "Carnes", "kg"),
                         ("Ajo", "StoreA", "u2", None, None, None)], "b1", dt.datetime(2026, 4, 10, 9))
    write_ingest_run(spark, ok, scratch)
    empty = _routed(spark, [("Sal", "StoreA", "u3", "{}", None, None)], "b2", dt.datetime(2026, 4, 11, 9))
    write_ingest_run(spark, empty, scratch)
    bronze = spark.read.parquet(f"{scratch}/bronze").collect()
    assert [(r.nombre, r.precio, r.batch_id) for r in bronze] == [("Bife", "100.0", "b1")]
    logs = spark.read.parquet(f"{scratch}/audit/etl_logs")
    got = sorted((r.batch_id, r.status) for r in logs.collect())
    assert got == [("b1", "STARTED"), ("b1", "SUCCESS"), ("b1", "SUMMARY"), ("b2", "FAILED")]
    errors = spark.read.parquet(f"{scratch}/audit/scraping_errors")
    assert sorted(r.corte for r in errors.collect()) == ["Ajo", "Sal"]
    metrics = spark.read.parquet(f"{scratch}/audit/run_metrics").collect()
    assert sorted((m.batch_id, m.success_rate_pct) for m in metrics) == [("b1", 50.0), ("b2", 0.0)]


def test_ensure_table_is_idempotent(spark, scratch):
    for name, schema in (("etl_logs", ETL_LOGS), ("scraping_errors", SCRAPING_ERRORS),
                         ("run_metrics", RUN_METRICS)):
        for _ in range(2):
            ensure_table(spark, f"t_{name}", schema, f"{scratch}/{name}")
        assert spark.table(f"t_{name}").schema.fieldNames() == schema.fieldNames()


def test_reference_recipes_and_views(spark):
    rec = reference_recipes(spark)
    assert rec.count() == 28 == len(REFERENCE_RECIPES)
    assert {r.receta: r.n for r in rec.groupBy("receta").agg(F.count("*").alias("n")).collect()} == {
        "Pizza": 10, "Empanadas": 11, "Milanesas": 7}
    assert rec.where(F.col("ingrediente") == "Ajo").select("cantidad_necesaria").first()[0] is not None
    silver = spark.createDataFrame(
        [("id1", "StoreA", "Verdura", "Ajo", "Ajo", "http://u", 300.0, "unidad", dt.date(2026, 4, 15))],
        "producto_id string, supermercado string, categoria string, nombre string, descripcion string, url string, "
        "precio_normalizado double, unidad string, fecha_extraccion date"
    ).withColumn("precio_normalizado", F.col("precio_normalizado").cast("decimal(18,2)"))
    register_views(spark, silver)
    got = spark.sql("SELECT receta, costo_total, comentarios FROM resumen_costos_recetas ORDER BY receta").collect()
    assert [(r.receta, float(r.costo_total), r.comentarios) for r in got] == [
        ("Milanesas", 300.0, "Porcion = 1 kg"), ("Pizza", 50.1, "Porcion = 1 pizza")]


def test_failed_load_is_logged_and_raised(spark, scratch):
    ok = _routed(spark, [("Bife", "StoreA", "u1", _payload(100.0, "Bife x kg"), "Carnes", "kg"),
                         ("Ajo", "StoreA", "u2", None, None, None)], "b1", dt.datetime(2026, 4, 10, 9))
    with open(f"{scratch}/bronze", "w") as blocker:  # a file where the table's folder should be
        blocker.write("x")
    with pytest.raises(Exception) as raised:
        write_ingest_run(spark, ok, scratch)
    logs = {r.status: r for r in spark.read.parquet(f"{scratch}/audit/etl_logs").collect()}
    assert set(logs) == {"STARTED", "FAILED"}
    failed = logs["FAILED"]
    assert failed.error_type == type(raised.value).__name__ and failed.error_message
    assert "write_ingest_run" in failed.stacktrace and (failed.rows_read, failed.rows_written) == (1, 0)
    assert [r.corte for r in spark.read.parquet(f"{scratch}/audit/scraping_errors").collect()] == ["Ajo"]


def test_error_kinds(spark):
    bad_price = _payload(1, "x").replace("precioLista", "precio")
    pages = [None, "", "{", "[1]", '{"contents": []}', bad_price, _payload(5, "x")]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, payload string")
    routed = I.with_status(parse_shop(rows), F.col("_fault"))
    got = [r.error_type for r in routed.orderBy("i").collect()]
    assert got == ["NoData", "NoData", "JSONDecodeError", "KeyError", "KeyError", "KeyError", None]
    # the page is parsed in one place, however many columns read it
    plan = I.error_rows(I.stamp_batch(routed.withColumns({c: F.lit("x") for c in ("corte", "supermercado", "url")}), "b",
                                      dt.datetime(2026, 4, 10)))._jdf.queryExecution().optimizedPlan().toString()
    assert len([line for line in plan.splitlines() if "payload#" in line and "arse" in line and "Generate" in line]) == 1, plan
