import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators import ingest as I
from tillroll.operators import quality as Q
from tillroll.operators.change import price_change
from tillroll.sources.config import config_df, expand_targets, target_counts
from tillroll.sources.payload import parse_shop


def shop_payload(price, name):
    inner = json.dumps({"precioLista": price})
    return json.dumps({"contents": [{"Main": [{"record": {"attributes": {
        "sku.dtoPrice": [inner], "product.displayName": [name]}}}]}]})


def test_nested_payload_and_routing(spark):
    ts = dt.datetime(2026, 4, 10, 9, 0)
    raw = spark.createDataFrame(
        [("Bife", "StoreA", "http://a", shop_payload(14799.0, "Bife Americano x kg"), "Carnes", "kg"),
         ("Ajo", "StoreA", "http://b", "not json", None, None),
         ("Sal", "StoreA", "http://c", None, "Almacen", "gr")],
        "corte string, supermercado string, url string, payload string, categoria string, unidad string")
    parsed = parse_shop(raw)
    routed = I.with_status(I.stamp_batch(parsed, "batch-1", ts))
    bronze = I.bronze_rows(routed).collect()
    assert [(r.nombre, r.precio, r.descripcion, r.fecha_extraccion) for r in bronze] == [
        ("Bife", "14799.0", "Bife Americano x kg", dt.date(2026, 4, 10))]
    errors = I.error_rows(routed).collect()
    assert sorted((r.corte, r.error_type) for r in errors) == [("Ajo", "NoData"), ("Sal", "NoData")]
    m = I.run_metrics(routed).first()
    assert (m.urls_target, m.rows_success, m.rows_error, m.success_rate_pct) == (3, 1, 2, 33.33)
    ev = [r.status for r in I.run_events(I.run_metrics(routed)).collect()]
    assert ev == ["STARTED", "SUCCESS"]
    summary = I.summary_events(I.run_metrics(routed)).first()
    assert json.loads(summary.error_message)["rows_success"] == 1


def test_empty_batch_is_refused(spark):
    raw = spark.createDataFrame([("Ajo", "StoreA", "u", None, None, None)],
                                "corte string, supermercado string, url string, precio string, "
                                "descripcion string, categoria string")
    routed = I.with_status(I.stamp_batch(raw, "b", dt.datetime(2026, 4, 10)))
    ev = I.run_events(I.run_metrics(routed)).collect()
    assert [(r.status, r.error_type) for r in ev] == [("FAILED", "ValueError")]


def test_targets_and_defaults(spark):
    cfg = config_df(spark, [
        {"key": "a", "nombre": "Ajo", "urls": {"StoreA": "http://a"}},
        {"key": "b", "nombre": "Sal", "unidad": "gr", "categoria": "Almacen",
         "urls": {"StoreA": "http://b", "StoreB": "http://b2"}}])
    t = sorted(tuple(r) for r in expand_targets(cfg).collect())
    assert t[0] == ("a", "Ajo", "Sin unidad", "Sin Categoría", "StoreA", "http://a")
    c = target_counts(cfg).first()
    assert (c.products_configured, c.urls_target) == (2, 3)


def _silver(spark, rows):
    return spark.createDataFrame(rows, "producto_id string, supermercado string, nombre string, categoria string, "
                                       "precio_normalizado decimal(18,2), fecha_extraccion date, url string")


def test_price_change_half_up(spark):
    d = [dt.date(2026, 4, 10 + i) for i in range(3)]
    s = _silver(spark, [("p", "S", "n", "Carnes", Decimal(v), day, "http://u") for v, day in
                        zip(("100.00", "100.125", "99.00"), d)])
    got = [(r.cambio_diario, r.cambio_porcentual) for r in price_change(s).orderBy("fecha_extraccion").collect()]
    assert got == [(None, None), (Decimal("0.13"), Decimal("0.13")), (Decimal("-1.13"), Decimal("-1.13"))]


def test_quality_suite_and_null_counts(spark):
    day = dt.date(2026, 4, 10)
    s = _silver(spark, [("a", "S", "n", "c", Decimal("10"), day, "http://u"),
                        ("a", "S", "n", "c", Decimal("2000000"), day, "ftp://u"),
                        ("b", None, "m", None, Decimal("5"), day, None)])
    s = s.withColumn("fecha_actualizacion", F.lit(None).cast("timestamp_ntz"))
    suite = {r.test_name: (r.status, r.issues_found) for r in Q.suite(s, day).collect()}
    assert suite == {"TEST_1_DUPLICADOS": ("FAIL", 1), "TEST_2_NULLS": ("FAIL", 1),
                     "TEST_3_PRECIOS_INVALIDOS": ("FAIL", 1), "TEST_4_FRESHNESS": ("PASS", 3)}
    nulls = {r.campo: r.registros_nulos for r in Q.null_counts(s).collect()}
    assert nulls["supermercado"] == 1 and nulls["categoria"] == 1 and nulls["producto_id"] == 0
    assert Q.url_format(s).first().urls_invalidas == 1


def test_exploration_percent_text(spark):
    day = dt.date(2026, 4, 10)
    rows = [("S", "name", "d", "10", "c", "kg", "http://u", day, "b", dt.datetime(2026, 4, 10), day),
            ("S", "name", "d", "11", "c", "kg", "", day, "b", dt.datetime(2026, 4, 10), day),
            (None, "ab", "d", "12", "c", "kg", "http://u", day, "b", dt.datetime(2026, 4, 10), day)]
    from tillroll.schemas import BRONZE_PRICES
    b = spark.createDataFrame(rows, BRONZE_PRICES)
    got = {r.tipo_validacion: (r.registros_problema, r.porcentaje) for r in Q.exploration_summary(b).collect()}
    assert got["Registros con supermercado nulo"] == (1, "33.33%")
    assert got["Registros con URL inválida"] == (1, "33.33%")
    assert got["Registros duplicados"] == (2, "66.67%")
    assert got["Nombres muy cortos (<3 caracteres)"] == (1, "33.33%")
    assert len(got) == 7


def test_text_stamps_are_typed(spark):
    raw = spark.createDataFrame(
        [("Ajo", "StoreA", "u1", "100", None, None, None, "15-04-2026", "2026-04-15T09:30:00"),
         ("Sal", "StoreA", "u2", "200", None, None, None, "31-02-2026", "not a time")],
        "corte string, supermercado string, url string, precio string, descripcion string, categoria string, "
        "unidad string, fecha_extraccion string, ingestion_timestamp string")
    typed = I.typed_stamps(raw)
    routed = I.with_status(typed.withColumn("batch_id", F.lit("b")))
    got = sorted((r.nombre, r.fecha_extraccion, r.ingestion_timestamp) for r in I.bronze_rows(routed).collect())
    assert got == [("Ajo", dt.date(2026, 4, 15), dt.datetime(2026, 4, 15, 9, 30)), ("Sal", None, None)]
