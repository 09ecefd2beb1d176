"""Table schemas of the price data model (bronze, audit, silver, recipes).

Column names follow the source data model so that existing tables can be
read as they are; operators take column names as arguments where it matters.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

S, D, TS = T.StringType(), T.DateType(), T.TimestampNTZType()
L, I, DB = T.LongType(), T.IntegerType(), T.DoubleType()
PRICE = T.DecimalType(18, 2)
QUANTITY = T.DecimalType(13, 3)
UNIT_PRICE = T.DecimalType(18, 4)


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


PRODUCT_CONFIG = _struct(("key", S), ("nombre", S), ("unidad", S), ("categoria", S),
                         ("urls", T.MapType(S, S)))

RAW_PAYLOAD = _struct(("corte", S), ("supermercado", S), ("url", S), ("payload", S))

BRONZE_PRICES = _struct(
    ("supermercado", S), ("nombre", S), ("descripcion", S), ("precio", S),
    ("categoria", S), ("unidad", S), ("url", S), ("fecha_extraccion", D),
    ("batch_id", S), ("ingestion_timestamp", TS), ("load_date", D))

ETL_LOGS = _struct(
    ("event_ts", TS), ("pipeline", S), ("source", S), ("status", S), ("batch_id", S),
    ("rows_read", L), ("rows_written", L), ("error_type", S), ("error_message", S),
    ("stacktrace", S))

SCRAPING_ERRORS = _struct(
    ("event_ts", TS), ("pipeline", S), ("source", S), ("batch_id", S), ("corte", S),
    ("supermercado", S), ("url", S), ("error_type", S), ("error_message", S))

RUN_METRICS = _struct(
    ("event_ts", TS), ("pipeline", S), ("source", S), ("batch_id", S),
    ("ingestion_timestamp", S), ("products_configured", L), ("urls_target", L),
    ("rows_success", L), ("rows_error", L), ("success_rate_pct", DB))

SILVER_PRICES = _struct(
    ("producto_id", S), ("supermercado", S), ("categoria", S), ("nombre", S),
    ("descripcion", S), ("url", S), ("precio_normalizado", PRICE), ("unidad", S),
    ("fecha_extraccion", D), ("fecha_actualizacion", TS))

SILVER_KEYS = ("producto_id", "fecha_extraccion")
# Columns a matched upsert refreshes; unit, store and name keep their first value.
SILVER_UPDATE_COLS = ("precio_normalizado", "descripcion", "url", "categoria",
                      "fecha_actualizacion")

# What a stored history keeps beside Silver's columns, so that a late row can be
# told from a newer one without reading Bronze again.
SILVER_STAMPS = ("ultima_ingesta", "ultimo_lote")

RECIPES = _struct(("receta", S), ("ingrediente", S), ("cantidad_necesaria", QUANTITY),
                  ("unidad_receta", S), ("rendimiento_porciones", I))


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partition_by: tuple[str, ...] = (), comment: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS over a parquet location (idempotent)."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    note = f" COMMENT '{comment}'" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet"
              f"{parts} LOCATION '{location}'{note}")
