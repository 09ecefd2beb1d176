"""Q2, Q17-Q21 and the ingest (A1-A13) over the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import day_start, iso_seconds, ntz_lit, ymd_text
from tillroll.operators import history as H
from tillroll.operators import ingest as I
from tillroll.operators.upsert import upsert, upsert_counts
from tillroll.plans import params as P
from tillroll.plans.silver import silver
from tillroll.sources.config import config_from_parts, expand_targets, target_counts
from tillroll.sources.feed import audit_events, nested_payloads, price_feed, raw_payloads
from tillroll.sources.payload import json_field, parse_shop
from tillroll.sources.tables import read_table


# ------------------------------------------------------------------ Q2
def _upsert_inputs(spark, base):
    s = silver(spark, base)
    target = s.where(F.col("fecha_extraccion") < F.lit(P.UPSERT_CUTOFF))
    source = (s.where(F.col("fecha_extraccion") >= F.lit(P.UPSERT_SOURCE_FROM))
               .withColumn("precio_normalizado", (F.col("precio_normalizado") + 1).cast("decimal(18,2)"))
               .withColumn("unidad", F.upper("unidad"))
               .withColumn("fecha_actualizacion",
                           ntz_lit(P.UPDATED_AT + dt.timedelta(days=1))))
    return target, source


def silver_upsert(spark: SparkSession, base: str) -> DataFrame:
    """Q2: history before the cutoff merged with a re-run from an earlier
    day (overlap updated, unit unchanged, new days inserted)."""
    target, source = _upsert_inputs(spark, base)
    return upsert(target, source)


def silver_upsert_counts(spark: SparkSession, base: str) -> DataFrame:
    target, source = _upsert_inputs(spark, base)
    return upsert_counts(target, source)


# ------------------------------------------------------------------ Q17, Q18, Q21
def bronze_rows(spark, base):
    return price_feed(spark, base, with_tie_break=False)


def row_count(spark, base):
    return H.row_count(silver(spark, base))


def history_profile(spark, base):
    return H.history_profile(silver(spark, base))


def rows_per_load(spark, base):
    return H.rows_per_load(bronze_rows(spark, base)).orderBy(F.col("load_date").desc(), "batch_id")


def top_prices(spark, base):
    return H.top_prices(silver(spark, base), P.AS_OF, P.TOP_N)


def merge_preview(spark, base):
    """Q18, all rows: current history plus the simulated day."""
    return H.merge_preview(silver(spark, base), P.PREVIEW_DAY, P.PREVIEW_NEXT, P.PREVIEW_FACTOR)


def merge_preview_top(spark, base):
    """Q18 as the source shows it: the first rows by (name, date); a top-k,
    planned per partition (no global sort of the history)."""
    return H.merge_preview(silver(spark, base), P.PREVIEW_DAY, P.PREVIEW_NEXT, P.PREVIEW_FACTOR,
                           limit=P.PREVIEW_ROWS)


def product_listing(spark, base):
    return H.product_listing(bronze_rows(spark, base)).orderBy("categoria")


# ------------------------------------------------------------------ A1-A3
def targets(spark, base):
    return expand_targets(config_from_parts(spark, base))


def targets_count(spark, base):
    return target_counts(config_from_parts(spark, base))


# ------------------------------------------------------------------ Q20
def fetches(spark: SparkSession, base: str) -> DataFrame:
    """Raw fetches parsed and routed; one batch per day of fetches."""
    raw = raw_payloads(spark, base)
    parsed = (raw.withColumn("precio", json_field("payload", "$.k"))
                 .withColumn("descripcion", json_field("payload", "$.name")))
    stamped = I.stamp_batch(parsed, ymd_text("fetched_at", sep=""), day_start("fetched_at"))
    return I.with_status(stamped)


def ingest_bronze(spark, base):
    return I.bronze_rows(fetches(spark, base))


def ingest_errors(spark, base):
    return I.error_rows(fetches(spark, base))


def nested_fetches(spark: SparkSession, base: str) -> DataFrame:
    """Fetches in the shop's nested shape, routed with the kind of error."""
    parsed = parse_shop(nested_payloads(spark, base))
    stamped = I.stamp_batch(parsed, ymd_text("fetched_at", sep=""), day_start("fetched_at"))
    return I.with_status(stamped, F.col("_fault"))


def nested_bronze(spark, base):
    return I.bronze_rows(nested_fetches(spark, base))


def nested_errors(spark, base):
    return I.error_rows(nested_fetches(spark, base))


def ingest_metrics(spark, base):
    return I.run_metrics(fetches(spark, base))


def ingest_events(spark, base):
    return I.run_events(I.run_metrics(fetches(spark, base)))


def configured_targets(spark: SparkSession, base: str) -> DataFrame:
    """What the runs should fetch: every (product, store) met in the fetches,
    and one product per region that never was."""
    met = raw_payloads(spark, base).select("corte", "supermercado").distinct()
    never = read_table(spark, base, "region").select(F.concat(F.lit("Region "), "r_name").alias("corte"), F.lit("Store_0").alias("supermercado"))
    return met.unionByName(never)


def started_runs(spark: SparkSession, base: str) -> DataFrame:
    """One run a day, also on days without fetches: up to three after the last."""
    day = F.to_date("fetched_at")
    span = raw_payloads(spark, base).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.select(F.explode(F.sequence("first", F.date_add("last", 3))).alias("day"))
    return I.stamp_batch(days, ymd_text("day", sep=""), day_start("day")).drop("day")


def target_metrics(spark, base):
    """Runs measured against the configuration, fetched or not."""
    return I.target_metrics(fetches(spark, base), configured_targets(spark, base), started_runs(spark, base),
                            keys=("corte", "supermercado"))


def target_events(spark, base):
    """A9 / A11 over the same runs: FAILED, with stack, where none succeeded."""
    return I.run_events(target_metrics(spark, base), f"{I.EMPTY_BATCH_ERROR}: {I.EMPTY_BATCH_MESSAGE}")


def text_stamps(spark, base):
    """One new batch id for all rows; run date (dd-MM-yyyy) and ingest
    time (ISO) read from text, of which some is missing or no date."""
    ev, i = read_table(spark, base, "events"), F.col("event_id")
    day = F.concat(F.lpad(F.dayofmonth("ts").cast("string"), 2, "0"), F.lit("-"), F.lpad(F.month("ts").cast("string"), 2, "0"),
                   F.lit("-"), F.lpad(F.year("ts").cast("string"), 4, "0"))
    rows = ev.select("event_id", F.when(i % 7 == 0, "ayer").when(i % 7 == 1, None).when(i % 7 == 2, "31-02-2024").otherwise(day)
                     .alias("fecha_extraccion"), F.when(i % 5 == 0, "sin hora").otherwise(iso_seconds("ts")).alias("ts_text"))
    stamped = I.typed_stamps(I.stamp_batch(rows, I.new_batch_id(), F.col("ts_text")))
    return stamped.select("event_id", "fecha_extraccion", "ingestion_timestamp",
                          F.col("batch_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("lote_valido"))


def ingest_summary(spark, base):
    return I.summary_events(I.run_metrics(fetches(spark, base)))


# ------------------------------------------------------------------ Q19
def failed_events(spark, base):
    return audit_events(spark, base).where(F.col("status") == I.FAILED)


def latest_run(spark, base):
    m = ingest_metrics(spark, base)
    return m.orderBy(F.col("event_ts").desc(), F.col("batch_id").desc()).limit(1)


def errors_of_day(spark, base):
    e = ingest_errors(spark, base)
    return (e.where(F.to_date("event_ts") == F.lit(P.ERRORS_DAY))
             .select("corte", "url", "error_type", "error_message"))


def event_history(spark, base):
    e = audit_events(spark, base).where(F.col("pipeline") == I.PIPELINE)
    return e.select("event_ts", "status", "batch_id", "rows_read", "rows_written").orderBy(
        F.col("event_ts").desc())


def low_success_runs(spark, base):
    return I.low_success_runs(ingest_metrics(spark, base))


def ingest_bronze_numeric(spark, base):
    """The early Bronze shape with a numeric price."""
    return I.bronze_rows(fetches(spark, base), price_as="double")


def product_observations(spark, base):
    return bronze_rows(spark, base).where(F.col("nombre") == P.PRODUCT_OF_INTEREST)
