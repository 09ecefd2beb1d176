"""Route parsed fetches to Bronze or to the error log, stamp the
batch, and derive run metrics and run events - all from one lazy plan.

Input: one row per fetch with ``corte`` (product), ``supermercado``,
``url``, ``categoria``, ``unidad``, ``batch_id``, ``ingestion_timestamp``
and the parsed ``precio`` / ``descripcion`` (null when extraction failed).
Batches are data (a column), so many runs are processed in one job and
every run's metrics are a grouped aggregate.
"""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import iso_seconds, ntz_lit
from tillroll.operators.clean import with_defaults
from tillroll.session import materialise, small_side

# Pipeline identity, statuses and messages.
PIPELINE = "extract_prices"
SOURCE = "Store"
NO_DATA = "NoData"
NO_DATA_MESSAGE = "No se pudo extraer información"
EMPTY_BATCH_ERROR = "ValueError"
EMPTY_BATCH_MESSAGE = "El scraping no devolvió filas; no se puede cargar una tabla vacía."
STARTED, SUCCESS, FAILED, SUMMARY = "STARTED", "SUCCESS", "FAILED", "SUMMARY"
RUN_DATE_FORMAT = "dd-MM-yyyy"
METRICS_TYPE = "RUN_METRICS"


def stamp_batch(df: DataFrame, batch_id, ingested_at) -> DataFrame:
    """The same batch id and ingestion time on every row of a run
    (``batch_id``/``ingested_at`` are literals for one run or columns)."""
    b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    t = ingested_at.try_cast("timestamp_ntz") if isinstance(ingested_at, Column) else ntz_lit(ingested_at)
    return df.withColumn("batch_id", b).withColumn("ingestion_timestamp", t)


def typed_stamps(df: DataFrame, date_col: str = "fecha_extraccion", ts_col: str = "ingestion_timestamp",
                 date_format: str = RUN_DATE_FORMAT) -> DataFrame:
    """A run date written as text ('dd-MM-yyyy') and an ISO ingest time
    become DATE and TIMESTAMP_NTZ; unparsable text becomes null (no error),
    and no session time zone is involved."""
    return (df.withColumn(date_col, F.call_function("try_to_date", F.col(date_col), F.lit(date_format)))
              .withColumn(ts_col, F.col(ts_col).try_cast("timestamp_ntz")))


def with_status(parsed: DataFrame, fault: Column | None = None) -> DataFrame:
    """A5: a fetch succeeded when a price was extracted.  ``fault`` (see
    ``sources.payload.parsed_once``) tells what was wrong with a page that
    was fetched; without one, or where it is null, the error is ``NoData``."""
    ok = F.col("precio").isNotNull()
    kind, message = F.lit(NO_DATA), F.lit(NO_DATA_MESSAGE)
    if fault is not None:
        kind, message = F.coalesce(fault["error_type"], kind), F.coalesce(fault["error_message"], message)
    return (parsed.withColumn("_ok", ok)
                  .withColumn("error_type", F.when(~ok, kind))
                  .withColumn("error_message", F.when(~ok, message)))


def bronze_rows(routed: DataFrame, price_as: str = "string") -> DataFrame:
    """Bronze shape (price kept as text, dates typed, load date).
    ``price_as='double'`` is the early variant (A8): a numeric price, where
    text such as 'Sin stock' becomes null."""
    ok = with_defaults(routed.where(F.col("_ok")))
    price = F.col("precio").try_cast("double") if price_as == "double" else F.col("precio").cast("string")
    # the run date of the fetch when the row carries one, else the day of the ingest time
    day = (F.coalesce(F.col("fecha_extraccion"), F.to_date("ingestion_timestamp"))
           if "fecha_extraccion" in routed.columns else F.to_date("ingestion_timestamp"))
    return ok.select(
        "supermercado", F.col("corte").alias("nombre"), "descripcion",
        price.alias("precio"), "categoria", "unidad", "url",
        day.alias("fecha_extraccion"), "batch_id",
        "ingestion_timestamp", F.to_date("ingestion_timestamp").alias("load_date"))


def error_rows(routed: DataFrame, pipeline: str = PIPELINE, source: str = SOURCE) -> DataFrame:
    """A10: failed fetches with batch and pipeline context."""
    bad = routed.where(~F.col("_ok"))
    return bad.select(
        F.col("ingestion_timestamp").alias("event_ts"), F.lit(pipeline).alias("pipeline"),
        F.lit(source).alias("source"), "batch_id", "corte", "supermercado", "url",
        "error_type", "error_message")


def new_batch_id() -> str:
    """The id of a new run (a random UUID, drawn once on the driver)."""
    return str(uuid.uuid4())


def one_run(spark: SparkSession, batch_id: str, ingested_at) -> DataFrame:
    """A started run as a one-row table, for ``run_metrics(runs=...)``."""
    return stamp_batch(spark.range(1), batch_id, ingested_at).drop("id")


def target_metrics(routed: DataFrame, targets: DataFrame, runs: DataFrame, keys: Sequence[str] = ("supermercado", "url"),
                   product: str = "corte", pipeline: str = PIPELINE, source: str = SOURCE) -> DataFrame:
    """A12 against the configuration: one row per started run (``runs``:
    batch_id, ingestion_timestamp), where every configured target (``keys``)
    counts, fetched or not, and succeeds if any of its fetches does.  Fetches
    of something not configured do not count; a run without fetches has 0 %.

    The targets are counted once, and never multiplied by the runs."""
    distinct = materialise(targets.select(*dict.fromkeys([*keys, product])).distinct())
    products, urls = (distinct.select(*c).distinct().count() for c in ([product], keys))
    ids = ("batch_id", "ingestion_timestamp")
    fetched = routed.where(F.col("_ok")).select(*ids, *keys).distinct().join(small_side(distinct), list(keys), "left_semi")
    done = fetched.groupBy(*ids).agg(F.count(F.lit(1)).alias("rows_success"))
    m = runs.select(*ids).distinct().join(done, list(ids), "left").withColumn("rows_success", F.coalesce("rows_success", F.lit(0).cast("long")))
    m = (m.withColumn("products_configured", F.lit(products).cast("long"))
          .withColumn("urls_target", F.lit(urls).cast("long"))
          .withColumn("rows_error", F.col("urls_target") - F.col("rows_success")))
    return _metrics(m, pipeline, source)


def run_metrics(routed: DataFrame, pipeline: str = PIPELINE, source: str = SOURCE, runs: DataFrame | None = None) -> DataFrame:
    """One row per batch; success rate = ok / targets x 100 (2 dec.).
    Every fetch counts as a target: complete the fetches with the configured
    targets first (``sources.config.complete_fetches``), or see
    ``target_metrics``.  ``runs`` adds started runs without any fetch (0 %)."""
    g = routed.groupBy("batch_id", "ingestion_timestamp").agg(
        F.countDistinct("corte").alias("products_configured"),
        F.count(F.lit(1)).alias("urls_target"),
        F.count_if(F.col("_ok")).alias("rows_success"),
        F.count_if(~F.col("_ok")).alias("rows_error"))
    if runs is not None:
        g = runs.select("batch_id", "ingestion_timestamp").join(g, ["batch_id", "ingestion_timestamp"], "full_outer").fillna(
            0, ["products_configured", "urls_target", "rows_success", "rows_error"])
    return _metrics(g, pipeline, source)


def _metrics(g: DataFrame, pipeline: str, source: str) -> DataFrame:
    rate = F.round(F.try_divide(F.col("rows_success").cast("decimal(20,0)") * 100, F.col("urls_target")), 2)
    return g.select(
        F.col("ingestion_timestamp").alias("event_ts"), F.lit(pipeline).alias("pipeline"),
        F.lit(source).alias("source"), "batch_id",
        iso_seconds("ingestion_timestamp").alias("ingestion_timestamp"),
        "products_configured", "urls_target", "rows_success", "rows_error",
        F.coalesce(rate, F.lit(0)).cast("double").alias("success_rate_pct"))


def _event(status, rows_read, rows_written, error_type=None, error_message=None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(status).alias("status"), rows_read.cast("long").alias("rows_read"),
                    rows_written.cast("long").alias("rows_written"),
                    (error_type if error_type is not None else none).alias("error_type"),
                    (error_message if error_message is not None else none).alias("error_message"))


def empty_batch_error() -> tuple[ValueError, str]:
    """The error of a run without any parsed row, with its stack."""
    try:
        raise ValueError(EMPTY_BATCH_MESSAGE)
    except ValueError as error:
        return error, "".join(traceback.format_exception(error))


def run_events(metrics: DataFrame, stacktrace: str | None = None) -> DataFrame:
    """A9 + A11: STARTED then SUCCESS per batch; a batch without any
    parsed row is refused (FAILED, empty-batch error, with ``stacktrace``)
    instead of loaded."""
    ok = F.col("rows_success")
    zero = F.lit(0)
    events = F.when(ok > 0, F.array(_event(STARTED, ok, zero), _event(SUCCESS, ok, ok))).otherwise(
        F.array(_event(FAILED, zero, zero, F.lit(EMPTY_BATCH_ERROR), F.lit(EMPTY_BATCH_MESSAGE))))
    e = metrics.select("event_ts", "pipeline", "source", "batch_id", F.inline(events))
    return e.select("event_ts", "pipeline", "source", "status", "batch_id", "rows_read", "rows_written",
                    "error_type", "error_message",
                    F.when(F.col("status") == FAILED, F.lit(stacktrace).cast("string")).alias("stacktrace"))


def failed_events(metrics: DataFrame, error: BaseException, stacktrace: str) -> DataFrame:
    """FAILED per batch of a load that raised ``error``."""
    event = _event(FAILED, F.col("rows_success"), F.lit(0), F.lit(type(error).__name__), F.lit(str(error)))
    e = metrics.select("event_ts", "pipeline", "source", "batch_id", event.alias("e"))
    return e.select("event_ts", "pipeline", "source", "e.status", "batch_id", "e.rows_read", "e.rows_written",
                    "e.error_type", "e.error_message", F.lit(stacktrace).alias("stacktrace"))


def summary_events(metrics: DataFrame) -> DataFrame:
    """SUMMARY log row per successful batch, metrics as JSON text."""
    payload = F.to_json(F.struct("batch_id", "ingestion_timestamp", "products_configured",
                                 "urls_target", "rows_success", "rows_error", "success_rate_pct"))
    return metrics.where(F.col("rows_success") > 0).select(
        "event_ts", "pipeline", "source", F.lit(SUMMARY).alias("status"), "batch_id",
        F.col("urls_target").alias("rows_read"), F.col("rows_success").alias("rows_written"),
        F.lit(METRICS_TYPE).alias("error_type"), payload.alias("error_message"),
        F.lit(None).cast("string").alias("stacktrace"))


def low_success_runs(metrics: DataFrame, threshold_pct: float = 90.0) -> DataFrame:
    """Runs below the operations threshold (success_rate_pct < 90)."""
    return metrics.where(F.col("success_rate_pct") < F.lit(threshold_pct))
