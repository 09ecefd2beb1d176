"""Writers.

Appends are the reference's per-table transactions; each one is a Spark
job with task-level commit, so a lost executor re-runs tasks, never rows.
``write_ingest_run`` persists a routed batch in the reference order
(errors, STARTED, Bronze, SUCCESS/FAILED, SUMMARY, run metrics) from one
checkpointed parse, so every table sees the same rows.
"""

from __future__ import annotations

import traceback
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import ingest as I
from tillroll.session import materialise


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Materialise a result (full refresh of ``path``: what was there
    before goes, whatever the session's overwrite mode)."""
    spread = df.hint("rebalance", *partition_by) if partition_by else df
    w = spread.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_ingest_run(spark: SparkSession, routed: DataFrame, root: str, pipeline: str = I.PIPELINE,
                     source: str = I.SOURCE, runs: DataFrame | None = None) -> DataFrame:
    """Persist routed fetches (see ``ingest.with_status``) under ``root``:
    bronze/ (partitioned by load_date), audit/etl_logs, audit/scraping_errors,
    audit/run_metrics.  Batches without any parsed row are refused: they get
    a FAILED event (with stack) and their errors, but no Bronze rows; their
    metrics, 0 %, are kept like any other's.  ``runs`` (batch_id,
    ingestion_timestamp) are the started runs, also those without a fetch.  If
    Bronze cannot be written, FAILED is logged (type, message, stack) and the
    error goes on to the caller.
    Returns the run metrics."""
    routed = materialise(routed.drop("payload"))  # the raw pages are not needed any more
    metrics = materialise(I.run_metrics(routed, pipeline, source, runs))
    events = I.run_events(metrics, I.empty_batch_error()[1])
    logs, errors = f"{root}/audit/etl_logs", f"{root}/audit/scraping_errors"
    append(I.error_rows(routed, pipeline, source), errors)  # kept whatever becomes of the load
    append(events.where(F.col("status") == I.STARTED), logs)
    try:
        append(I.bronze_rows(routed), f"{root}/bronze", ("load_date",))
    except Exception as error:
        loading = metrics.where(F.col("rows_success") > 0)
        append(I.failed_events(loading, error, traceback.format_exc()), logs)
        raise
    append(events.where(F.col("status") != I.STARTED), logs)
    append(I.summary_events(metrics), logs)
    append(metrics, f"{root}/audit/run_metrics")
    return metrics
