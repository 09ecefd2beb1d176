"""Daily loads as a stream: new Bronze files -> Silver upsert per micro-batch.

The reference runs its Silver MERGE as a scheduled batch over all of
Bronze.  The same result is kept incrementally: each micro-batch of newly
arrived Bronze rows is upserted into the dated history with
``merge_into_path``, which rewrites its dates only.  The history keeps the
ingest time and batch of every row, and a matched row is updated only by one
that is not older, so the newest row wins in whatever order batches arrive and
nothing of Bronze is read beyond the micro-batch.  The upsert is keyed, so a
micro-batch replayed after a failure gives the same rows (only
``fecha_actualizacion`` records the replay time, unless ``updated_at`` is
fixed); progress lives in the checkpoint location (a shared folder on a
cluster).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators.upsert import merge_into_path
from tillroll.plans.silver import silver_from_bronze
from tillroll.schemas import BRONZE_PRICES, SILVER_STAMPS


def read_bronze_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE_PRICES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_silver_stream(bronze_stream: DataFrame, silver_path: str, checkpoint_location: str,
                        available_now: bool = True, updated_at: dt.datetime | None = None) -> StreamingQuery:
    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        stamp = updated_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        merge_into_path(batch.sparkSession, silver_from_bronze(batch, stamp, stamps=True), silver_path, newer_by=SILVER_STAMPS)

    writer = (bronze_stream.writeStream.foreachBatch(upsert_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()
