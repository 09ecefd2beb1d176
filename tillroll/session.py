"""Session helpers.

The library never creates a session on its own: every operator takes
DataFrames.  ``build_session`` exists for tests, the bench and scripts.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tillroll", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(_BASE_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The configured checkpoint folder.  Where none is set, a local session
    (one machine, as in tests) gets a scratch folder; a cluster must name a
    folder that all its machines share."""
    current = checkpoint_dir(spark)
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(local)
    return local


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage, in the shared checkpoint folder
    (never on a machine's own disk, so a lost executor costs no recomputation)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(table: DataFrame, rows: int = 100_000) -> DataFrame:
    """A materialised table, marked for broadcast where it is counted to have
    at most ``rows`` rows; else the join is left to shuffle both sides."""
    return F.broadcast(table) if table.count() <= rows else table
