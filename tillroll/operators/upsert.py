"""Keyed upsert (MERGE) of a source into a history table.

``upsert`` is the pure relational form: a full outer join on the keys;
matched rows take ``update_cols`` from the source and keep everything else
(unit, store, name) from the target; unmatched source rows are inserted;
target-only rows are left as they are.

``merge_into_path`` is the writer.  The history is partitioned by the date
that is part of the key, so only the dates present in the source can change:
it reads just those partitions (the materialised source's dates become a
partition filter), merges, cuts the lineage with a reliable checkpoint (the target
files are fully read before anything is replaced, and a lost executor
recomputes from the checkpoint, not from files being overwritten), and
replaces exactly those partitions with a dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.dedup import assert_unique
from tillroll.schemas import SILVER_KEYS, SILVER_UPDATE_COLS
from tillroll.session import materialise


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str] = SILVER_KEYS,
           update_cols: Sequence[str] = SILVER_UPDATE_COLS, newer_by: Sequence[str] = ()) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE update_cols WHEN NOT MATCHED INSERT *.

    ``newer_by`` makes the update conditional: a matched row is updated (these
    columns too) only if the source's values of them, compared in order, are
    not before the target's, so a late, older row changes nothing; null is
    before any value.  A null key never matches (as in SQL), so such a source row is inserted
    and such a target row is kept."""
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.select(*target.columns).withColumn("_in_s", F.lit(True)).alias("s")
    cond = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    updates = in_s
    if newer_by:
        stamp = {side: F.struct(*[F.col(f"{side}.`{c}`") for c in newer_by]) for side in "ts"}
        updates = in_s & (~in_t | (stamp["s"] >= stamp["t"]))
    out = []
    for c in target.columns:
        tc, sc = F.col(f"t.`{c}`"), F.col(f"s.`{c}`")
        if c in update_cols or c in newer_by:
            out.append(F.when(updates, sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(in_t, tc).otherwise(sc).alias(c))
    return j.select(*out)


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str] = SILVER_KEYS) -> DataFrame:
    """What a MERGE would do: rows updated and inserted (one row)."""
    t = target.select(*keys).withColumn("_t", F.lit(1))
    s = source.select(*keys).withColumn("_s", F.lit(1))
    j = s.join(t, list(keys), "left")
    return j.agg(F.count_if(F.col("_t").isNotNull()).alias("updated"),
                 F.count_if(F.col("_t").isNull()).alias("inserted"))


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None only where there is no such path."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def touched_dates(source: DataFrame, partition_col: str) -> list:
    """Distinct dates of a materialised source (at most a calendar's worth)."""
    return [r[0] for r in source.select(partition_col).distinct().collect()]


def merge_into_path(spark: SparkSession, source: DataFrame, path: str,
                    keys: Sequence[str] = SILVER_KEYS,
                    update_cols: Sequence[str] = SILVER_UPDATE_COLS,
                    partition_col: str = "fecha_extraccion",
                    require_unique: bool = True, full_refresh: bool = False,
                    newer_by: Sequence[str] = ()) -> list:
    """Upsert ``source`` into the parquet history at ``path``; the dates whose
    partitions were written.  ``newer_by``: see ``upsert`` (a history written
    without these columns gets them, null).

    The source is computed once (reliable checkpoint) and refused before
    anything is written if a key is null (it could never be matched again) or,
    with ``require_unique``, occurs twice.  Its dates select the partitions
    that are read and replaced.  ``full_refresh`` (A20) leaves the source's
    rows alone: a static overwrite drops dates the source does not have."""
    source = materialise(source)
    missing = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in {*keys, partition_col}])
    if not source.where(missing).isEmpty():
        raise ValueError(f"null among {sorted({*keys, partition_col})} in the source")
    if require_unique and not assert_unique(source, keys).isEmpty():
        raise ValueError(f"duplicate keys on {list(keys)} in the source")
    target = None if full_refresh else read_or_none(spark, path)
    out, mode, dates = source, "static", touched_dates(source, partition_col)
    if not dates and not full_refresh:
        return []
    if target is not None:
        for c in set(newer_by) - set(target.columns):
            target = target.withColumn(c, F.lit(None).cast(source.schema[c].dataType))
        touched = target.where(F.col(partition_col).isin(dates)).select(*source.columns)
        out, mode = materialise(upsert(touched, source, keys, update_cols, newer_by)), "dynamic"
    (out.hint("rebalance", partition_col)
        .write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(partition_col).parquet(path))
    return dates
