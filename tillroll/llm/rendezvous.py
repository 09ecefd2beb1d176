"""Sharding by weighted rendezvous hashing (SQL functions only).

Every pair of a record's key and a shard has a hash, read as a number u
between 0 and 1; the record goes to the shard with the highest
``weight / -ln(u)`` (of equal ones to the lower shard).  A shard so gets its
share of the weights, and as no hash depends on how many shards there are, one
more shard takes records only into itself and one shard less spreads only its
own records over the others.

* *Assigning* is map-only: no shuffle, no state, and the plan has the same size
  for any number of shards.
* *Slots* number a shard's records without a gap.  The narrow rows (never the
  texts) are range-partitioned by shard, id, size and checksum, with a row
  number last, so that a hot shard, and even a hot id, is spread over many
  tasks; a slot is the place in the sorted partition plus the count of the
  shard's rows in earlier partitions, which takes one row per partition and
  shard.  Rows that are equal in all of these may swap slots between runs.
* *Writing* rebalances on the shard, so a large shard becomes several files.

Defined cases: a null or empty text has size 1 and the checksum of no bytes; a
null id is a key of its own, apart from every text; very long texts are read
once for size and checksum and are not moved; ids that repeat share a shard,
as id and shard count alone decide, and each row has its own slot, in order of
size and checksum; so equal texts (the groups) are not held together; a shard of
weight 0 stays empty; an empty table gives an empty result; the result columns
of ``layout`` hold no other columns of the input, whatever their names, and
``assign`` replaces a column named like its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import cut, small

_SCALE = 2.0 ** 48
#: Bits of ``monotonically_increasing_id`` that number a partition's rows.
_PLACE_BITS = 33


def _unit(key: Column, shard: Column, seed: str) -> Column:
    """48 random bits of (key, shard) as a number strictly between 0 and 1."""
    text = F.concat(F.lit(seed + ":"), shard.cast("string"), F.coalesce(F.concat(F.lit(":"), key.cast("string")), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") + 0.5) / _SCALE


def _claim(key: Column, shard: Column, weight: Column, seed: str) -> Column:
    """How strongly a shard claims a key, and the shard (the lower one first)."""
    return F.struct((-weight / F.ln(_unit(key, shard, seed))).alias("claim"), (-shard).alias("minus"))


def _best(key: Column, weights: Sequence[float], seed: str) -> Column:
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights are not negative, and one of them is positive")
    shards = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(float(w)).alias("weight"))
                       for s, w in enumerate(weights) if w > 0])
    return F.array_max(F.transform(shards, lambda s: _claim(key, s["shard"], s["weight"], seed)))


def shard_of(key: Column, weights: Sequence[float], seed: str = "shard") -> Column:
    """The shard (0 to len(weights) - 1) of a key."""
    return (-_best(key, weights, seed)["minus"]).cast("int")


def grown_shard_of(key: Column, weights: Sequence[float], added: float = 1.0, seed: str = "shard") -> Column:
    """The shard of a key once a shard of weight ``added`` comes last."""
    best, more = _best(key, weights, seed), F.lit(len(weights))
    taken = F.greatest(best, _claim(key, more, F.lit(float(added)), seed)) if added > 0 else best
    return (-taken["minus"]).cast("int")


def assign(docs: DataFrame, weights: Sequence[float], id_col: str = "doc_id", out: str = "shard",
           seed: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row (map-only)."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != out]
    return docs.select(*kept, shard_of(F.col(f"`{id_col}`"), weights, seed).alias(out))


def with_slots(rows: DataFrame, shard: str, order: Sequence[str], out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0, in ``order``.  ``rows`` should be
    narrow: they are materialised and moved once."""
    ordered = [shard, *order]
    rows = cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    spread = rows.repartitionByRange(*ordered, "__row").sortWithinPartitions(*ordered, "__row").drop("__row")
    placed = spread.withColumn("__id", F.monotonically_increasing_id())
    placed = cut(placed.withColumn("__part", F.shiftright("__id", _PLACE_BITS)))
    runs = placed.groupBy(shard, "__part").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = small(cut(runs.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")))
    slot = F.col("__before") + F.col("__id") - F.col("__first")
    return placed.join(runs, [shard, "__part"]).withColumn(out, slot).drop("__id", "__part", "__first", "__before")


def layout(docs: DataFrame, weights: Sequence[float], added: float = 1.0, id_col: str = "doc_id",
           text_col: str = "text", seed: str = "shard") -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32, shard, grown_shard (with
    one more shard, of weight ``added``), slot."""
    key = F.col(f"`{id_col}`")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(key.alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), shard_of(key, weights, seed).alias("shard"),
                       grown_shard_of(key, weights, added, seed).alias("grown_shard"))
    return with_slots(rows, "shard", ["doc_id", "size", "text_crc32"])


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], id_col: str = "doc_id", seed: str = "shard") -> None:
    """The documents as Parquet files in one folder ``shard=n`` per shard."""
    rows = assign(docs, weights, id_col, "shard", seed)
    rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
