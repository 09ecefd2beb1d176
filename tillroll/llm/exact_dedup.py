"""Exact deduplication by skew-safe combining.

Equal texts are combined in three steps, and each compares whole texts,
because the text itself is part of every grouping key:

1. *local*: Spark's map-side aggregation combines the equal texts a task
   holds, so a task ships one row per distinct text however many copies it
   read;
2. *salted*: the tasks' winners meet by (digest, salt, text), the salt being
   the task's number, so even a text that occurs in every task is spread over
   ``salts`` groups;
3. *global*: at most ``salts`` winners per text meet by digest and are
   combined.

The members learn their group by a join on the digest, whose two sides are
plain exchanges, so AQE can split a hot digest.  Different texts that share a
digest are told apart by a second join on digest and text.

Defined cases: a null text counts as empty; an empty table gives an empty
result; rows that repeat id and text are each reported (``drop_duplicates``
keeps one of them); a null id is smaller than any other id, and when all ids
of a group are null ``keep_id`` is null and those rows count as kept in the
report; rows that tie for a group's largest id all count as kept there; very long
texts are compared whole; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import cut, drop_rows


def sha256_bytes(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64,
                 digest: Callable[[Column], Column] = sha256_bytes) -> DataFrame:
    """One row per document: doc_id, digest, keep_id (largest id of the equal
    texts), group_size, kept."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))

    salted = (rows.withColumn("salt", F.spark_partition_id() % F.lit(salts))
              .groupBy("digest", "salt", "text")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    combined = (salted.repartition("digest")
                .groupBy("digest", "text")
                .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))
    by_digest = cut(combined.groupBy("digest")
                    .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
                         F.count(F.lit(1)).alias("n_texts")))

    single = by_digest.where("n_texts = 1").drop("n_texts")
    members = rows.select("doc_id", "digest").join(single, "digest")
    shared = by_digest.where("n_texts > 1").select("digest")
    if not shared.isEmpty():
        texts = combined.join(shared, "digest", "left_semi")
        clashing = rows.join(shared, "digest", "left_semi").join(texts, ["digest", "text"])
        members = members.unionByName(clashing.drop("text"))
    return members.select("doc_id", "digest", "keep_id", "group_size",
                          F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """The documents without the exact copies of another one, all columns kept.
    Of rows that repeat both id and text one stays."""
    groups = exact_groups(docs, id_col, text_col, salts)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = {"doc_id": F.col(f"`{id_col}`"), "digest": sha256_bytes(text)}
    repeated = (groups.where("kept and group_size > 1").groupBy("doc_id", "digest")
                .count().where("count > 1").select("doc_id", "digest"))
    repeated = cut(repeated)
    left = drop_rows(docs, groups.where("not kept"), key)
    if repeated.isEmpty():
        return left
    once = drop_rows(left, repeated, key)
    marked = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row"),
                         *[expr.alias(f"k_{name}") for name, expr in key.items()])
    again = repeated.select(F.col("doc_id").alias("r_id"), F.col("digest").alias("r_digest"))
    one = (marked.join(again, F.col("k_doc_id").eqNullSafe(F.col("r_id")) & (F.col("k_digest") == F.col("r_digest")),
                       "left_semi")
           .groupBy("k_doc_id", "k_digest").agg(F.min("row").alias("row")).select("row.*"))
    return once.unionByName(one)
