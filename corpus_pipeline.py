"""Training-data pipeline over ``documents``.

quality classifier -> exact dedup -> SimHash near-dedup -> source mixing ->
BPE.  Each stage works on all rows its predecessor kept; all but the last
return the columns of ``documents``, whatever further columns these are.

Defined cases: a null or empty text is scored like any other, is one of the
group of empty texts and, of size 0, never drawn into the mix; of equal texts the
row with the largest id goes on (one, if ids or rows repeat; a null id gives
way), of near-equal ones the one with the smallest (rows without an id, and all
that share the smallest with different texts, stay); very long texts
are read whole in every stage; an empty table, or one of which a stage keeps
nothing, gives an empty result; without labels, or with those of one class, all
documents have one score and go on or go together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, exact_dedup, mixing, quality, simhash
from tillroll.llm.common import read
from tillroll.llm.queries import TOKENIZER
from tillroll.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.3."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.accept(docs, model, least=0.3)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within two bits."""
    return simhash.drop_near_duplicates(docs, shingle=3, budget=2)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights ask for."""
    return mixing.mix(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of what they
    decode to."""
    rows = docs.select("doc_id", "lang", "source", "text")
    coded = bpe.encode(rows, TOKENIZER, decoded_col="decoded")
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", simhash_stage),
    ("source mixing", mixing_stage),
    ("BPE", bpe_stage),
]

#: Fingerprints, the classifier and BPE are beyond SQL; tests/llm compares the
#: pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are a Parquet
    table in the shared folder of ``spark.checkpoint.dir``."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus_pipeline/{uuid.uuid4()}"
    for place, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return STAGES[-1][1](spark, docs, sf_dir)
