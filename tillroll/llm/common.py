"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

#: Fixed: white space as the contracts define it (space, tab to carriage return).
BLANKS = r"\x20\x09-\x0D"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def in_workers(df: DataFrame) -> DataFrame:
    """``df`` as it is, once its session's Python workers look for this package
    where the driver found it (as spark.executorEnv.PYTHONPATH would have it);
    where it is installed on the executors, nothing changes."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and cut the lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small(table: DataFrame, rows: int = 100_000) -> DataFrame:
    """A materialised table, marked for broadcast if it is counted to be small."""
    return F.broadcast(table) if table.count() <= rows else table


def drop_rows(rows: DataFrame, dropped: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``rows`` without those whose ``keys`` occur in ``dropped`` (which holds
    them under the same names).  Keys compare null-safely; the columns of
    ``rows`` keep their names whatever they are called."""
    marked = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
                         *[expr.alias(f"k_{name}") for name, expr in keys.items()])
    gone = dropped.select(*[F.col(name).alias(f"g_{name}") for name in keys])
    same = reduce(lambda a, b: a & b, [F.col(f"k_{n}").eqNullSafe(F.col(f"g_{n}")) for n in keys])
    return marked.join(gone, same, "left_anti").select("row.*")
