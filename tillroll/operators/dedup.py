"""Keep the newest row per key (ROW_NUMBER ... = 1).

``row_number`` + ``rn == 1`` is planned as WindowGroupLimit: each map task
keeps only its best row per key before the shuffle, so a key holding a large
share of the rows costs no more shuffle than any other key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column],
                   rank_col: str = "_rn") -> DataFrame:
    """``order`` must be a total order within a key (add tie-breaks), or the
    kept row is not deterministic."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A19 guard: a DataFrame of duplicated keys (empty when unique)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
