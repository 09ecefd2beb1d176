"""Inline constant relations (``SELECT * FROM VALUES ...``).

Built from typed literals over a one-row range, so the relation is part of
the plan (no driver-side RDD) and Catalyst knows it is tiny: joins against
it are planned as broadcast joins from the start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = schema.fields
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
