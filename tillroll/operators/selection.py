"""Exact percentiles per group by distributed selection.

Sorting a group, or holding its values in one buffer, puts a hot group on one
task.  Here only intervals are refined:

1. one aggregate gives each group's count, least and largest value, and from
   them the ranks that the percentiles need;
2. a round cuts each open interval in ``buckets`` and counts the values per
   bucket (combined map-side, so a task ships at most one row per bucket
   however many rows of a group it holds); the bucket that holds the rank, from
   its least to its largest value, is the next interval;
3. an interval is closed once it has one value or at most ``last_rows`` rows;
   only those rows are read and ordered.

Intervals that span orders of magnitude are cut on a logarithmic scale, others
evenly.  Both ends of an interval fall in different buckets, so every round
narrows it, and as buckets only need to keep the order of values, rounding
cannot change a result.  Rows are never exchanged on the group: they meet the
few open intervals of their group by a join, broadcast where those are counted
to be few.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialise, small_side

_INTERVAL = ("t", "rank", "frac", "low", "high", "below", "n", "after")


def _scaled(v: Column, wide: Column) -> Column:
    """Order-keeping: signed logarithm where the interval is wide, else v."""
    return F.when(wide, F.signum(v) * F.log1p(F.abs(v))).otherwise(v)


def _bucket(buckets: int) -> Column:
    low, high = F.col("low"), F.col("high")
    wide = F.abs(_scaled(high, F.lit(True)) - _scaled(low, F.lit(True))) > 1.0
    at = (_scaled(F.col("v"), wide) - _scaled(low, wide)) / (_scaled(high, wide) - _scaled(low, wide))
    return F.when(F.col("v") == high, F.lit(buckets - 1)).otherwise(F.least(F.floor(at * buckets), F.lit(buckets - 1)).cast("int"))


def _met(rows: DataFrame, intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with each interval of their group that holds their value."""
    own = rows.select("v", *[F.col(k).alias(f"row_{k}") for k in keys])
    same = [F.col(f"row_{k}").eqNullSafe(F.col(k)) for k in keys]
    inside = reduce(lambda a, b: a & b, [*same, F.col("v") >= F.col("low"), F.col("v") <= F.col("high")])
    return own.join(small_side(intervals), inside).select(*keys, "v", *_INTERVAL)


def _round(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The bucket of each interval that holds the rank, as next interval."""
    counts = (_met(rows, intervals, keys).withColumn("bucket", _bucket(buckets))
              .groupBy(*keys, "t", "rank", "frac", "below", "after", "bucket")
              .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
    order = Window.partitionBy(*keys, "t").orderBy("bucket")  # at most ``buckets`` rows
    placed = (counts.withColumn("before", F.col("below") + F.sum("n").over(order) - F.col("n"))
              .withColumn("next", F.coalesce(F.lead("low").over(order), F.col("after"))))
    holds = (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n"))
    return materialise(placed.where(holds).select(*keys, "t", "rank", "frac", "low", "high", F.col("before").alias("below"), "n",
                                                  F.col("next").alias("after")))


def group_percentiles(df: DataFrame, group: Sequence[str], value: str, qs: dict[str, float], buckets: int = 512,
                      last_rows: int = 2048, stored: bool = False) -> DataFrame:
    """One row per group: the group columns (null is a group) and, named by
    ``qs``, the percentiles of ``value`` as double, interpolated between ranks.
    Null values do not count; a group of nulls alone, as an empty table, has
    no row.  Values are finite.  Runs as it is called (a few jobs), each over
    the two columns it needs, materialised first unless ``df`` is ``stored``
    (a table, or materialised)."""
    keys = [f"g{i}" for i in range(len(group))]
    rows = df.select(*[F.col(f"`{g}`").alias(k) for g, k in zip(group, keys)],
                     F.col(f"`{value}`").cast("double").alias("v")).where("v is not null")
    rows = rows if stored else materialise(rows)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    wanted = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(float(q)).alias("q")) for t, q in enumerate(qs.values())]))
    place = F.col("want")["q"] * (F.col("n") - 1)
    intervals = materialise(sizes.withColumn("want", wanted).select(
        *keys, F.col("want")["t"].alias("t"), F.floor(place).alias("rank"), (place - F.floor(place)).alias("frac"),
        "low", "high", F.lit(0).cast("long").alias("below"), "n", F.lit(None).cast("double").alias("after")))

    is_open = (F.col("low") < F.col("high")) & (F.col("n") > last_rows)
    closed = intervals.where(~is_open)
    while not (open_ := intervals.where(is_open)).isEmpty():
        intervals = _round(rows, open_, keys, buckets)
        closed = closed.unionByName(intervals.where(~is_open))

    single = closed.where("low = high").withColumn("values", F.array("low"))
    few = (_met(rows, materialise(closed.where("low < high")), keys).groupBy(*keys, *_INTERVAL)
           .agg(F.sort_array(F.collect_list("v")).alias("values")))
    at = (F.col("rank") - F.col("below")).cast("int")
    one = F.when(F.size("values") == 1, F.col("low")).otherwise(F.get("values", at))
    two = (F.when(F.col("rank") + 1 >= F.col("below") + F.col("n"), F.col("after"))
           .when(F.size("values") == 1, F.col("low")).otherwise(F.get("values", at + 1)))
    between = F.when((F.col("frac") == 0) | (F.col("one") == F.col("two")), F.col("one")).otherwise(
        (1 - F.col("frac")) * F.col("one") + F.col("frac") * F.col("two"))
    found = (single.unionByName(few).withColumn("one", one).withColumn("two", two)
             .select(*keys, "t", between.alias("p")))
    out = found.groupBy(*keys).agg(*[F.max(F.when(F.col("t") == t, F.col("p"))).alias(name) for t, name in enumerate(qs)])
    return materialise(out.select(*[F.col(k).alias(g) for g, k in zip(group, keys)], *qs))
