"""Exact top-k inner-product search with vector-approximation files.

Vectors are integers (floor of ``scale`` times each component).  Equal vectors
form one class that keeps the smallest ids of its members, as many as an answer
can need, so a vector that a third of the rows share is searched once.

* *Approximation*: each component is a cell number, one byte; a dimension's
  cells hold about equally many values (borders at approximate quantiles, the
  outermost at its extremes), so a few far values do not widen the others' cells.
* *Scan*: blocks of queries meet blocks of approximations (bounded blocks, each
  packed into one row, dealt by an equi-join on block numbers).  The middles and
  half widths of a class's own cells bound every product from both sides.  A first scan takes each query's k-th best lower
  bound over all blocks; a second keeps the classes whose upper bound reaches
  it - all others are certain to be outside the top k.
* *Read*: exact vectors are joined in the order of their bounds: first the 2k
  best-bounded classes of each query; its k-th exact score then says which of
  the remaining candidates can still matter, and exactly those are read.

Defined cases: a vector that is null, or holds a null or non-finite component
(or one whose integer is beyond 64 bits) takes no part, nor does a row with a
null id; a shorter vector counts as padded with zeros; every row is a candidate,
also one that repeats another wholly (of such rows an answer needs k at most, so
no more are carried), but rows never answer a query of their own id; queries
that repeat id and vector are answered once; ties go to the smaller id; an empty table gives an empty result; scores are 64-bit integers, a
product beyond that is left out; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import cut, in_workers


def integers(vector: Column, scale: float = 64.0) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column, scale: float) -> Column:
    """Neither null nor holding a component that is null, non-finite or, scaled, beyond 64 bits."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(F.lit(scale) * x.cast("double")) >= 2.0 ** 63))
    return vector.isNotNull() & ~F.coalesce(wrong, F.lit(True))


def members(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """id and v (integers) of the rows that take part."""
    return (vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("x"))
            .where(F.col("id").isNotNull() & usable(F.col("x"), scale))
            .select("id", integers(F.col("x"), scale).alias("v")))


def classes(rows: DataFrame, need: int) -> DataFrame:
    """class_id, v, ids (the ``need`` smallest) and a hash of v as join key."""
    first = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= need)
    return (kept.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .select(F.monotonically_increasing_id().alias("class_id"), "v", "ids", F.xxhash64("v").alias("key")))


class Cells:
    """Cells between ascending borders (one row of them per dimension)."""

    def __init__(self, borders: np.ndarray):
        self.borders = borders
        self.middles, self.halves = (borders[:, 1:] + borders[:, :-1]) / 2, (borders[:, 1:] - borders[:, :-1]) / 2
        self.far = np.abs(borders).max(axis=1)

    def code(self, v: np.ndarray) -> np.ndarray:
        out = np.empty(v.shape, dtype=np.uint8)
        for d, own in enumerate(self.borders):
            out[:, d] = np.clip(np.searchsorted(own, v[:, d].astype(np.float64), side="right") - 1, 0, len(own) - 2)
        return out

    def around(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Middle and half width of each coded component's cell."""
        d = np.arange(codes.shape[1])
        return self.middles[d, codes], self.halves[d, codes]


def _matrix(column, dims: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows of one matrix, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return values.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = values
    return out


def _ids(packed) -> np.ndarray:
    return np.frombuffer(b"".join(packed["ids"].to_pylist()), dtype="<i8")


def _fixed(packed, dims: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(packed["codes"].to_pylist()), dtype=kind).reshape(-1, dims)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 64.0, cells: int = 256, rows_per_block: int = 16384, queries_per_block: int = 4096) -> DataFrame:
    """query_id, rank, <id_col>, score of every row for which ``is_query``
    (a condition on the id column) holds; ``cells`` is 256 at most."""
    spark = vectors.sparkSession
    alike = Window.partitionBy("id", "v").orderBy("id")
    rows = (members(vectors, id_col, vector_col, scale).withColumn("copy", F.row_number().over(alike))
            .where(F.col("copy") <= k).drop("copy"))
    # an answer skips the rows of the query's own id: one, unless ids repeat with other vectors
    repeats = rows.groupBy("id").count().agg(F.max("count")).first()[0] or 1
    need = k + repeats
    every = cut(classes(rows, need))
    asked = members(vectors.where(is_query), id_col, vector_col, scale).distinct()
    asked = cut(asked.select(F.col("id").alias("query_id"), F.xxhash64("v").alias("key"), "v"))
    # equal queries are searched once
    wanted = asked.select("key", "v").distinct()
    queries = cut(every.join(wanted, ["key", "v"], "left_semi").select(F.col("class_id").alias("q"), "v"))

    stats = (every.select(F.posexplode("v").alias("d", "x")).groupBy("d")
             .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("n"),
                  F.percentile_approx("x", [i / cells for i in range(1, cells)], 4 * cells).alias("inner")).collect())
    n_rows, n_queries = every.count(), queries.count()
    answer = f"query_id {vectors.schema[id_col].dataType.simpleString()}, rank int, " \
             f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, score long"
    if not n_queries or not n_rows:
        return spark.createDataFrame([], answer)
    dims = max([1, *(r["d"] + 1 for r in stats)])
    borders = np.zeros((dims, cells + 1))
    for r in stats:  # one row per dimension; shorter vectors count as zero there
        own = [r["low"], *(r["inner"] or []), r["high"]]
        if r["n"] < n_rows:
            own[0], own[-1] = min(own[0], 0), max(own[-1], 0)
        borders[r["d"]] = np.maximum.accumulate(np.array(own, dtype=np.float64))
    grid = Cells(borders)

    def packer(coded):
        """Arrow function: all rows of a block number as packed rows."""
        def run(part: pa.Table) -> pa.Table:
            ids = part.column("id").to_numpy().astype("<i8").tobytes()
            rows = coded(_matrix(part.column("v"), dims)).tobytes()
            return pa.table({"b": part.column("b")[:1], "ids": pa.array([ids], pa.binary()),
                             "codes": pa.array([rows], pa.binary())})
        return run

    # a block holds a megabyte of cells, or two of queries, however many dimensions there are
    n_rb = math.ceil(n_rows / max(1, min(rows_per_block, (1 << 20) // dims)))
    n_qb = math.ceil(n_queries / max(1, min(queries_per_block, (1 << 18) // dims)))
    kind = every.schema["class_id"].dataType.simpleString()
    every_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    def blocks(table, id_col, n, coded):
        rows = table.select(F.pmod(F.xxhash64(id_col), F.lit(n)).alias("b"), F.col(id_col).alias("id"), "v")
        return cut(in_workers(rows).groupBy("b").applyInArrow(packer(coded), "b long, ids binary, codes binary"))

    row_side = (blocks(every, "class_id", n_rb, grid.code).withColumnRenamed("b", "rb").withColumn("qb", every_of(n_qb)))
    asks = blocks(queries, "q", n_qb, lambda v: v.astype("<i8")).withColumnRenamed("b", "qb")
    ask_side = asks.withColumn("rb", every_of(n_rb))

    def bounds(left, right):
        """Of some queries at a time: their places, products with the cells'
        middles, and how far the truth can be off."""
        middle, half = grid.around(_fixed(left, dims, np.uint8))
        q = _fixed(right, dims, "<i8").astype(np.float64)
        some = max(1, (1 << 21) // len(middle))
        for a in range(0, len(q), some):
            part = q[a:a + some]
            size = np.abs(part)
            yield a, part @ middle.T, size @ half.T + (1e-9 * (size @ grid.far + 1))[:, None]

    def lower(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.empty((0, 1))]
        if len(left) and len(right):
            keep = min(need, len(_ids(left)))
            found = [-np.partition(off - centre, keep - 1, axis=1)[:, :keep] for _, centre, off in bounds(left, right)]
        best = np.concatenate(found)
        ids = _ids(right) if len(best) else np.empty(0, dtype=np.int64)
        return pa.table({"q": pa.array(ids, pa.int64()), "best": pa.array(best.tolist(), pa.list_(pa.float64()))})

    lows = (row_side.groupBy("rb", "qb").cogroup(ask_side.groupBy("rb", "qb"))
            .applyInArrow(lower, f"q {kind}, best array<double>"))
    # k other rows are at least as good as the need-th best class, the query's own among them
    at = Window.partitionBy("q").orderBy(F.col("low").desc())
    levels = (lows.select("q", F.explode("best").alias("low")).withColumn("place", F.row_number().over(at))
              .where(F.col("place") <= need).groupBy("q")
              .agg(F.when(F.count(F.lit(1)) >= need, F.min("low")).otherwise(F.lit(float("-inf"))).alias("level")))
    levels = cut(levels)
    # levels go to their queries' block: a row of two numbers each
    level_side = (levels.groupBy(F.pmod(F.xxhash64("q"), F.lit(n_qb)).alias("qb"))
                  .agg(F.collect_list(F.struct("q", "level")).alias("levels")))  # of one block, bounded by its size
    ask_levels = asks.join(level_side, "qb").withColumn("rb", every_of(n_rb))

    def reach(left: pa.Table, right: pa.Table) -> pa.Table:
        asked, others, uppers = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], [np.empty(0)]
        if len(left) and len(right):
            own, ids = _ids(right), _ids(left)
            known = {x["q"]: x["level"] for x in right["levels"].to_pylist()[0]}
            level = np.array([known[q] for q in own.tolist()])
            for a, centre, off in bounds(left, right):
                upper = centre + off
                i, j = np.nonzero(upper >= level[a:a + len(upper), None])
                asked.append(own[a + i])
                others.append(ids[j])
                uppers.append(upper[i, j])
        return pa.table({"q": np.concatenate(asked), "c": np.concatenate(others), "upper": np.concatenate(uppers)})

    found = (row_side.groupBy("rb", "qb").cogroup(ask_levels.groupBy("rb", "qb"))
             .applyInArrow(reach, f"q {kind}, c {kind}, upper double"))
    by_bound = Window.partitionBy("q").orderBy(F.col("upper").desc(), "c")
    found = cut(found.withColumn("place", F.row_number().over(by_bound)))

    exact = every.select(F.col("class_id").alias("c"), F.col("v").alias("cv"), "ids")
    asking = queries.select("q", F.col("v").alias("qv"))

    def scored(rows):
        product = F.aggregate(F.zip_with("qv", "cv", lambda a, b: F.try_multiply(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0)))),
                              F.lit(0).cast("long"), lambda s, x: F.try_add(s, x))
        return (rows.join(exact, "c").join(asking, "q").withColumn("score", product)
                .where("score is not null").select("q", "c", "ids", "score"))

    first = cut(scored(found.where(F.col("place") <= 2 * k).select("q", "c")))
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "c")
    sure = (first.withColumn("place", F.row_number().over(best)).where(F.col("place") <= need).groupBy("q")
            .agg(F.when(F.count(F.lit(1)) >= need, F.min("score")).otherwise(F.lit(-(1 << 62))).alias("sure")))
    rest = found.where(F.col("place") > 2 * k).join(sure, "q").where(F.col("upper") >= F.col("sure")).select("q", "c")
    # equal scores are cut by id, not by class: all classes at the last score stay
    every_class = Window.partitionBy("q").orderBy(F.col("score").desc())
    hits = (first.unionByName(scored(rest)).withColumn("place", F.rank().over(every_class))
            .where(F.col("place") <= need)
            .select("q", "score", F.explode("ids").alias("id")))
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    lists = (hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= need)
             .groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id"))).alias("near")))
    lists = cut(lists.join(every.select(F.col("class_id").alias("q"), "key", "v"), "q").select("key", "v", "near"))

    mine = asked.join(lists, ["key", "v"])
    others = mine.select("query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit")["id"].alias(id_col),
        (-F.col("hit")["minus"]).alias("score"))
