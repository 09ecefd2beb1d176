"""Hard-negative mining with an angular triangle filter.

Vectors are integers (floor of ``scale`` times each component), scores integer
inner products.  An anchor's positives are its best other rows of the same
label; each positive's score sets a window (``low`` to ``high`` percent of it)
in which the best rows of other labels are the hard negatives.

* *Stored angles*: each row keeps its norm and its angles to a few reference
  directions (chosen far apart on a bounded sample; they decide the work, never
  the result).  Rows are range-partitioned by label, nearest direction, angle,
  id and row number, so no label or copied vector is one task's, and packed in
  blocks of ``rows_per_block``.
* *Cosine intervals*: by the triangle inequality on the sphere an angle between
  anchor and row lies between the difference and the sum of their angles to any
  direction.  Times the norms, and widened beyond any rounding error, this
  bounds the score of a row, and with the ranges of a block that of its rows.
* *Windows*: blocks, then rows, whose interval misses every open window of an
  anchor (a window's lower end rises to its k-th best score so far) are passed
  over; the rest, and only they, get integer scores.

Anchors are the stated query set: they meet all rows in chunks of at most
``chunk_bytes``, the only thing that is broadcast, and each chunk takes two
passes over the blocks, for positives and for negatives.  Each first takes one
block in ``_SEED`` alone: the k-th best score and id found there are a sure floor
for each window, so of all blocks only about ``_SEED`` times k rows a window are
left to cross the cluster, however many tasks and copies there are.  The result
of a chunk is written to the shared checkpoint folder.

Defined cases: rows with a null id, a null label, a null vector, or a component
that is null or not finite (also after scaling) take no part; a shorter vector
counts as padded with zeros; every row counts, so rows that repeat an id, or
everything, are each candidates, and each an anchor with results of its own; a
row is never its own positive; of equal scores the smaller id comes first; a
positive with a negative score has no negatives, one with score 0 those of
score 0; a score beyond 64 bits counts as the nearest 64-bit number; an empty
table, or one without anchors, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import cut, in_workers
from tillroll.session import ensure_checkpoint_dir

#: Anchors that are scored together.
_SLICE = 256
#: One block of so many sets the floors of a pass.
_SEED = 32
#: What float32 angles and their cosines can be off, with room to spare.
_ANGLE_SLACK, _SCORE_SLACK = 4e-6, 1e-6
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_ROWS = "id long, label string, anchor boolean, ref int, angle float, norm double, angles binary, v binary"
_BLOCKS = "first long, ids binary, labels array<string>, anchors binary, norms binary, angles binary, vectors binary"
_ANCHORS = "key long, id long, label string, norm double, angles binary, v binary"
_FOUND = "a int, w int, score long, id long, key long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Shape:
    """How vectors are stored and multiplied."""
    dims: int
    scale: float
    kind: str       # numpy type of a stored component
    largest: int    # no component is larger in size

    @staticmethod
    def of(dims: int, scale: float, largest: float) -> Shape:
        most = math.floor(scale * largest) + 1
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
        return Shape(max(1, dims), scale, kind, most)

    def stored(self, column) -> np.ndarray:
        """The vectors of a list column as integers, padded with zeros."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        sizes = np.diff(column.offsets.to_numpy())
        values = np.floor(self.scale * column.flatten().to_numpy(zero_copy_only=False))
        out = np.zeros((len(sizes), self.dims))
        at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(np.arange(len(sizes)), sizes), at] = values
        return out

    def unpack(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, dtype=self.kind).reshape(-1, self.dims)

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact integer inner products of all rows of a and b: in doubles or
        64-bit integers where they hold every partial sum, else in integers of
        any length, set to the nearest of 64 bits."""
        most = self.dims * self.largest ** 2
        if most < 1 << 53:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        if most < 1 << 63:
            return a.astype(np.int64) @ b.astype(np.int64).T
        whole = np.frompyfunc(int, 1, 1)
        return np.clip(whole(a) @ whole(b).T, _LEAST, _MOST).astype(np.int64)


def angles_to(v: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to each reference (0 for a vector without direction)."""
    size = np.abs(v).max(axis=1, initial=0.0)
    unit = v / np.where(size > 0, size, 1.0)[:, None]
    length = np.sqrt((unit * unit).sum(axis=1))
    cosine = (unit / np.where(length > 0, length, 1.0)[:, None]) @ references.T
    with np.errstate(over="ignore"):
        return size * length, np.where(length[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), 0).astype("<f4")


def score_interval(norm_a, angle_a, norms, angles) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the score of each anchor with each row or
    block.  ``norms`` and ``angles`` are pairs (least, most)."""
    near = np.zeros((len(norm_a), len(norms[0])), dtype=np.float32)
    far = np.full(near.shape, np.pi, dtype=np.float32)
    for j in range(angle_a.shape[1]):
        mine, least, most = angle_a[:, j, None], angles[0][:, j], angles[1][:, j]
        np.maximum(near, mine - most, out=near)
        np.maximum(near, least - mine, out=near)
        np.minimum(far, mine + most, out=far)
        np.minimum(far, np.float32(2 * np.pi) - mine - least, out=far)
    best = np.cos(np.clip(near - np.float32(_ANGLE_SLACK), 0, np.pi)).astype(np.float64)
    worst = np.cos(np.clip(far + np.float32(_ANGLE_SLACK), 0, np.pi)).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        short, long_ = norm_a[:, None] * norms[0], norm_a[:, None] * norms[1]
        room = _SCORE_SLACK * long_ + 1
        upper = np.where(best >= 0, long_, short) * best + room
        lower = np.where(worst >= 0, short, long_) * worst - room
    edge = 2.0 ** 63
    upper = np.where(np.isfinite(upper), np.minimum(upper, edge), edge)
    return np.where(np.isfinite(lower), np.clip(lower, -edge, edge), -edge), np.maximum(upper, -edge)


def far_apart(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` directions of the sample, each the farthest from those before."""
    size = np.abs(sample).max(axis=1, initial=0.0)
    unit = sample[size > 0] / size[size > 0, None]
    unit = unit / np.sqrt((unit * unit).sum(axis=1))[:, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    chosen = [unit[0]]
    nearest = unit @ unit[0]
    while len(chosen) < n and nearest.min() < 1 - 1e-9:
        chosen.append(unit[nearest.argmin()])
        nearest = np.maximum(nearest, unit @ chosen[-1])
    return np.array(chosen)


class Best:
    """The ``keep`` best (score, then smaller id) per group, of ``n`` groups."""

    def __init__(self, n: int, keep: int):
        self.n, self.keep = n, keep
        self.floor, self.floor_id = np.full(n, _LEAST), np.full(n, _MOST)
        self.group, self.score, self.id, self.key = (np.zeros(0, dtype=np.int64) for _ in range(4))

    def add(self, group, score, id_, key) -> None:
        group, score = np.concatenate([self.group, group]), np.concatenate([self.score, score])
        id_, key = np.concatenate([self.id, id_]), np.concatenate([self.key, key])
        order = np.lexsort((key, id_, ~score, group))  # ~score falls as score rises, without overflow
        group = group[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        order, group = order[place < self.keep], group[place < self.keep]
        self.group, self.score, self.id, self.key = group, score[order], id_[order], key[order]
        full = np.flatnonzero(np.bincount(group, minlength=self.n) == self.keep)
        last = np.searchsorted(group, full, side="right") - 1
        self.floor[full], self.floor_id[full] = self.score[last], self.id[last]


class Chunk:
    """Anchors that meet all rows together, ordered by label."""

    def __init__(self, rows, shape: Shape):
        rows = sorted(rows, key=lambda r: (r["label"], r["key"]))
        self.shape = shape
        self.keys = np.array([r["key"] for r in rows], dtype=np.int64)
        self.ids = np.array([r["id"] for r in rows], dtype=np.int64)
        self.code_of = {label: c for c, label in enumerate(dict.fromkeys(r["label"] for r in rows))}
        self.codes = np.array([self.code_of[r["label"]] for r in rows], dtype=np.int64)
        self.norms = np.array([r["norm"] for r in rows])
        self.angles = np.array([np.frombuffer(r["angles"], dtype="<f4") for r in rows])
        self.vectors = np.concatenate([shape.unpack(r["v"]) for r in rows])

    def search(self, blocks, low: np.ndarray, low_id: np.ndarray, high: np.ndarray, keep: int, same: bool):
        """Per anchor and window (column of ``low`` and ``high``, both
        included, but at ``low`` only ids up to ``low_id``) the best ``keep``
        rows of the same or of other labels: arrays of anchor, window, score,
        id, row key."""
        windows = low.shape[1]
        slices = [slice(at, at + _SLICE) for at in range(0, len(self.keys), _SLICE)]
        best = [Best(len(self.keys[s]) * windows, keep) for s in slices]
        for block in blocks:
            first = block["first"]
            ids, norms = np.frombuffer(block["ids"], dtype="<i8"), np.frombuffer(block["norms"], dtype="<f8")
            angles = np.frombuffer(block["angles"], dtype="<f4").reshape(len(ids), -1)
            codes = np.array([self.code_of.get(label, -1) for label in block["labels"]])
            vectors = self.shape.unpack(block["vectors"])
            for s, top in zip(slices, best):
                mine = np.unique(self.codes[s])
                fits = np.isin(codes, mine) if same else ~np.isin(codes, mine) if len(mine) == 1 else np.ones(len(ids), bool)
                rows = np.flatnonzero(fits)
                if not len(rows):
                    continue
                above = top.floor.reshape(-1, windows) > low[s]
                floor = (np.where(above, top.floor.reshape(-1, windows), low[s]),
                         np.where(above, top.floor_id.reshape(-1, windows), low_id[s]))
                self._score(s, top, windows, keep, same, *floor, high[s], rows, first + rows, ids[rows], codes[rows],
                            norms[rows], angles[rows], vectors)
        for s, top in zip(slices, best):
            yield s.start + top.group // windows, top.group % windows, top.score, top.id, top.key

    def _score(self, s, top, windows, keep, same, floor, floor_id, high, rows, keys, ids, codes, norms, angles, vectors) -> None:
        def overlap(lower, upper, least, most):
            found = np.zeros(lower.shape, dtype=bool)
            for w in range(windows):
                if (least[:, w] <= most[:, w]).any():
                    found |= (upper >= least[:, w, None]) & (lower <= most[:, w, None]) & (least[:, w] <= most[:, w])[:, None]
            return found

        whole = ((norms.min(keepdims=True), norms.max(keepdims=True)),
                 (angles.min(axis=0, keepdims=True), angles.max(axis=0, keepdims=True)))
        some = np.flatnonzero(overlap(*score_interval(self.norms[s], self.angles[s], *whole), floor, high)[:, 0])
        if not len(some):
            return
        at = s.start + some
        wanted = overlap(*score_interval(self.norms[at], self.angles[at], (norms, norms), (angles, angles)),
                         floor[some], high[some])
        wanted &= (self.codes[at, None] == codes) == same
        wanted &= self.keys[at, None] != keys
        i, j = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        if not len(i):
            return
        wanted, some = wanted[np.ix_(i, j)], some[i]
        score = self.shape.scores(self.vectors[s.start + some], vectors[rows[j]])
        for w in range(windows):
            least = floor[some, w, None]
            hit = wanted & (score >= least) & (score <= high[some, w, None])
            hit &= (score > least) | (ids[j] <= floor_id[some, w, None])
            if hit.shape[1] > keep:  # no row below the block's own k-th score can be among the best
                inside = np.where(hit, score, _LEAST)
                hit &= inside >= np.partition(inside, hit.shape[1] - keep, axis=1)[:, hit.shape[1] - keep, None]
            a, r = np.nonzero(hit)
            if len(a):
                top.add(some[a] * windows + w, score[a, r], ids[j[r]], keys[j[r]])


def usable(vector: Column, scale: float) -> Column:
    """Neither null nor holding a component that is null or not finite, itself or scaled."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(F.lit(scale) * x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(wrong, F.lit(True))


def blocks_of(rows: DataFrame, shape: Shape, references: np.ndarray, rows_per_block: int) -> DataFrame:
    """Packed blocks of rows that lie near each other."""

    def describe(batches):
        for b in batches:
            v = shape.stored(b.column("x"))
            norms, angles = angles_to(v, references)
            nearest = angles.argmin(axis=1)
            columns = [*(b.column(c) for c in ("id", "label", "anchor")), pa.array(nearest, pa.int32()),
                       pa.array(angles[np.arange(len(v)), nearest], pa.float32()), pa.array(norms, pa.float64()),
                       pa.array([a.tobytes() for a in angles], pa.binary()),
                       pa.array([x.tobytes() for x in v.astype(shape.kind)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "anchor", "ref", "angle", "norm", "angles", "v"])

    def pack(batches):
        first = TaskContext.get().partitionId() << 40
        for b in batches:
            for at in range(0, b.num_rows, rows_per_block):
                part = b.slice(at, rows_per_block)
                ids = part.column("id").to_numpy().astype("<i8")
                anchors = np.array(part.column("anchor").to_pylist(), dtype=np.uint8)
                values = [first, ids.tobytes(), part.column("label").to_pylist(), anchors.tobytes(),
                          part.column("norm").to_numpy().astype("<f8").tobytes(),
                          b"".join(part.column("angles").to_pylist()), b"".join(part.column("v").to_pylist())]
                kinds = [pa.int64(), pa.binary(), pa.list_(pa.string()), *[pa.binary()] * 4]
                names = ["first", "ids", "labels", "anchors", "norms", "angles", "vectors"]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds)], names=names)
                first += part.num_rows

    order = ["label", "ref", "angle", "id", "row"]
    near = in_workers(rows).mapInArrow(describe, _ROWS).withColumn("row", F.monotonically_increasing_id())
    return cut(near.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, _BLOCKS))


def _anchors(batches):
    for b in batches:
        for block in b.to_pylist():
            at = np.flatnonzero(np.frombuffer(block["anchors"], dtype=np.uint8))
            if len(at):
                n = len(block["anchors"])
                pieces = {c: len(block[c]) // n for c in ("angles", "vectors")}
                ids, norms = np.frombuffer(block["ids"], dtype="<i8"), np.frombuffer(block["norms"], dtype="<f8")
                cells = [[block[c][k * i:k * (i + 1)] for i in at] for c, k in pieces.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["first"] + at, pa.int64()), pa.array(ids[at], pa.int64()),
                     pa.array([block["labels"][i] for i in at], pa.string()), pa.array(norms[at], pa.float64()),
                     *(pa.array(c, pa.binary()) for c in cells)], names=["key", "id", "label", "norm", "angles", "v"])


def _search(blocks: DataFrame, shared, low: np.ndarray, high: np.ndarray, keep: int, same: bool) -> DataFrame:
    """The best ``keep`` of each anchor and window, of all blocks, with ``place`` from 1."""
    seeds = blocks.where(F.pmod(F.xxhash64("first"), F.lit(_SEED)) == 0)
    floor, floor_id = low.copy(), np.full(low.shape, _MOST)
    for r in _best(seeds, shared, low, floor_id, high, keep, same).where(F.col("place") == keep).collect():
        floor[r["a"], r["w"]], floor_id[r["a"], r["w"]] = r["score"], r["id"]
    return _best(blocks, shared, floor, floor_id, high, keep, same)


def _best(blocks: DataFrame, shared, low, low_id, high, keep: int, same: bool) -> DataFrame:
    def run(batches):
        stream = (block for b in batches for block in b.to_pylist())
        for found in shared.value.search(stream, low, low_id, high, keep, same):
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(found, kinds)],
                                             names=["a", "w", "score", "id", "key"])

    order = Window.partitionBy("a", "w").orderBy(F.col("score").desc(), "id", "key")
    return (in_workers(blocks).mapInArrow(run, _FOUND).withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= keep))


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", scale: float = 256.0, positives: int = 5, negatives: int = 10, low: int = 30,
         high: int = 90, references: int = 8, rows_per_block: int = 4096, chunk_bytes: int = 8 << 20) -> DataFrame:
    """Per anchor (rows where ``is_anchor`` holds) and positive the hard
    negatives: anchor_id, positive_id, rank, negative_id and both scores."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    rows = rows.where("id is not null and label is not null").where(usable(F.col("x"), scale))
    size = rows.agg(F.max(F.size("x")).alias("dims"),
                    F.max(F.array_max(F.transform("x", lambda x: F.abs(x)))).alias("largest")).first()
    if size["dims"] is None:
        return spark.createDataFrame([], RESULT)
    shape = Shape.of(size["dims"], scale, size["largest"] or 0.0)
    sample = rows.select("x", F.xxhash64("id", "x").alias("h")).orderBy("h").limit(1024).collect()
    points = np.zeros((len(sample), shape.dims))
    for point, r in zip(points, sample):
        point[:len(r["x"])] = np.floor(scale * np.array(r["x"], dtype=np.float64))
    blocks = blocks_of(rows, shape, far_apart(points, references), rows_per_block)

    asked = cut(blocks.mapInArrow(_anchors, _ANCHORS))
    per_chunk = max(1, chunk_bytes // (shape.dims * np.dtype(shape.kind).itemsize + 4 * references + 100))
    chunks = math.ceil(asked.count() / per_chunk)
    folder = f"{ensure_checkpoint_dir(spark)}/hard_negatives/{uuid.uuid4()}"
    for c in range(chunks):
        some = asked.where(F.pmod(F.xxhash64("key"), F.lit(chunks)) == c).collect()
        if some:
            chunk = Chunk(some, shape)
            shared = spark.sparkContext.broadcast(chunk)
            _mine_chunk(blocks, chunk, shared, positives, negatives, low, high).write.mode("append").parquet(folder)
            shared.unpersist()
    return spark.read.schema(RESULT).parquet(folder) if chunks else spark.createDataFrame([], RESULT)


def _mine_chunk(blocks: DataFrame, chunk: Chunk, shared, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    n = len(chunk.keys)
    every = np.full((n, 1), _LEAST), np.full((n, 1), _MOST)
    near = _search(blocks, shared, *every, positives, same=True).collect()  # at most ``positives`` rows an anchor
    least, most = np.full((n, positives), _MOST), np.full((n, positives), _LEAST)
    ids, scores = np.zeros((n, positives), dtype=np.int64), np.zeros((n, positives), dtype=np.int64)
    for r in near:
        a, w, score = r["a"], r["place"] - 1, r["score"]
        ids[a, w], scores[a, w] = r["id"], score
        least[a, w], most[a, w] = -(-low * score // 100), high * score // 100
    found = _search(blocks, shared, least, most, negatives, same=False)
    pairs = pa.table({"a": pa.array(np.repeat(np.arange(n), positives), pa.int32()),
                      "w": pa.array(np.tile(np.arange(positives), n), pa.int32()),
                      "anchor_id": np.repeat(chunk.ids, positives), "positive_id": ids.ravel(), "positive_score": scores.ravel()})
    named = blocks.sparkSession.createDataFrame(pairs.to_pandas(), "a int, w int, anchor_id long, positive_id long, positive_score long")
    return found.join(named, ["a", "w"]).select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
