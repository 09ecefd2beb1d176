"""SimHash near-duplicates by a self-join of the fingerprints' binary trie.

1. Fingerprints: one pass over the texts in Arrow batches (numpy inside the
   task, no shuffle).
2. Trie self-join over the *distinct* fingerprints.  The frontier of node
   pairs (a <= b, differing bits so far) starts at the root and goes down a
   few bits per round as Spark joins with the node counts of the next level;
   a pair whose differing bits exceed the budget is pruned.  A pair whose two
   subtrees hold at most ``pair_limit`` fingerprints leaves the frontier, and
   one task walks both subtrees together in numpy, again bit by bit with the
   same pruning.  A crowded subtree goes deeper, so no task gets more than
   ``pair_limit`` fingerprints at once.
3. A task returns a spanning forest of the links it finds (at most one edge
   per fingerprint), never all pairs; the components over those edges come
   from alternating star contractions.

Defined cases: a null or empty text, or one of blanks, has fingerprint zero
and is linked like any other; fewer words than the shingle length give one
shingle; a very long text is read whole, its shingles in bounded parts; a bit
that exactly half of the shingles set is zero; repeated rows get the same answer; a null id gets its component but
never names one (a component of null ids only has a null id); an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import cut, drop_rows, in_workers, small

BITS = 64
#: Shingles whose bits are counted at a time (bounds memory for long texts).
_BLOCK = 1 << 15
#: Node pairs walked, and fingerprint pairs compared, at a time.
_WALK = 1 << 19
_COMPARE = 1 << 21
#: Node pairs with at most this many fingerprint pairs are compared directly.
_LEAF = 64


# --- fingerprints -------------------------------------------------------

def fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: XXH64 (seed 42) of its
    shingles, a bit set where over half the hashes set it."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    n = len(words) - k + 1
    hashes = np.fromiter((digest(view[a:b], 42) for a, b in spans), dtype=np.uint64, count=n)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        block = np.ascontiguousarray(hashes[at:at + _BLOCK].astype(">u8")).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, content (64-bit hash of the text, to tell repeated ids apart), fp (the bits as a long)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("content"),
                       F.col(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)),
                                dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                                             names=["doc_id", "content", "fp"])

    schema = T.StructType([rows.schema["doc_id"], T.StructField("content", T.LongType()),
                           T.StructField("fp", T.LongType())])
    return in_workers(rows).mapInArrow(run, schema)


# --- inside one pair of subtrees ----------------------------------------

class _Forest:
    """Union-find over array positions; every label is its root's position."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := label[label], label):
                label[:] = up


def _levels(keys: np.ndarray, depth: int):
    """Per trie level from ``depth`` on, made when asked for: first key and
    size of each node, and its children with bit 0 and bit 1 (-1: none)."""
    made = []

    def nodes(d):
        if d == 0:
            first = np.zeros(1, dtype=np.int64)
        else:
            prefix = keys >> np.uint64(BITS - d)
            first = np.concatenate(([0], np.flatnonzero(prefix[1:] != prefix[:-1]) + 1))
        return first, np.diff(np.concatenate((first, [len(keys)])))

    def level(d):
        while len(made) <= d - depth:
            at = depth + len(made)
            first, size = made[-1][4] if made else nodes(at)
            if at == BITS:
                none = np.full(len(first), -1)
                made.append((first, size, none, none, None))
                continue
            below = nodes(at + 1)
            child = np.searchsorted(below[0], first)
            count = np.diff(np.concatenate((child, [len(below[0])])))
            bit = (keys[first] >> np.uint64(BITS - 1 - at)) & np.uint64(1)
            zero = np.where(bit == 0, child, -1)
            one = np.where(bit == 1, child, np.where(count == 2, child + 1, -1))
            made.append((first, size, zero, one, below))
        return made[d - depth]

    return level


def walk(keys: np.ndarray, depth: int, diff: int, budget: int) -> np.ndarray:
    """Labels (positions of roots) of the fingerprints linked within the
    budget.  ``keys``: sorted distinct fingerprints of one subtree (linked
    among themselves) or of two (linked across), whose roots lie at ``depth``
    and differ in ``diff`` bits."""
    forest, level = _Forest(len(keys)), _levels(keys, depth)
    last = len(level(depth)[0]) - 1
    stack = [(depth, np.array([0]), np.array([last]), np.array([diff]))]
    while stack:
        d, a, b, bits = stack.pop()
        if len(a) > _WALK:
            stack += [(d, a[s:s + _WALK], b[s:s + _WALK], bits[s:s + _WALK]) for s in range(0, len(a), _WALK)]
            continue
        first, size, zero, one, _ = level(d)
        small = size[a] * size[b] <= _LEAF if d < BITS else np.ones(len(a), dtype=bool)
        _compare(keys, forest, first, size, a[small], b[small], budget)
        a, b, bits = a[~small], b[~small], bits[~small]
        if not len(a):
            continue
        other = a != b
        parts = [(zero[a], zero[b], bits), (one[a], one[b], bits), (zero[a], one[b], bits + 1),
                 (one[a][other], zero[b][other], bits[other] + 1)]
        a, b, bits = (np.concatenate(x) for x in zip(*parts, strict=True))
        alive = (a >= 0) & (b >= 0) & (bits <= budget)
        if alive.any():
            stack.append((d + 1, a[alive], b[alive], bits[alive]))
    return forest.label


def _compare(keys, forest, first, size, a, b, budget):
    pairs = size[a] * size[b]
    cut_at = np.searchsorted(np.cumsum(pairs), np.arange(_COMPARE, pairs.sum() + _COMPARE, _COMPARE))
    begin = 0
    for end in np.unique(np.minimum(cut_at + 1, len(a))):
        x, y, n = a[begin:end], b[begin:end], pairs[begin:end]
        begin = end
        if not len(x):
            continue
        of = np.repeat(np.arange(len(x)), n)
        step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        i, j = first[x][of] + step // size[y][of], first[y][of] + step % size[y][of]
        near = (i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
        forest.link(i[near], j[near])


# --- the trie across tasks ----------------------------------------------

def _prefix(col: str, depth: int):
    return F.shiftrightunsigned(F.col(col), BITS - depth) if depth else F.lit(0).cast("long")


def links(fps: DataFrame, budget: int = 2, pair_limit: int = 16384, first_depth: int = 4, step: int = 2,
          small_rows: int = 100_000) -> DataFrame:
    """Edges that span the components of
    the distinct long column ``fp`` under Hamming distance <= ``budget``."""
    spark = fps.sparkSession
    frontier = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
                                     F.lit(0).cast("long").alias("diff"))
    frontier = cut(frontier)  # a table, not constants: the joins below stay equi-joins
    members, depth, below = None, 0, first_depth
    while depth < BITS:
        span, depth = min(below, BITS - depth), min(depth + below, BITS)
        below = step
        nodes = cut(fps.groupBy(_prefix("fp", depth).alias("node")).agg(F.count(F.lit(1)).alias("n")))
        up = F.shiftrightunsigned("node", span)
        left = nodes.select(F.col("node").alias("a2"), F.col("n").alias("na"), up.alias("a"))
        right = nodes.select(F.col("node").alias("b2"), F.col("n").alias("nb"), up.alias("b"))
        mask = F.lit((1 << span) - 1)
        pairs = (frontier.join(left, "a").join(right, "b")
                 .withColumn("diff", F.col("diff") + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")).bitwiseAND(mask)))
                 .where((F.col("diff") <= budget) & ((F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2"))))
                 .select(F.col("a2").alias("a"), F.col("b2").alias("b"), "diff",
                         F.when(F.col("a2") == F.col("b2"), F.col("na")).otherwise(F.col("na") + F.col("nb")).alias("n")))
        pairs = cut(pairs)
        deeper = (F.col("n") > pair_limit) if depth < BITS else F.lit(False)
        ready = pairs.where(~deeper & (F.col("n") > 1))
        n_ready = ready.count()
        if n_ready:
            ends = (ready.select("a", "b", "diff", F.explode(F.array_distinct(F.array("a", "b"))).alias("node")))
            ends = F.broadcast(ends) if n_ready <= small_rows else ends
            part = (fps.select("fp", _prefix("fp", depth).alias("node")).join(ends, "node")
                    .select(F.lit(depth).alias("depth"), "a", "b", "diff", "fp"))
            members = part if members is None else members.unionByName(part)
        frontier = pairs.where(deeper).select("a", "b", "diff")
        if frontier.isEmpty():
            break
    if members is None:
        return spark.createDataFrame([], "u long, v long")

    def run(table: pa.Table) -> pa.Table:
        keys = np.sort(table["fp"].to_numpy().view(np.uint64))
        label = walk(keys, table["depth"][0].as_py(), table["diff"][0].as_py(), budget)
        tied = np.flatnonzero(label != np.arange(len(keys)))
        return pa.table({"u": keys[tied].view(np.int64), "v": keys[label[tied]].view(np.int64)})

    return in_workers(members).groupBy("depth", "a", "b").applyInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge, by alternating star
    contractions.  Per round a node's smallest neighbour is a map-side
    combined minimum; it is joined back to the edges by broadcast where it is
    counted to be small, else by a join whose skew AQE can split, so a hub is
    never gathered."""
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut(edges.distinct())
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
        large = both.join(small(low), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = (large.join(small(low), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(low.select("u", F.col("m").alias("v"))))
        edges = cut(joined.where("u != v").distinct())
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Each node points to one other, which points nowhere."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
            .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.agg(F.coalesce(F.max((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))), F.lit(False))).first()[0] is False


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       budget: int = 2, pair_limit: int = 16384) -> DataFrame:
    """One row per document: doc_id, content, fp, component_id (the smallest
    id reachable over links of at most ``budget`` differing bits)."""
    marks = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = cut(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = cut(components(links(distinct.select("fp"), budget, pair_limit)))
    named = distinct.join(small(roots.withColumnRenamed("node", "fp")), "fp", "left")
    least = cut(named.where("root is not null").groupBy("root").agg(F.min("first_id").alias("least_id")))
    classes = named.join(small(least), "root", "left").select(
        "fp", F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("least_id")).alias("component_id"))
    return marks.join(classes, "fp").select("doc_id", "content", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                         budget: int = 2) -> DataFrame:
    """The documents with the smallest id of their component; all columns
    kept.  A row without an id stays; of rows that share the smallest id all
    with that id stay."""
    found = simhash_components(docs, id_col, text_col, shingle, budget)
    gone = cut(found.where("doc_id != component_id").select("doc_id", "content").distinct())
    return drop_rows(docs, gone, {"doc_id": F.col(f"`{id_col}`"),
                                  "content": F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))})
