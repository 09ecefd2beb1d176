"""Ranked lexical search by a dual-tree search.

An item's score of a document sums, over the item's terms, a weight times the
document's impact of that term: an inner product of two sparse vectors.  Both
sides get a hierarchy whose nodes hold the coordinate maxima of what is below.

* *Items* (the stated query set) meet all documents in blocks of at most
  ``block_terms`` terms, the only thing that is broadcast.  Items of like
  frequent terms form groups; a group holds the union of their terms.
* *Documents* keep only terms of the block's items.  They are range-partitioned
  by their leading terms, id and row number, so neither a common term nor a
  copied text is one task's, and packed in nodes of at most ``node_docs``
  documents, which are cut in leaves of ``leaf_docs``.
* *Search*: the product of the maxima bounds every score of a pair of nodes.  A
  pass over the nodes' maxima alone finds the nodes with the best bound for each
  item; scored first, they set each item's weakest k-th score.  Then all nodes
  are met: item groups, then items, then leaves whose bound stays below that
  score (which rises as the task goes on) are passed over whole, and only what
  is left is scored, exactly, in integers.

A task keeps k documents per item, and below the weakest k-th score none, so
what crosses the cluster does not grow with the documents.

Defined cases: a null or empty text has no terms: as a document it counts
nowhere, as an item it has no answer, like an item whose terms no document
holds; very long texts are read piece by piece; rows that repeat a document are
each ranked, rows that repeat an item are each answered; equal scores are
ranked by id, null ids last; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.angular import Best
from tillroll.llm.common import cut, in_workers
from tillroll.session import ensure_checkpoint_dir

#: Lower-cases A-Z and blanks every other byte that is no term character
#: (letters, digits and all bytes of characters from U+0080 on are).
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
#: Bytes of a text that are split at a time.
_PIECE = 1 << 20
#: Items of a group, and terms at which a group is closed.
_GROUP_ITEMS, _GROUP_TERMS = 32, 4096
#: Terms of the documents of a node (one document at least).
_NODE_TERMS = 1 << 18
#: Best-bounded nodes per item that are scored first.
_FIRST_NODES = 2
_NULL_ID = np.iinfo(np.int64).max
_ITEMS = "key long, terms array<binary>"
_VECTORS = "doc_id long, n long, terms binary, counts binary"
_LED = "first int, second int, doc_id long, terms binary, impacts binary"
_NODES = "node long, ids binary, nulls binary, sizes binary, terms binary, impacts binary, top_terms binary, top_impacts binary"
_FOUND = "key long, doc_id long, score long"


def pieces(text: bytes, most: int = _PIECE):
    """The words of a text, list by list."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        stop = folded.find(b" ", at + most)
        stop = len(folded) if stop < 0 else stop
        yield folded[at:stop].split()
        at = stop


def term_counts(text: bytes, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, and the known terms (sorted) with their counts."""
    n, found = 0, []
    for words in pieces(text):
        n += len(words)
        ids = [i for i in map(vocabulary.get, words) if i is not None]
        found.append(np.unique(np.array(ids, dtype=np.int64), return_counts=True))
    if len(found) == 1:
        return n, *found[0]
    if not found:
        return 0, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    terms, back = np.unique(np.concatenate([t for t, _ in found]), return_inverse=True)
    counts = np.zeros(len(terms), dtype=np.int64)
    np.add.at(counts, back, np.concatenate([c for _, c in found]))
    return n, terms, counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: int, n_docs: int, all_words: int) -> np.ndarray:
    """What one document gives for each weight of a term, in millionths."""
    m = 50 + 50 * n * n_docs // all_words
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class ItemTree:
    """Items of one block, in groups; a node's maximum at a term is the term's weight."""

    def __init__(self, keys: list[int], terms: list[list[int]], weights: np.ndarray):
        self.weights = weights
        like = sorted(range(len(keys)), key=lambda k: sorted(terms[k], key=lambda t: (weights[t], t))[:4])
        self.keys = np.array([keys[k] for k in like], dtype=np.int64)
        self.items = [np.array(sorted(terms[k]), dtype=np.int64) for k in like]
        self.groups: list[tuple[slice, np.ndarray]] = []  # items and the union of their terms
        start, union = 0, set()
        for k, own in enumerate(self.items):
            more = union | set(own.tolist())
            if k > start and (k - start == _GROUP_ITEMS or len(more) > _GROUP_TERMS):
                self._close(start, k, union)
                start, more = k, set(own.tolist())
            union = more
        if self.items:
            self._close(start, len(self.items), union)
        self.unions, self.starts = self._flat([u for _, u in self.groups])
        #: scores are sums of weights times at most a million: whole numbers that doubles hold, or else 64-bit integers
        most = max((int(weights[own].sum()) for own in self.items), default=0) * 1_000_000
        self.kind = np.float64 if most < 1 << 53 else np.int64

    def _close(self, start: int, stop: int, union: set[int]) -> None:
        self.groups.append((slice(start, stop), np.array(sorted(union), dtype=np.int64)))

    @staticmethod
    def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        return np.concatenate([np.zeros(0, dtype=np.int64), *lists]), np.cumsum(sizes) - sizes

    def group_bounds(self, top: np.ndarray) -> np.ndarray:
        """Upper bound per group, for ``top`` impacts by term."""
        return np.add.reduceat(self.weights[self.unions] * top[self.unions], self.starts)

    def matrix(self, group: int) -> np.ndarray:
        """Weights of the group's terms (rows) in each of its items (columns)."""
        items, union = self.groups[group]
        out = np.zeros((len(union), items.stop - items.start), dtype=self.kind)
        for column, own in enumerate(self.items[items]):
            out[np.searchsorted(union, own), column] = self.weights[own]
        return out


class Node:
    """One packed node of documents."""

    def __init__(self, row: dict, leaf_docs: int):
        self.ids, self.nulls = np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["nulls"], dtype=np.uint8)
        self.terms, self.impacts = np.frombuffer(row["terms"], dtype="<i4"), np.frombuffer(row["impacts"], dtype="<i4")
        sizes = np.frombuffer(row["sizes"], dtype="<i4")
        self.of = np.repeat(np.arange(len(self.ids)), sizes)
        self.leaf_starts = np.arange(0, len(self.ids), leaf_docs)

    def matrix(self, column_of: np.ndarray, columns: int, kind) -> np.ndarray:
        """Impacts of each document (rows) at the terms that have a column."""
        column = column_of[self.terms]
        known = column >= 0
        out = np.zeros((len(self.ids), columns), dtype=kind)
        out[self.of[known], column[known]] = self.impacts[known]
        return out


class Search:
    """The items' side, as every task holds it."""

    def __init__(self, tree: ItemTree, k: int, leaf_docs: int):
        self.tree, self.k, self.leaf_docs = tree, k, leaf_docs
        self.floor = np.ones(len(tree.keys), dtype=np.int64)  # scores of 0 are no answers
        self.floor_id = np.full(len(tree.keys), _NULL_ID)

    def top(self, row: dict) -> np.ndarray:
        out = np.zeros(len(self.tree.weights), dtype=np.int64)
        out[np.frombuffer(row["top_terms"], dtype="<i4")] = np.frombuffer(row["top_impacts"], dtype="<i4")
        return out

    def best_nodes(self, rows, keep: int):
        """Per item the nodes with the highest bounds: arrays of item, bound, node."""
        best = Best(len(self.tree.keys), keep)
        matrices = {}
        for row in rows:
            top = self.top(row)
            for g in np.flatnonzero(self.tree.group_bounds(top) > 0).tolist():
                items, union = self.tree.groups[g]
                if g not in matrices:
                    matrices[g] = self.tree.matrix(g)
                bound = (top[union].astype(self.tree.kind) @ matrices[g]).astype(np.int64)
                at = np.flatnonzero((bound > 0) & (bound > best.floor[items]))
                if len(at):
                    same = np.full(len(at), row["node"])
                    best.add(items.start + at, bound[at], same, same)
        return best.group, best.score, best.id

    def run(self, rows):
        """Per item the best documents: arrays of item key, doc id, whether the id is null, score."""
        tree = self.tree
        best = [Best(items.stop - items.start, self.k) for items, _ in tree.groups]
        matrices = {}
        column_of = np.full(len(tree.weights), -1, dtype=np.int64)
        for row in rows:
            top, node = self.top(row), None
            weakest = [self._floor(g, best[g])[0].min() for g in range(len(tree.groups))]
            for g in np.flatnonzero(tree.group_bounds(top) >= weakest).tolist():
                union = tree.groups[g][1]
                if g not in matrices:
                    matrices[g] = tree.matrix(g)
                floor, floor_id = self._floor(g, best[g])
                some = np.flatnonzero((top[union].astype(tree.kind) @ matrices[g]).astype(np.int64) >= floor)
                if not len(some):
                    continue
                node = node or Node(row, self.leaf_docs)
                column_of[union] = np.arange(len(union))
                docs = node.matrix(column_of, len(union), tree.kind)
                column_of[union] = -1
                self._score(node, docs, matrices[g][:, some], some, floor[some], floor_id[some], best[g])
        for (items, _), found in zip(tree.groups, best):
            yield tree.keys[items.start + found.group], found.id, found.key == 1, found.score

    def _floor(self, group: int, best: Best) -> tuple[np.ndarray, np.ndarray]:
        items = self.tree.groups[group][0]
        above = best.floor > self.floor[items]
        return np.where(above, best.floor, self.floor[items]), np.where(above, best.floor_id, self.floor_id[items])

    def _score(self, node, docs, weights, some, floor, floor_id, best) -> None:
        leaves = np.maximum.reduceat(docs, node.leaf_starts, axis=0)
        open_ = leaves @ weights >= floor
        within = open_.any(axis=1)[np.arange(len(docs)) // self.leaf_docs]
        at = np.flatnonzero(within)
        if not len(at):
            return
        wanted = open_.any(axis=0)
        score = (docs[at] @ weights[:, wanted]).astype(np.int64)
        floor, floor_id, ids = floor[wanted], floor_id[wanted], node.ids[at]
        hit = (score > floor) | ((score == floor) & (ids[:, None] <= floor_id))
        if len(at) > self.k:
            hit &= score >= np.partition(score, len(at) - self.k, axis=0)[len(at) - self.k]
        d, i = np.nonzero(hit)
        if len(d):
            best.add(some[np.flatnonzero(wanted)[i]], score[d, i], ids[d], node.nulls[at[d]].astype(np.int64))


def _each(batches):
    for b in batches:
        for at in range(b.num_rows):
            yield b.slice(at, 1).to_pylist()[0]


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, id and distinct terms of each item that has any."""
    rows = items.select(F.monotonically_increasing_id().alias("key"), F.col(f"`{id_col}`").alias("item_id"),
                        F.col(f"`{text_col}`").cast("binary").alias("text")).where("text is not null")
    kinds = T.StructType([*rows.schema.fields[:2], T.StructField("terms", T.ArrayType(T.BinaryType()))])

    def split(batches):
        for b in batches:
            terms = [sorted(set().union(*pieces(t.as_py()))) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("item_id"), pa.array(terms, pa.list_(pa.binary()))],
                                             names=kinds.names)

    return cut(in_workers(rows).mapInArrow(split, kinds).where(F.size("terms") > 0))


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    def read(batches):
        for b in batches:
            found = [term_counts(t.as_py() or b"", vocabulary.value) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([n for n, _, _ in found], pa.int64()),
                 pa.array([t.astype("<i4").tobytes() for _, t, _ in found], pa.binary()),
                 pa.array([c.astype("<i4").tobytes() for _, _, c in found], pa.binary())],
                names=["doc_id", "n", "terms", "counts"])

    return cut(in_workers(docs).mapInArrow(read, _VECTORS))


def _document_frequencies(vectors: DataFrame, n_terms: int) -> np.ndarray:
    def count(batches):
        df = np.zeros(n_terms, dtype=np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), dtype="<i4"), minlength=n_terms)
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(df[met], pa.int64())], names=["term", "df"])

    df = np.zeros(n_terms, dtype=np.int64)
    for r in vectors.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r["term"]] = r["df"]
    return df


def _nodes(vectors: DataFrame, weights: np.ndarray, n_docs: int, all_words: int, node_docs: int) -> DataFrame:
    def lead(batches):
        for b in batches:
            led = []
            for row in b.to_pylist():
                terms, counts = (np.frombuffer(row[c], dtype="<i4").astype(np.int64) for c in ("terms", "counts"))
                given = impacts(counts, row["n"], n_docs, all_words)
                gain = given * weights[terms]
                terms, given, gain = terms[gain > 0], given[gain > 0], gain[gain > 0]
                if len(terms):
                    most = terms[np.lexsort((terms, -gain))[:2]].tolist()
                    led.append((most[0], most[-1], row["doc_id"], terms.astype("<i4").tobytes(), given.astype("<i4").tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*led) if led else [[]] * 5, kinds)],
                                             names=["first", "second", "doc_id", "terms", "impacts"])

    def pack(batches):
        number = TaskContext.get().partitionId() << 40
        for b in batches:
            sizes = np.array([len(t) for t in b.column("terms").to_pylist()], dtype=np.int64) // 4
            at = 0
            while at < b.num_rows:
                stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:at + node_docs]), _NODE_TERMS, side="right")))
                part = b.slice(at, stop - at)
                ids = part.column("doc_id")
                terms, given = (np.frombuffer(b"".join(part.column(c).to_pylist()), dtype="<i4") for c in ("terms", "impacts"))
                order = np.argsort(terms, kind="stable")
                met, starts = np.unique(terms[order], return_index=True)
                values = [number, ids.fill_null(_NULL_ID).to_numpy().astype("<i8"), ids.is_null().to_numpy(False).astype(np.uint8),
                          sizes[at:stop].astype("<i4"), terms, given, met.astype("<i4"), np.maximum.reduceat(given[order], starts)]
                columns = [pa.array([values[0]], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in values[1:])]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _NODES.split(", ")])
                number, at = number + 1, stop

    order = ["first", "second", "doc_id", "row"]
    led = in_workers(vectors.where(F.octet_length("terms") > 0)).mapInArrow(lead, _LED).withColumn("row", F.monotonically_increasing_id())
    spread = led.repartitionByRange(*order).sortWithinPartitions(*order)
    folder = f"{ensure_checkpoint_dir(vectors.sparkSession)}/lexical_nodes/{uuid.uuid4()}"
    spread.mapInArrow(pack, _NODES).write.parquet(folder)
    return vectors.sparkSession.read.schema(_NODES).parquet(folder)


def _ranked(nodes: DataFrame, shared, k: int) -> DataFrame:
    def run(batches):
        for key, doc, null, score in shared.value.run(_each(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(doc, pa.int64(), mask=null),
                                              pa.array(score, pa.int64())], names=["key", "doc_id", "score"])

    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (in_workers(nodes).mapInArrow(run, _FOUND).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k))


def _first_nodes(nodes: DataFrame, shared) -> DataFrame:
    """The nodes that are scored first."""

    def run(batches):
        for_items = shared.value.best_nodes(_each(batches), _FIRST_NODES)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in for_items], names=["item", "bound", "node"])

    order = Window.partitionBy("item").orderBy(F.col("bound").desc(), "node")
    best = (in_workers(nodes.select("node", "top_terms", "top_impacts")).mapInArrow(run, "item long, bound long, node long")
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= _FIRST_NODES))
    return nodes.join(best.select("node").distinct(), "node", "left_semi")


def _rank_block(spark: SparkSession, items, docs: DataFrame, k: int, node_docs: int, leaf_docs: int) -> DataFrame | None:
    """key, rank, doc_id, score of one block of items (at most ``block_terms``
    terms, or one item); None without an answer."""
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*(r["terms"] for r in items))))}
    vectors = _vectors(docs, spark.sparkContext.broadcast(vocabulary))
    size = vectors.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("words")).first()
    if not size["n"]:
        return None
    df = _document_frequencies(vectors, len(vocabulary))
    weights = np.array([weight(size["n"], int(x)) for x in df], dtype=np.int64)
    nodes = _nodes(vectors, weights, size["n"], size["words"], node_docs)
    tree = ItemTree([r["key"] for r in items], [[vocabulary[t] for t in r["terms"]] for r in items], weights)
    search = Search(tree, k, leaf_docs)
    at = {key: n for n, key in enumerate(tree.keys.tolist())}
    first = _ranked(_first_nodes(nodes, spark.sparkContext.broadcast(search)), spark.sparkContext.broadcast(search), k)
    for r in first.where(F.col("rank") == k).collect():  # at most one row an item
        n = at[r["key"]]
        search.floor[n], search.floor_id[n] = r["score"], _NULL_ID if r["doc_id"] is None else r["doc_id"]
    return _ranked(nodes, spark.sparkContext.broadcast(search), k)


def rank(items: DataFrame, docs: DataFrame, k: int = 50, item_col: str = "item_id", doc_col: str = "doc_id",
         text_col: str = "text", block_terms: int = 1 << 20, node_docs: int = 512, leaf_docs: int = 32) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    asked = _item_terms(items, item_col, text_col)
    texts = docs.select(F.col(f"`{doc_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    blocks = math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms)
    folder, written = f"{ensure_checkpoint_dir(spark)}/lexical_ranks/{uuid.uuid4()}", False
    for b in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).collect()
        found = _rank_block(spark, some, texts, k, node_docs, leaf_docs) if some else None
        if found is not None:
            found.write.mode("append").parquet(folder)
            written = True
    kinds = "key long, doc_id long, score long, rank int"
    ranks = spark.read.schema(kinds).parquet(folder) if written else spark.createDataFrame([], kinds)
    return ranks.join(asked.select("key", "item_id"), "key").select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(doc_col), "score")
