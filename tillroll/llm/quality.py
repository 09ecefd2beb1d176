"""Quality classifier: random-indexing word vectors pooled per document, a
two-layer numpy network, probabilities calibrated by a temperature.

* Tokens are runs of letters (with numerals other than digits), digits or other marks, and a capitals mark for
  each capitalised word.  A token's bucket (a hash, one of 65,536: words that
  share one share its vectors) has a sparse ternary *index vector*; its *word
  vector* is the sum of the index vectors that stand within two tokens of it in
  all documents, shifted by side and distance.  Contexts need no labels, so no
  document is left out: each task sums its texts into one matrix of fixed size,
  and these sums are added by ranges of buckets.
* A document is the mean of its tokens' word vectors and index vectors, and
  how often a token recurs one to four tokens later (the mean product of index
  vectors bound across that distance).  Short texts shrink towards zero.
* The network (tanh layer, logistic output) trains on ``fit_rows`` labelled
  documents at most (a bounded sample, in hash order of the ids); every fifth
  of them is kept from training to stop it early and to fit the temperature.

What is learned has a fixed size (buckets x dimensions): a task sends that
much at most, without empty ranges and deflated.  Fitting is one pass over the
texts, scoring another, neither moves a text.  Only the network's fit is on a sample.

Defined cases: a null or empty text gets the network's score of the zero
vector; a null id counts as held out and is never learned from; an id with
contradicting labels is not learned from, and of rows that repeat an id one is;
labels that are null count as missing; with no labels, or a single class, every
score is the smoothed share of that class; an empty table gives an empty
result; very long texts are read whole, in bounded parts; of equal scores none
comes first, as nothing is ranked; other columns are kept or ignored, whatever
their names.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import cut, in_workers

BUCKETS, DIMS, NONZEROS, WINDOW, LAGS = 1 << 16, 64, 4, 2, 4
FEATURES = 2 * DIMS + LAGS + 3
#: Tokens: runs of letters, of digits and of other characters that are no white space.
_KINDS = (r"[^\W\d_]+", r"\d+", r"(?:[^\s\w]|_)+")
_RUN = re.compile("|".join((*_KINDS, r"\s+"))).match
#: Marks of a character: its kind, upper case, lower (or title) case, and those whose lower case is longer or hangs on the word (capital sigma).
_KIND, _UPPER, _LOWER, _IN_PYTHON, _SIGMA = 3, 4, 8, 16, 0x3A3
#: Buckets of the marks for capitalised words and words in capitals.
_FIRST, _ALL = (zlib.crc32(mark) % BUCKETS for mark in (b"\x01first", b"\x01all"))
#: Characters whose tokens are found at once, and bytes up to which tokens are hashed together.
_CHARS, _LONG = 1 << 18, 64
_SHRINK = 8.0
_AT_ONCE = 1 << 13
#: Tokens whose contexts are added at once, buckets of a range, and tokens after which a sum is sent on (so it fits 32 bits).
_GATHERED, _RANGE, _FLUSH = 1 << 18, 1 << 10, 1 << 27
#: Rows of a batch that are scored together.
_ROWS = 256


@lru_cache(maxsize=1)
def _marks() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vectors' nonzeros (seeded, the same
    everywhere); the last row is a mark between texts, all of its signs zero."""
    rng = np.random.default_rng(7)
    places = rng.integers(0, DIMS, (BUCKETS + 1, NONZEROS))
    signs = rng.choice(np.array([-1, 1], dtype=np.int32), (BUCKETS + 1, NONZEROS))
    signs[BUCKETS] = 0
    return places, signs


@lru_cache(maxsize=1)
def _moved() -> dict[int, np.ndarray]:
    """Places of the nonzeros, shifted by side and distance."""
    return {o: ((_marks()[0] + o) % DIMS).astype(np.int32) for o in range(-WINDOW, WINDOW + 1) if o}


@lru_cache(maxsize=1)
def index_vectors() -> np.ndarray:
    """Sparse ternary vectors of the buckets."""
    places, signs = _marks()
    index = np.zeros((BUCKETS, DIMS), dtype=np.int8)
    for i in range(NONZEROS):
        np.add.at(index, (np.arange(BUCKETS), places[:BUCKETS, i]), signs[:BUCKETS, i].astype(np.int8))
    return index


@lru_cache(maxsize=8)
def _characters(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the code points below 2 ** ``bits``: marks (the kind of token in the
    low bits), lower case, and its length in UTF-8."""
    every = "".join(map(chr, range(min(1 << bits, sys.maxunicode + 1))))
    marks = np.zeros(len(every), dtype=np.uint8)
    for kind, run in enumerate(_KINDS, 1):
        for found in re.finditer(run, every):
            marks[found.start():found.end()] = kind
    upper, lower, title = (np.fromiter(map(f, every), dtype=bool, count=len(every)) for f in (str.isupper, str.islower, str.istitle))
    marks[upper] |= _UPPER
    marks[(lower | title) & ~upper] |= _LOWER
    lowered = list(map(str.lower, every))
    marks[np.fromiter(map(len, lowered), dtype=np.int64, count=len(every)) > 1] |= _IN_PYTHON
    marks[_SIGMA] |= _IN_PYTHON
    lower = np.frombuffer("".join([c[0] for c in lowered]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    width = np.searchsorted((0x80, 0x800, 0x10000), lower, "right").astype(np.uint8) + np.uint8(1)
    width[0xD800:0xE000] = 1  # replaced
    return marks, lower, width


@lru_cache(maxsize=1)
def _crc_table() -> np.ndarray:
    """What each byte does to a CRC-32."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, crc >> 1 ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


def _crc32(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """zlib.crc32 of each ``size`` bytes of ``data`` from ``first``, byte by
    byte over all that are long enough."""
    short = np.minimum(size, _LONG + 1).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]
    at = first[order]
    reach = len(order) - np.searchsorted(short[order[::-1]], np.arange(1, _LONG + 2))  # of at least 1, 2, ... bytes
    crc, table, long = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32), _crc_table(), reach[_LONG]
    for k in range(_LONG):
        if reach[k] == long:
            break
        now = crc[long:reach[k]]
        now[:] = table[(now ^ data[at[long:reach[k]] + k]) & 0xFF] ^ now >> np.uint32(8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i, j in enumerate(order[:long].tolist()):
        crc[i] = zlib.crc32(data[first[j]:first[j] + size[j]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _tokens_at_once(texts: list[str]) -> list[np.ndarray]:
    """``buckets`` of texts that are short together."""
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if not len(points):
        return [np.zeros(0, dtype=np.int64) for _ in texts]
    marks_of, lower_of, width_of = _characters(max(14, int(points.max()).bit_length()))
    marks, lower = marks_of[points], lower_of[points]
    kind = marks & _KIND
    edges = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(points)]))
    tokens = np.flatnonzero(kind[edges[:-1]])
    first, last = edges[tokens], edges[tokens + 1]

    data = np.frombuffer(lower.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "replace"), dtype=np.uint8)
    at, end = first, last
    if len(data) > len(points):
        place = np.concatenate(([0], np.cumsum(width_of[points], dtype=np.int64)))
        at, end = place[first], place[last]
    own = (_crc32(data, at, end - at) % BUCKETS).astype(np.int64)
    for i in np.unique(np.searchsorted(first, np.flatnonzero(marks & _IN_PYTHON), "right") - 1).tolist():
        own[i] = zlib.crc32(joined[first[i]:last[i]].lower().encode("utf-8", "replace")) % BUCKETS

    capital = np.flatnonzero(marks[first] & _UPPER)
    small = np.concatenate(([0], np.cumsum(marks & _LOWER > 0, dtype=np.int64)))
    whole = (small[first[capital]] == small[last[capital]]) & (last[capital] - first[capital] > 1)
    found = np.insert(own, capital + 1, np.where(whole, _ALL, _FIRST))
    upto = np.searchsorted(first, np.cumsum([len(t) + 1 for t in texts]))
    return np.split(found, (upto + np.searchsorted(capital, upto))[:-1])


def buckets_of(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """Buckets of each text's tokens, in order.  Some ``_CHARS`` characters are
    taken at once: short texts together, long ones cut between tokens."""
    def pieces():
        for text in texts:
            text, a = text or "", 0
            while len(text) - a > _CHARS:
                b = _RUN(text, a + _CHARS - 1).end()
                yield text[a:b], False
                a = b
            yield text[a:], True

    def found(waiting):
        return zip(_tokens_at_once([piece for piece, _ in waiting]), [ends for _, ends in waiting], strict=True)

    def parts():
        waiting, held = [], 0
        for piece in pieces():
            waiting.append(piece)
            held += len(piece[0]) + 1
            if held > _CHARS:
                yield from found(waiting)
                waiting, held = [], 0
        if waiting:
            yield from found(waiting)

    text = []
    for part, ends in parts():
        text.append(part)
        if ends:
            yield text[0] if len(text) == 1 else np.concatenate(text)
            text = []


def buckets(text: str | None) -> np.ndarray:
    """Buckets of one text's tokens, in order."""
    return next(buckets_of([text]))


def add_contexts(total: np.ndarray, texts: list[np.ndarray]) -> None:
    """Add to each bucket's row of ``total`` (one more row than buckets) the
    index vectors around its occurrences, text by text."""
    signs, moved = _marks()[1], _moved()
    between = np.full(WINDOW, BUCKETS, dtype=np.int64)
    t = np.concatenate([part for text in texts for part in (text, between)])
    flat = total.reshape(-1)
    for a in range(0, len(t), _GATHERED):
        for o in range(1, WINDOW + 1):
            right = t[a + o:a + o + _GATHERED]
            pairs, times = np.unique(t[a:a + len(right)] * (BUCKETS + 1) + right, return_counts=True)
            left, right = pairs // (BUCKETS + 1), pairs % (BUCKETS + 1)
            times = times.astype(np.int32)[:, None]
            for own, other, shift in ((left, right, o), (right, left, -o)):
                at = (own * DIMS).astype(np.int32)[:, None] + moved[shift][other]
                np.add.at(flat, at.ravel(), (signs[other] * times).ravel())


def word_vectors(docs: DataFrame, text_col: str = "text", fit_tasks: int = 16) -> np.ndarray:
    """The buckets' word vectors, of length one (or zero), from all texts."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text")).where("text != ''")

    def contexts(batches):
        total, waiting, held, seen = np.zeros((BUCKETS + 1, DIMS), dtype=np.int32), [], 0, 0

        def sums():
            for a in range(0, BUCKETS, _RANGE):
                if total[a:a + _RANGE].any():
                    data = zlib.compress(total[a:a + _RANGE].tobytes(), 1)
                    yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([data], pa.binary())],
                                                     names=["first", "total"])
            total[:] = 0

        for b in batches:
            for found in buckets_of(text.as_py() for text in b.column("text")):
                waiting.append(found)
                held += len(found)
                if held >= _GATHERED:
                    add_contexts(total, waiting)
                    waiting, held, seen = [], 0, seen + held
                    if seen >= _FLUSH:
                        yield from sums()
                        seen = 0
        if waiting:
            add_contexts(total, waiting)
        yield from sums()

    def merged(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for first, data in zip(b.column("first").to_pylist(), b.column("total"), strict=True):
                part = np.frombuffer(zlib.decompress(data.as_py()), dtype=np.int32).reshape(-1, DIMS)
                sums[first] = sums[first] + part if first in sums else part.astype(np.int64)
        for first, total in sums.items():
            unit = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-6)
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int32()), pa.array([unit.astype("<f4").tobytes()], pa.binary())],
                                             names=["first", "total"])

    kind = "first int, total binary"
    vectors = np.zeros((BUCKETS, DIMS), dtype=np.float32)
    parts = in_workers(texts).mapInArrow(contexts, kind).repartition(fit_tasks, "first").mapInArrow(merged, kind)
    for row in parts.collect():  # one matrix of fixed size, in ranges
        vectors[row["first"]:row["first"] + _RANGE] = np.frombuffer(row["total"], dtype="<f4").reshape(-1, DIMS)
    return vectors


@dataclass
class Model:
    """Fitted classifier; ``constant`` is set where there was nothing to fit."""

    vectors: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    layers: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0
    constant: float | None = None

    def pool(self, t: np.ndarray) -> np.ndarray:
        n, index = len(t), index_vectors()
        if not n:
            return np.zeros(FEATURES, dtype=np.float32)
        words, plain, recur = np.zeros(DIMS), np.zeros(DIMS), np.zeros(LAGS)
        for a in range(0, n, _AT_ONCE):
            part = t[a:a + _AT_ONCE + LAGS]
            rows = index.take(part, 0).astype(np.float32)
            plain += rows[:_AT_ONCE].sum(0)
            words += self.vectors.take(part[:_AT_ONCE], 0).sum(0)
            for lag in range(1, LAGS + 1):  # whole numbers below 2 ** 24, so exact in any order
                recur[lag - 1] += np.dot(rows[:-lag][:_AT_ONCE].ravel(), rows[lag:][:_AT_ONCE].ravel()) if len(part) > lag else 0
        weight = 1.0 / (n + _SHRINK)
        length = float(np.linalg.norm(plain))
        return np.concatenate([words * weight, plain * weight, recur * weight / NONZEROS,
                               [np.log1p(n) / 10, length * weight, np.log1p(length / np.sqrt(n))]]).astype(np.float32)

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh(((x - self.mean) / self.spread) @ w1 + b1) @ w2 + b2[0]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if not texts:
            return np.zeros(0)
        x = np.stack([self.pool(t) for t in buckets_of(texts)]).astype(np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, check: np.ndarray, hidden: int = 32, epochs: int = 40,
          rate: float = 2e-3, decay: float = 1e-3, batch: int = 256, seed: int = 3) -> Model:
    """Fit the network on the rows outside ``check``; the rows inside stop the
    training at their lowest loss and set the temperature."""
    learn = ~check
    model = Model(mean=x[learn].mean(0), spread=x[learn].std(0) + 1e-6)
    z, target = (x[learn] - model.mean) / model.spread, y[learn]
    rng = np.random.default_rng(seed)
    size = z.shape[1]
    layers = [rng.normal(0, size ** -0.5, (size, hidden)), np.zeros(hidden),
              rng.normal(0, hidden ** -0.5, hidden), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    best, step = np.inf, 0

    def loss(logit, label):
        return float(np.mean(np.logaddexp(0, logit) - label * logit))

    for _ in range(epochs):
        order = rng.permutation(len(z))
        for a in range(0, len(z), batch):
            rows, step = order[a:a + batch], step + 1
            h = np.tanh(z[rows] @ layers[0] + layers[1])
            slope = (1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3][0], -40, 40))) - target[rows]) / len(rows)
            back = np.outer(slope, layers[2]) * (1 - h * h)
            gradients = [z[rows].T @ back + decay * layers[0], back.sum(0), h.T @ slope + decay * layers[2],
                         np.array([slope.sum()])]
            for p, m, v, g in zip(layers, first, second, gradients, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        model.layers, held = [p.copy() for p in layers], x[check] if check.any() else x
        now = loss(model.logits(held), y[check] if check.any() else y)
        if now < best:
            best, kept = now, model.layers
    model.layers = kept
    logit, label = (model.logits(x[check]), y[check]) if check.any() else (model.logits(x), y)
    ones = label.sum()
    soft = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))  # a perfect split gives no certainty
    grid = np.exp(np.linspace(np.log(0.25), np.log(16), 121))
    model.temperature = float(min(grid, key=lambda t: loss(logit / t, soft)))
    return model


def learnable(id_col: Column) -> Column:
    """Ids that labels may be learned from (the others are held out)."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 != 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", fit_rows: int = 20_000, fit_tasks: int = 16) -> Model:
    """Word vectors from all documents, the network from ``fit_rows`` labelled
    ones at most."""
    spark = docs.sparkSession
    marks = (labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .where(learnable(F.col("doc_id")) & F.col("label").isNotNull())
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
             .where("label = other and label in (0, 1)").drop("other"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    texts = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
             .join(F.broadcast(chosen), "doc_id"))  # bounded by fit_rows

    def tokens(batches):
        for b in batches:
            ids = pa.array([t.astype("<u2").tobytes() for t in buckets_of(t.as_py() for t in b.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), ids], names=["doc_id", "label", "t"])

    fields = [texts.schema["doc_id"], T.StructField("label", T.IntegerType()), T.StructField("t", T.BinaryType())]
    sample = cut(in_workers(texts).mapInArrow(tokens, T.StructType(fields))
                 .repartition(fit_tasks, "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("t").alias("t")))

    model = Model(vectors=word_vectors(docs, text_col, fit_tasks))

    def pooled(batches):
        for b in batches:
            x = [model.pool(np.frombuffer(t.as_py(), dtype="<u2").astype(np.int64)).tobytes() for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(x, pa.binary())],
                                             names=["doc_id", "label", "x"])

    fields[2] = T.StructField("x", T.BinaryType())
    rows = sample.mapInArrow(pooled, T.StructType(fields)).collect()  # bounded by fit_rows
    rows.sort(key=lambda r: r["doc_id"])
    y = np.array([r["label"] for r in rows], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return Model(constant=float((y.sum() + 1) / (len(y) + 2)))
    x = np.stack([np.frombuffer(r["x"], dtype=np.float32) for r in rows]).astype(np.float64)
    check = np.array([zlib.crc32(f"check {r['doc_id']}".encode()) % 5 == 0 for r in rows])
    if len(set(y[~check].tolist())) < 2 or not check.any():
        check[:] = False
    trained = train(x, y, check)
    trained.vectors = model.vectors
    return trained


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column of quality probabilities."""
    kept = [c for c in docs.columns if c != score_col]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    out = T.StructType([*rows.schema.fields, T.StructField(score_col, T.DoubleType())])
    at, shared = kept.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, _ROWS):
                part = b.slice(a, _ROWS)
                found = shared.value.scores(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.float64())], names=out.names)

    return in_workers(rows).mapInArrow(run, out)


def accept(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The documents whose score reaches ``least``, with their own columns."""
    mark = "__quality_score"
    return score(docs, model, text_col, mark).where(F.col(mark) >= least).drop(mark)
