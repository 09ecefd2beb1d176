"""License scans: templates are retrieved by MinHash bands over overlapping
text windows and verified by exact shingle containment.

A template of w words is compared with the windows of w words of each text
that begin every ``step`` words, w / 8 rounded up; windows overlap, so a copy
that starts anywhere lies within one up to an eighth of its words at the edges.  MinHash values
of a window's word shingles (five words; a shorter template is one shingle of
all its words) are banded; ``rows`` is one value per band and ``bands`` is the
smallest number that finds a pair of similarity ``least_similarity`` with
probability ``recall`` (1 - (1 - s^rows)^bands >= recall).  Retrieved pairs are
verified exactly: the share of the template's shingles that occur in the text
around the window must reach ``containment``.  A band is shared only where the
window holds the template's shingles of least hash, so windows without any such
shingle of the templates of their width are not banded: that loses no pair.

Templates are a parameter, a small table whose size is checked before it is
broadcast.  The registered ones are short notices, standard headers, SPDX
lines and full texts of common licenses (the package's ``licenses`` folder).  Windows are made and banded inside the task that reads a text, one
text at a time, so nothing but hits leaves a task, and no shuffle is needed.

Defined cases: a null or empty text has no hits; words are lower-cased runs
without blanks and marks like commas, points or brackets, and runs without a letter or
digit (comment marks) are none; templates without words and null ones
are ignored; hits of one license that overlap count once, the one with most shingles
first, of hits alike in that the one with the larger share, then the earlier, then
the one whose license's name comes first; a hit all of whose words belong to larger hits is a part of these and does
not count (a BSD-2 text in a BSD-3 one); a very long text is read whole, its windows
in bounded parts; rows that repeat get equal results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import math
from bisect import bisect
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import in_workers

#: Notices of common licenses.
SHORT = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
]


def packaged(folder: Path = Path(__file__).with_name("licenses")) -> list[tuple[str, str]]:
    """Notices and full texts (``license.txt`` or ``license.variant.txt``) of the package."""
    notices = [(name, text) for name, text in json.loads((folder / "notices.json").read_text("utf-8"))]
    return notices + [(p.stem.removesuffix(".regents"), p.read_text("utf-8")) for p in sorted(folder.glob("*.txt"))]


TEMPLATES = SHORT + packaged()

#: Bytes that end a word: blanks and punctuation that may stand around words.
_APART = np.zeros(256, dtype=bool)
_APART[[0x20, *range(0x09, 0x0E), *b".,;:!?\"'()[]{}<>*#|"]] = True
#: Bytes of letters and digits, those of any other script included.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(0x80, 0x100)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of each word of a lower-cased text."""
    each = np.frombuffer(text, dtype=np.uint8)
    inside = np.concatenate(([False], ~_APART[each], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    first, end = edges[0::2], edges[1::2]
    bare = np.flatnonzero(~_SOLID[each[first]])  # the few words that do not begin with a letter or digit
    none = [i for i in bare.tolist() if not _SOLID[each[first[i]:end[i]]].any()]
    return (np.delete(first, none), np.delete(end, none)) if none else (first, end)


@lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> np.ndarray:
    steps = np.full(1 << bits, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(text: bytes, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, by differences of one running sum."""
    n, bits = len(text), max(12, -(-(len(text) - 1).bit_length() // 4) * 4)  # few sizes: the powers are kept
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * _powers(_BASE, bits)[:n], out=sums[1:])
    return _stir((sums[end] - sums[first]) * _powers(_INVERSE, bits)[first])


def shingle_hashes(each: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order."""
    n = max(0, len(each) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + each[i:i + n]
    return _stir(total)


def bands_needed(similarity: float, rows: int, recall: float) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))) if similarity < 1 else 1


def _runs(text: bytes, first, end, size: int) -> list[tuple[bytes, ...]]:
    own = [text[a:b] for a, b in zip(first.tolist(), end.tolist(), strict=True)]
    return [tuple(own[i:i + size]) for i in range(len(own) - size + 1)]


class Finder:
    """Banded MinHash index of the templates."""

    def __init__(self, templates: list[tuple[str, str]], size: int, least_similarity: float, rows: int,
                 recall: float, containment: float):
        self.containment, self.rows = containment, rows
        self.bands = bands_needed(least_similarity, rows, recall)
        rng = np.random.default_rng(11)
        n = self.bands * rows
        self.a = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        #: per width in words and shingle size: name, shingles, their hashes and the band hashes of each template
        self.groups: dict[tuple[int, int], list] = {}
        least: dict[tuple[int, int], list] = {}
        for name, text in templates:
            raw = (text or "").encode().lower()
            first, end = words(raw)
            if name is None or not len(first):
                continue
            k = min(size, len(first))
            hashes = np.unique(shingle_hashes(word_hashes(raw, first, end), k))
            self.groups.setdefault((len(first), k), []).append(
                (name, set(_runs(raw, first, end, k)), hashes, self._bands(hashes[None, :])[0]))
            least.setdefault((len(first), k), []).append(self._least(hashes))
        #: per shingle size: the templates' shingles of least hash, and marks of their first bits
        self.known = {}
        for k in {k for _, k in least}:
            known = np.unique(np.concatenate([h for key, sets in least.items() if key[1] == k for h in sets]))
            shift = np.uint64(64 - max(16, len(known).bit_length() + 4))
            self.known[k] = known, shift, np.bincount(known >> shift, minlength=1 << (64 - int(shift))) > 0
        #: per group: which of the known are its own
        self.own = {key: np.isin(self.known[key[1]][0], np.concatenate(sets)) for key, sets in least.items()}

    def _held(self, every: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known shingles and their places among the known."""
        known, shift, marks = self.known[k]
        maybe = np.flatnonzero(marks[every >> shift])
        place = np.minimum(np.searchsorted(known, every[maybe]), len(known) - 1)
        same = known[place] == every[maybe]
        return maybe[same], place[same]

    def _least(self, hashes: np.ndarray) -> np.ndarray:
        """The shingles whose hashes are the least, one per hash function."""
        return np.unique([hashes[_stir(hashes * a + b).argmin()] for a, b in zip(self.a, self.b, strict=True)])

    def _bands(self, rows: np.ndarray) -> np.ndarray:
        """Band hashes of each row of shingle hashes (rows: sets of one size)."""
        out = np.empty((len(rows), self.bands), dtype=np.uint64)
        for band in range(self.bands):
            mixed = np.zeros(len(rows), dtype=np.uint64)
            for i in range(band * self.rows, (band + 1) * self.rows):
                low = _stir(rows * self.a[i] + self.b[i]).min(axis=1)
                mixed = (mixed ^ low) * np.uint64(_BASE) + np.uint64(band)
            out[:, band] = mixed
        return out

    def hits(self, text: bytes | None):
        """(template, containment, first byte, end byte) of the text's hits."""
        raw = (text or b"").lower()
        first, end = words(raw)
        if not len(first):
            return []
        each, out = word_hashes(raw, first, end), {}
        held = {}
        for k in self.known:
            every = shingle_hashes(each, k)
            held[k] = every, *self._held(every, k)
        for (width, k), members in self.groups.items():
            every, common, place = held[k]
            common = common[self.own[width, k][place]]
            if not len(common):
                continue
            per = min(width - k + 1, len(every))  # shingles of a window
            step, last = max(1, math.ceil(width / 8)), max(0, len(every) - per)
            # a window without any of these templates' least shingles shares no minimum with one
            n = last // step + 1
            begin = np.bincount(np.clip((common - per - step + 1) // step, 0, n), minlength=n + 1)
            stop = np.bincount(np.minimum(common // step + 1, n), minlength=n + 1)
            at = np.unique(np.append(np.flatnonzero(np.cumsum(begin - stop)[:n]) * step, last))
            block = max(1, (1 << 17) // per)
            for s in range(0, len(at), block):
                part = at[s:s + block]
                bands = self._bands(every[part[:, None] + np.arange(per)])
                for name, own, hashes, mine in members:
                    for w in part[(bands == mine).any(axis=1)].tolist():
                        low, high = max(0, w - step), min(len(every), w + per + step)
                        # equal shingles have equal hashes: too few of these rule a pair out before shingles are compared
                        if len(hashes) == len(own) and np.isin(hashes, every[low:high]).sum() < self.containment * len(own):
                            continue
                        runs = _runs(raw, first[low:high + k - 1], end[low:high + k - 1], k)
                        inside = [i for i, run in enumerate(runs) if run in own]
                        found = len({runs[i] for i in inside})
                        if found / len(own) >= self.containment:
                            out[name, found, found / len(own), low + inside[0], low + inside[-1] + k] = (
                                low + np.array(inside), k)
        kept, covered, ranges = [], np.zeros(len(first), dtype=bool), {}
        for hit in sorted(out, key=lambda h: (-h[1], -h[2], h[3], h[0])):
            name, _, share, a, b = hit
            starts, ends = ranges.setdefault(name, ([], []))
            i = bisect(starts, a)
            at, k = out[hit]
            at = (at[:, None] + np.arange(k)).ravel()
            if (i and ends[i - 1] > a) or (i < len(starts) and starts[i] < b) or covered[at].all():
                continue
            starts.insert(i, a)
            ends.insert(i, b)
            covered[at] = True
            kept.append((name, share, int(first[a]), int(end[b - 1])))
        return sorted(kept, key=lambda h: (h[2], h[0]))


def scan(docs: DataFrame, templates: list[tuple[str, str]] | DataFrame = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text", size: int = 5, least_similarity: float = 0.6, rows: int = 2, recall: float = 0.999,
         containment: float = 0.8, most_templates: int = 10_000) -> DataFrame:
    """doc_id, license, containment, start, end (code points) of every hit."""
    if isinstance(templates, DataFrame):
        some = templates.select("license", "text").limit(most_templates + 1).collect()
        if len(some) > most_templates:
            raise ValueError(f"more than {most_templates} templates; scan with parts of the table")
        templates = [(r["license"], r["text"]) for r in some]
    finder = docs.sparkSession.sparkContext.broadcast(
        Finder(templates, size, least_similarity, rows, recall, containment))
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    out = T.StructType([src.schema["doc_id"], T.StructField("license", T.StringType()),
                        T.StructField("containment", T.DoubleType()), T.StructField("start", T.LongType()),
                        T.StructField("end", T.LongType())])

    def run(batches):
        find = finder.value.hits
        for b in batches:
            at, rows_ = [], []
            for i, t in enumerate(b.column(1)):
                raw = t.as_py() or b""
                for name, share, s, e in find(raw):
                    first = len(raw[:s].decode())
                    at.append(i)
                    rows_.append((name, share, first, first + len(raw[s:e].decode())))
            columns = list(zip(*rows_, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, kind) for c, kind in zip(
                    columns, (pa.string(), pa.float64(), pa.int64(), pa.int64()), strict=True))], names=out.names)

    return in_workers(src).mapInArrow(run, out)
