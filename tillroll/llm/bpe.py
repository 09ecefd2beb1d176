"""BPE encoding and decoding by speculation and verification.

Texts stream through Arrow batches.  The words of a batch that the task has
not met yet are encoded together:

* *speculate*: greedy longest match proposes tokens for each word;
* *verify*: a proposal is the BPE encoding exactly when no merge ever crosses
  the border of two adjacent tokens.  One vectorised check unwinds all
  distinct adjacent pairs at once, back in merge order: at each border it asks
  whether the two pieces then touching it would have merged before one of
  them was merged away;
* *repair*: only words with a failing border are merged exactly.

The check relies on every token being made by one merge that comes after the
merges of its parts, which is tested when a tokenizer is loaded; tokens that
do not encode to themselves are never proposed.

Words come from the tokenizer file's own normaliser and splitter.  Texts of
plain Latin characters take an equal shortcut (one regular expression), all
others and those that hold a special token go through the tokenizers library's
normaliser and pre-tokenizer; merging and decoding are done here for all.

Defined cases: a null or empty text has no ids and decodes to an empty text;
very long texts are encoded whole; repeated rows get equal results; an empty
table gives an empty result; other columns are ignored or kept as they are.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import in_workers

#: Bytes of words and ids that a task keeps as recent; beyond them they become
#: the older ones, and those not met again since are forgotten.
_KEPT_BYTES = 2 << 20
#: Longest word that is kept (longer ones are encoded each time).
_KEPT_LENGTH = 64
#: Letters up to which a failing word is merged by scanning (else by a heap).
_SCANNED_LENGTH = 64
#: Words of a batch that are encoded together.
_TOGETHER = 1 << 15
#: Plain Latin characters: unchanged by NFC, lower-cased one to one, and
#: classed alike by every Unicode version.
_PLAIN = regex.compile(r"[\t-\r\x20-\x7e -įı-ſ]*")


def plain_splitter(pattern: str):
    """The word pattern of the tokenizer file for texts of plain Latin
    characters, with letters and numbers listed by their Unicode category."""
    of = {kind: "".join(c for c in map(chr, range(0x180)) if unicodedata.category(c)[0] == kind) for kind in "LN"}
    listed = pattern.replace(r"\p{L}", of["L"]).replace(r"\p{N}", of["N"])
    return (regex if r"\p" in listed else re).compile(listed).findall


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable, else the next free one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """Vocabulary, merges and word splitting of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = token_names(path)
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        # only the normaliser and the splitter of the library are used: no need to load its tables
        bare = spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}, "post_processor": None}
        whole = Tokenizer.from_str(json.dumps(bare))
        self.normalizer, self.splitter = whole.normalizer, whole.pre_tokenizer
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words_of = plain_splitter(pattern)
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.special_at = regex.compile(f"({marks})") if marks else None
        self._load_merges(model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        #: ids of the single letters, plain and as the end of a word
        self.single = {s: i for s, i in model["vocab"].items() if len(s.removesuffix(self.end)) == 1}
        self.known: dict[str | int, bytes] = {}
        self.older: dict[str | int, bytes] = {}
        self.kept = 0

    def _load_merges(self, vocab: dict[str, int], merges) -> None:
        n = len(self.names)
        self.rank = np.full(n, -1, dtype=np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        #: pair of tokens -> rank of its merge * number of tokens + token made
        self.pair: dict[tuple[int, int], int] = {}
        keys = np.empty(len(merges), dtype=np.int64)
        for r, (a, b) in enumerate(merges):
            x, y, t = vocab[a], vocab[b], vocab[a + b]
            if self.rank[t] >= 0 or max(self.rank[x], self.rank[y]) >= r:
                raise ValueError(f"merge {r} makes {a + b!r} again or before its parts")
            self.rank[t], self.left[t], self.right[t] = r, x, y
            self.pair[x, y] = r * n + t
            keys[r] = x * n + y
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        made = np.flatnonzero(self.rank >= 0)
        good = np.ones(n, dtype=bool)
        good[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for t in made[np.argsort(self.rank[made])]:  # parts come before the token they make
            good[t] &= good[self.left[t]] & good[self.right[t]]
        self.proposed = {s: i for s, i in vocab.items() if good[i]}
        #: Beginnings of proposed tokens, the tokens themselves included.
        self.begun = {s[:k] for token in self.proposed for s in [token.removesuffix(self.end)] for k in range(1, len(s) + 1)}

    # --- verify ---------------------------------------------------------

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a and b stay apart when merged from their letters
        (up to merge ``until``, if given)."""
        n, never = len(self.names), np.int64(1) << 60
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), never) if until is None else until.astype(np.int64)
        good, open_ = np.ones(len(a), dtype=bool), np.arange(len(a))
        while len(open_):
            key = a * n + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            crossing = np.where(self.pair_keys[at] == key, self.pair_ranks[at], never)
            bad = crossing < limit
            good[open_[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            # undo the later merge; of equal ones the right, as merging goes from left to right
            by_left = ra > rb
            limit = np.where(by_left, ra, rb + 1)[go]
            a, b = np.where(by_left, self.right[a], a)[go], np.where(by_left, b, self.left[b])[go]
            open_ = open_[go]
        return good

    # --- speculate ------------------------------------------------------

    def propose(self, word: str, ids: list[int]) -> int:
        """Append the greedy longest match of a word in byte letters to
        ``ids``; the number of its tokens, 0 (and nothing appended) if stuck."""
        at, n, before, known, begun, end = 0, len(word), len(ids), self.proposed, self.begun, self.end
        while at < n:
            stop, token = at + 1, None
            while stop <= n and (piece := word[at:stop]) in begun:
                found = known.get(piece if stop < n else piece + end)
                if found is not None:
                    token, reached = found, stop
                stop += 1
            if token is None:
                del ids[before:]
                return 0
            ids.append(token)
            at = reached
        return len(ids) - before

    # --- repair ---------------------------------------------------------

    def merge(self, word: str) -> list[int]:
        """Exact merging of a word in byte letters: lowest merge first, of
        equal ones the leftmost."""
        marks = [*word[:-1], word[-1] + self.end] if word else []
        ids = [self.single[c] for c in marks if c in self.single]
        return self._merge_scan(ids) if len(ids) <= _SCANNED_LENGTH else self._merge_heap(ids)

    def _merge_scan(self, ids: list[int]) -> list[int]:
        get, n, never = self.pair.get, len(self.names), 1 << 60
        merges = [get(p, never) for p in zip(ids, ids[1:])]
        while merges and (best := min(merges)) < never:
            i = merges.index(best)
            ids[i:i + 2] = [best % n]
            del merges[i]
            if i:
                merges[i - 1] = get((ids[i - 1], ids[i]), never)
            if i < len(merges):
                merges[i] = get((ids[i], ids[i + 1]), never)
        return ids

    def _merge_heap(self, ids: list[int]) -> list[int]:
        n = len(self.names)
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(self.pair[p], i, p) for i in range(len(ids) - 1) if (p := (ids[i], ids[i + 1])) in self.pair]
        heapq.heapify(heap)
        while heap:
            merge, i, p = heapq.heappop(heap)
            j, token = after[i], merge % n
            if ids[i] is None or j < 0 or (ids[i], ids[j]) != p:
                continue
            ids[i], ids[j], after[i] = token, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (q := (ids[k], ids[after[k]])) in self.pair:
                    heapq.heappush(heap, (self.pair[q], k, q))
        return [i for i in ids if i is not None]

    # --- words ----------------------------------------------------------

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (in byte letters), little-endian unsigned 32 bits."""
        tokens: list[int] = []
        sizes = np.array([self.propose(w, tokens) for w in words], dtype=np.int64)
        flat, of = np.array(tokens, dtype=np.int64), np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(of[1:] == of[:-1])
        pairs, back = np.unique(flat[inner] * len(self.names) + flat[inner + 1], return_inverse=True)
        apart = self.compatible(pairs // len(self.names), pairs % len(self.names))[back]
        failed = sizes == 0
        failed[of[inner[~apart]]] = True
        raw, stops = flat.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        encoded = [raw[a:b] for a, b in zip([0, *stops], stops)]
        for k in np.flatnonzero(failed).tolist():
            encoded[k] = np.asarray(self.merge(words[k]), dtype="<u4").tobytes()
        return encoded

    def words(self, text: str) -> list[str | int]:
        """The text's words after normalising and splitting (as ordinary
        text); the ids of special tokens stand among them as integers."""
        if _PLAIN.fullmatch(text) and not (self.special_at and self.special_at.search(text)):
            return self.words_of(text.lower())
        parts = self.special_at.split(text) if self.special_at else [text]
        back = {c: b for b, c in self.letters.items()}
        found: list[str | int] = []
        for part in parts:
            if part in self.special:
                found.append(self.special[part])
            elif part:
                for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part)):
                    found.append(bytes(back[c] for c in w).decode("utf-8", "surrogateescape"))
        return found

    def in_letters(self, word: str) -> str:
        raw = word.encode("utf-8", "surrogateescape")
        return word if raw.isascii() and raw.isalnum() else raw.decode("latin-1").translate(self.letters)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text.  Words are encoded ``_TOGETHER`` at a time, so
        what is held beside the batch itself is bounded by ``_KEPT_BYTES``
        (twice: recent and older words) and by the batch's longest texts."""
        split = [self.words(t) for t in texts]
        if self.kept > _KEPT_BYTES:
            self.known, self.older, self.kept = {}, self.known, 0
        known, older = self.known, self.older
        unmet = set().union(*split).difference(known)
        again = {w: older[w] for w in unmet if w in older}
        again |= {w: np.asarray([w], dtype="<u4").tobytes() for w in unmet if isinstance(w, int)}
        known |= again
        fresh = [w for w in unmet if w not in again]
        for at in range(0, len(fresh), _TOGETHER):
            part = fresh[at:at + _TOGETHER]
            known |= zip(part, self.encode_words([self.in_letters(w) for w in part]), strict=True)
        encoded = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in fresh:
            if len(w) > _KEPT_LENGTH:
                del known[w]
        self.kept += sum(len(w) + len(known[w]) for w in fresh if w in known)
        self.kept += sum(len(known[w]) + 8 for w in again)
        return encoded


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(maxsize=2)
def token_names(path: str) -> list[str]:
    """The tokens of a tokenizer file by id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    of = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = [""] * (max(of.values()) + 1)
    for token, i in of.items():
        names[i] = token
    return names


def decode_ids(ids: bytes, names: list[str]) -> str:
    """Token texts joined by a space (the file names no decoder)."""
    return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


def _pieces(column, most_bytes: int = 1 << 19):
    """Slices of a batch's column of a bounded number of bytes (one row at least)."""
    at, n = 0, len(column)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    while at < n:
        stop, total = at + 1, sizes[at]
        while stop < n and total + sizes[stop] <= most_bytes:
            total += sizes[stop]
            stop += 1
        yield at, stop
        at = stop


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", drop_text: bool = True,
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with a binary column of token ids (little-endian unsigned 32
    bits, the usual storage of token files) in place of the text.  With
    ``decoded_col`` the ids are decoded again in the same pass (one Python
    worker a task instead of the two that ``encode`` and ``decode`` take)."""
    kept = [c for c in docs.columns if c != text_col or not drop_text]
    added = [T.StructField(ids_col, T.BinaryType())]
    added += [T.StructField(decoded_col, T.StringType())] if decoded_col else []
    rows = docs.select(*[F.col(f"`{c}`") for c in kept if c not in (ids_col, decoded_col)],
                       F.col(f"`{text_col}`").alias("__text"))
    out = T.StructType([*rows.schema.fields[:-1], *added])

    def run(batches):
        coder = tokenizer(path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a, b in _pieces(texts):
                part = [t.as_py() or "" for t in texts.slice(a, b - a)]
                ids = coder.encode_batch(part)
                made = [pa.array(ids, pa.binary())]
                if decoded_col:
                    made.append(pa.array([decode_ids(x, coder.names) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:-1]), *made],
                                                 names=out.names)

    return in_workers(rows).mapInArrow(run, out)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the decoded text of ``ids_col`` added as ``text_col``."""
    kept = [c for c in rows.columns if c != text_col]
    src = rows.select(*[F.col(f"`{c}`") for c in kept])
    out = T.StructType([*src.schema.fields, T.StructField(text_col, T.StringType())])
    at = kept.index(ids_col)

    def run(batches):
        names = token_names(path)
        for batch in batches:
            texts = [decode_ids(x.as_py() or b"", names) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=out.names)

    return in_workers(src).mapInArrow(run, out)


def coded_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    both = encode(rows, path, decoded_col="decoded")
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
