"""Spans of pattern matches, from SQL functions only.

A span is a struct (start, end, text) in code points, end exclusive.  Spark has
no function for the places of all matches; they follow from the pieces that
``split`` leaves between them, as both search from left to right without
overlap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_TYPE = "array<struct<start:int,end:int,text:string,before:string>>"
_CHUNK = 128


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once.  Inside the body it is a
    lambda variable; a column used in a lambda would be computed per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def spans(text: Column, pattern: str, before: Callable[[Column], Column] | None = None) -> Column:
    """Spans of all matches of ``pattern`` in ``text``, each with ``before`` of
    the text in front of it, back to the start of the last match but one.
    Places add up chunk by chunk, so that a text with very many matches is not
    quadratic."""
    def size_of(pair):
        return F.length(pair["piece"]) + F.length(pair["match"])

    def step(state, pair):
        end = state["at"] + size_of(pair)
        span = F.struct((end - F.length(pair["match"])).alias("start"), end.alias("end"),
                        pair["match"].alias("text"), pair["before"].alias("before"))
        return F.struct(F.concat(state["done"], F.array(span)).alias("done"), end.alias("at"))

    def running(state, chunk):
        return F.struct(F.concat(state["done"], F.array(state["at"])).alias("done"),
                        (state["at"] + F.aggregate(chunk, F.lit(0), lambda t, x: t + size_of(x))).alias("at"))

    def from_offset(chunk, offset):
        first = F.struct(F.array().cast(_TYPE).alias("done"), offset.alias("at"))
        return F.aggregate(chunk, first, step, lambda s: s["done"])

    def chunked(chunks):
        zero = F.struct(F.array().cast("array<int>").alias("done"), F.lit(0).alias("at"))
        return F.flatten(F.zip_with(chunks, F.aggregate(chunks, zero, running, lambda s: s["done"]), from_offset))

    def fronted(pairs):
        def front(i, ago, part):
            return F.coalesce(F.get(pairs, i - ago)[part], F.lit(""))

        return F.transform(pairs, lambda x, i: F.struct(x["piece"].alias("piece"), x["match"].alias("match"), before(F.concat(
            front(i, 2, "match"), front(i, 1, "piece"), front(i, 1, "match"), x["piece"])).alias("before")))

    def placed(found):
        pairs = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found,
                           lambda p, m: F.struct(p.alias("piece"), m.alias("match"), F.lit("").alias("before")))
        chunks = let(let(pairs, fronted) if before else pairs, lambda all_: F.transform(
            F.sequence(F.lit(0), F.size(all_) - 1, F.lit(_CHUNK)), lambda i: F.slice(all_, i + 1, F.lit(_CHUNK))))
        # the second search only where the first found something
        return F.when(F.size(found) > 0, let(chunks, chunked)).otherwise(F.array().cast(_TYPE))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def labelled(spans_: Column, kind: str, place: int) -> Column:
    """kind:start:end strings, sortable by start and then by the kind's place."""
    return F.transform(spans_, lambda s: F.struct(
        s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"),
        F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("label")))


def joined(parts: list[Column], by_kind: bool = False) -> Column:
    """Labels of several kinds in one string, by start then kind, or by kind
    (in the order given) then start."""
    if by_kind:
        rows = F.concat(*[F.array_sort(p) for p in parts])
    else:
        rows = F.array_sort(F.concat(*parts))
    return F.array_join(F.transform(rows, lambda r: r["label"]), ",")
