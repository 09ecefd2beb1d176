"""Personal data: known formats, and bootstrapped contextual extraction for
identifiers of unknown format (SQL functions only).

Base spans are e-mail and network addresses, payment cards and phone numbers.
All of them, with digits or without, seed a bootstrap: the two whole words in
front of the word an entity begins in are a lexical pattern, however long or far
apart; other instances are words that hold a digit (to be learned, at least
``least_digits``), and the graph of patterns and instances is scored in rounds.
Identifiers without digits or with fewer are not discovered.  A pattern's confidence is the share of *all*
its occurrences in the corpus (whatever follows it) that instances of known
confidence follow; an unseen instance is as sure as the patterns it follows
make it together.  Instances that end above ``least_instance`` behind accepted
patterns are reported as ``learned``.

The graph holds one edge per distinct pattern and instance; occurrences of
patterns are counted with map-side combining, and only of patterns with enough
distinct instances to be accepted at all.

Defined cases: a null text counts as empty and has no spans (the digest is that
of the empty string); repeated rows get equal results and count as occurrences,
not as further instances; of several entities that begin in one word the first is the
instance, and a word that only continues an entity is none; patterns or instances that tie are all accepted
or all not, as only limits decide; a very long text is searched whole; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import cut
from tillroll.llm.spans import joined, labelled, let, overlaps, spans

# The contract's patterns, written so that no search starts twice
# within one run of characters (same matches, linear time and stack).
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
ADDED = "learned"
#: A whole word of a text of ``_plain`` blanks that holds a digit or an at sign:
#: every base span begins in one.
TOKEN = r"(?<![^\x20])[^\x20@0-9]*+[@0-9][^\x20]*+"
#: One in so many texts is searched first, to rule out common patterns.
_PART = 64


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    values = F.transform(F.filter(F.split(F.reverse(_digits(text)), ""), lambda c: c != ""),
                         lambda c, i: c.cast("int") * (1 + i % 2))
    total = F.aggregate(values, F.lit(0), lambda t, x: t + x - F.when(x > 9, 9).otherwise(0))
    return total % 10 == 0


def _byte_parts(text: Column) -> Column:
    short = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(short, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def base_spans(text: Column) -> dict[str, Column]:
    def count(s):
        return F.length(_digits(s["text"]))

    return {"email": spans(text, EMAIL),
            "ip": F.filter(spans(text, IP), lambda s: _byte_parts(s["text"])),
            "card": F.filter(spans(text, CARD), lambda s: count(s).between(16, 19) & _luhn(s["text"])),
            "phone": F.filter(spans(text, PHONE), lambda s: count(s).between(8, 15))}


def _plain(text: Column) -> Column:
    """``text`` with spaces for all blanks (places stay)."""
    return F.translate(text, "\t\n\x0b\x0c\r", " " * 5)


def _pattern(front: Column) -> Column:
    """The last two words of the text in front of a word, lower-cased (null if fewer)."""
    def last(words):
        return F.substring_index(words, " ", -1)

    def two(words):
        rest = F.rtrim(F.left(words, F.length(words) - F.length(last(words))))
        return let(rest, lambda r: F.when(r != "", F.lower(F.concat_ws(" ", last(r), last(words)))))

    return let(F.rtrim(front), two)


def _occurrences(text: Column, seeds: Column) -> Column:
    """pattern, instance, start, end, seed of each word with a pattern in which a
    seed begins, or that holds a digit and no part of a seed; a seed's instance
    is its whole text."""
    def one(t, own):
        first = F.get(F.filter(own, lambda s: s["start"] >= t["start"]), F.lit(0))
        bare = F.regexp_replace(t["text"], r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", "")
        return let(first, lambda f: F.struct(
            t["before"].alias("pattern"), F.when(f.isNotNull(), f["text"]).otherwise(bare).alias("instance"),
            t["start"].alias("start"), t["end"].alias("end"), f.isNotNull().alias("seed"),
            (f.isNull() & ((F.size(own) > 0) | ~t["text"].rlike("[0-9]"))).alias("none")))

    words = F.filter(spans(_plain(text), TOKEN, before=_pattern), lambda t: t["before"].isNotNull())
    some = let(seeds, lambda known: F.transform(words, lambda t: let(
        F.filter(known, lambda s: overlaps(t, s)), lambda own: one(t, own))))
    return F.filter(some, lambda o: ~o["none"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, support: int = 3,
         least_pattern: float = 0.6, least_instance: float = 0.8, least_digits: int = 4) -> DataFrame:
    """doc_id and the spans of each kind (start, end), the discovered ones as ``learned``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    base = base_spans(text)
    rows = texts.select("doc_id", "text", *[base[kind].alias(kind) for kind in KINDS])
    slim = lambda kind: F.transform(kind, lambda s: F.struct(s["start"], s["end"]))
    found = cut(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", *[slim(k).alias(k) for k in KINDS],
                            _occurrences(text, F.array_sort(F.concat(*KINDS))).alias("tokens")))

    each = found.select("row", F.explode("tokens").alias("t")).select("row", "t.*")
    edges = cut(each.groupBy("pattern", "instance").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")))
    possible = cut(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"), F.sum("n").alias("n"))
                   .where(F.col("instances") >= support))
    # occurrences in a part of the corpus are a lower bound: what they already rule out needs no count in the rest
    part = _pattern_counts(texts.where(F.pmod(F.xxhash64("text"), F.lit(_PART)) == 0), possible)
    hopeless = part.join(possible, "pattern").where(F.col("occurrences") * least_pattern > F.col("n"))
    possible = cut(possible.join(hopeless.select("pattern"), "pattern", "left_anti").select("pattern"))
    graph = cut(edges.join(possible, "pattern").join(_pattern_counts(texts, possible), "pattern"))

    known = graph.where("seed").select("instance", F.lit(1.0).alias("sure")).distinct()
    sure, accepted = cut(known), None
    for _ in range(rounds):
        weighed = graph.join(sure, "instance", "left").withColumn("sure", F.coalesce("sure", F.lit(0.0)))
        accepted = cut(weighed.groupBy("pattern")
                       .agg((F.sum(F.col("n") * F.col("sure")) / F.max("occurrences")).alias("trust"), F.sum("sure").alias("weight"))
                       .where((F.col("trust") >= least_pattern) & (F.col("weight") >= support)))
        if accepted.isEmpty():
            break
        digits = F.length(_digits(F.col("instance")))
        joint = 1 - F.exp(F.sum(F.log(1 - F.least("trust", F.lit(0.999)))))
        reached = (graph.where(~F.col("seed") & (digits >= least_digits)).join(accepted, "pattern")
                   .groupBy("instance").agg(joint.alias("sure")).join(known, "instance", "left_anti"))
        sure = cut(known.unionByName(reached))

    chosen = sure.join(known.select("instance"), "instance", "left_anti").where(F.col("sure") >= least_instance)
    new = (each.where(~F.col("seed")).join(chosen, "instance").join(accepted.select("pattern"), "pattern")
           .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(ADDED)))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return found.join(new, "row", "left").select("doc_id", *KINDS, F.coalesce(ADDED, none).alias(ADDED))


def _pattern_counts(texts: DataFrame, patterns: DataFrame, small: int = 100_000) -> DataFrame:
    """How often each of ``patterns`` (two adjacent words) occurs in the corpus
    in front of anything.  Word pairs travel as 64-bit hashes; a collision
    could only make a pattern look more common, hence less sure."""
    words = F.array_remove(F.split(_plain(F.lower(F.coalesce(F.col("text"), F.lit("")))), " "), "")
    pairs = (texts.select(words.alias("w")).where(F.size("w") > 1)
             .select(F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w") - 1),
                                lambda a, b: F.xxhash64(a, b)).alias("pairs")))
    both = F.split("pattern", " ")
    keyed = patterns.select("pattern", F.xxhash64(both[0], both[1]).alias("pair"))
    # what meets the corpus is 64-bit numbers, so a broadcast has a size whatever the words' lengths
    wanted = keyed.select("pair").distinct()
    few = F.broadcast(wanted) if patterns.count() <= small else wanted
    counts = (pairs.select(F.explode("pairs").alias("pair")).join(few, "pair")
              .groupBy("pair").agg(F.count(F.lit(1)).alias("occurrences")))
    return keyed.join(counts, "pair").select("pattern", "occurrences")


def report(found: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of the base spans, all spans."""
    parts = [labelled(F.col(kind), kind, place) for place, kind in enumerate((*KINDS, ADDED))]
    return found.select("doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
                        F.sha2(joined(parts[:-1], by_kind=True), 256).alias("base_sha256"),
                        joined(parts, by_kind=True).alias("spans"))
