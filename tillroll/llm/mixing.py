"""Mixing sources to target weights by Pareto order sampling (SQL functions only).

A source's target T over its size S says how many copies each of its documents
is due: floor(T / S) whole copies are certain, and the rest of the target is
drawn without replacement.  A document's inclusion odds p / (1 - p) are its
size (or a column of odds) times a factor that its source shares; its rank is
the random odds u / (1 - u), u from a hash of its id, divided by the inclusion
odds.  A common factor leaves the order of ranks alone, so it need not be
known: the lowest ranks are taken until the source's words are next to the
rest of its target (the last document only if it brings the sum nearer).  The
sample has a fixed size in words, and its inclusion probabilities differ:
a document of size s is in with odds near s times the last rank.

Nothing gathers a source in one task.  The logarithm of a source's ranks is cut
into ranges, the finer the more documents it has (a range holds about 4 sqrt(n)
of n documents whatever their sizes, as log odds have a bounded density): a
map-side combined histogram and a running sum find the range where the rest is
met, and only that range's distinct (rank, id, size) are ordered, with their
number of rows.  The result is one threshold per source, so documents are drawn
by a join with the small table of sources, which is broadcast only below
``small_sources`` rows.  Rows that repeat the id and size at a threshold are
numbered over all tasks, and as many as the target asks for are in.  Targets
come from sums over the sources, a round for each set of sources that reaches
its cap; sources are numbered without one task that orders them all.

Defined cases: a null or empty text has size 0, takes 0 and is never drawn; nor
is a document whose odds (where a column gives them) are null, not finite or not
positive; null sources form one source, last in order; rows that repeat an id
have the same u; of rows that repeat id and size, those with the lower hash of
all columns come first, and of wholly equal ones some are in (as many in every
run); a null id counts as an empty one; very long texts are sized whole; equal
ranks go by id, then size; a source of size 0 has target 0; an empty table gives
an empty result; other columns keep their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import BLANKS, cut
from tillroll.llm.rendezvous import with_slots

_SCALE = 2.0 ** 48


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def _unit(key: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from an id, the same in every run."""
    ticket = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 12), 16, 10).cast("long")
    return (ticket + 0.5) / _SCALE


def pareto_rank(key: Column, odds: Column, seed: str = "mix") -> Column:
    """Random odds over inclusion odds; null where the latter are not positive numbers."""
    u, odds = _unit(key, seed), odds.cast("double")
    return F.when((odds > 0) & (odds < float("inf")), u / (1 - u) / odds)


def _level(rows: DataFrame, goal: float) -> float:
    """The level at which the sources' least(cap, weight * level) add up to
    ``goal``: sources that reach their cap leave the sharing, until none does."""
    level = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * level
        sums = rows.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("caps"),
                        F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if not sums["weight"] or (higher := (goal - sums["caps"]) / sums["weight"]) <= level:
            return level
        level = higher


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source: source, source_size, n, target.  ``sizes`` has one row per
    source (source, source_size, n).  Weights repeat over the sources in code
    point order, null last; a target stops at ``most`` times the size, the
    excess goes to the others by weight."""
    named = sizes.select("*", F.lit(0).alias("every"), F.col("source").isNull().alias("nameless"))
    placed = with_slots(named, "every", ["nameless", "source"], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = cut(placed.select("source", "source_size", "n", weight.alias("weight"), (most * F.col("source_size")).alias("cap")))
    level = _level(rows, share * (rows.agg(F.sum("source_size")).first()[0] or 0))
    return rows.select("source", "source_size", "n", F.least("cap", F.col("weight") * level).alias("target"))


def _measured(docs: DataFrame, id_col: str, source_col: str, text_col: str, odds_col: str | None, seed: str) -> list[Column]:
    """source, size, key and rank of a document."""
    size, key = word_count(F.col(f"`{text_col}`")), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    odds = F.col(f"`{odds_col}`") if odds_col else size
    rank = F.when(size > 0, pareto_rank(key, odds, seed))
    return [F.col(f"`{source_col}`").alias("source"), size.alias("size"), key.alias("key"), rank.alias("rank")]


def _range() -> Column:
    return F.floor(F.ln("rank") * F.col("fineness")).cast("long")


def thresholds(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
               weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, odds_col: str | None = None,
               seed: str = "mix") -> DataFrame:
    """Per source: source, source_size, target, whole (certain copies), rest,
    and the drawn part's end: ranges up to ``last_range`` and, there, what is
    before ``first_out`` (rank, key, size), of whose own rows ``some`` are in."""
    rows = cut(docs.select(*_measured(docs, id_col, source_col, text_col, odds_col, seed)))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = (targets(sizes, weights, share, most).withColumn("whole", whole.cast("long"))
            .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size")))
            .withColumn("fineness", F.ceil(F.sqrt("n") / 4)))
    plan = cut(plan)
    ranged = (join_sources(rows.where("rank is not null"), plan.select("source", "rest", "fineness").where("rest > 0"))
              .withColumn("range", _range()))
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    met = (sums.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0)))
           .where((F.col("offset") <= F.col("rest")) & (F.col("offset") + F.col("words") >= F.col("rest"))))
    met = cut(met.select("source", "range", "offset"))
    same = ranged["source"].eqNullSafe(met["source"]) & (ranged["range"] == met["range"])
    inside = (ranged.join(met, same).select(ranged["source"], ranged["range"], "offset", "rest", "rank", "key", "size")
              .groupBy("source", "range", "offset", "rest", "rank", "key", "size").agg(F.count(F.lit(1)).alias("of")))
    order = Window.partitionBy("source", "range").orderBy("rank", "key", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = F.coalesce(F.sum(F.col("size") * F.col("of")).over(order), F.lit(0)) + F.col("offset")
    inside = inside.withColumn("run", run).withColumn(
        "near", F.floor((F.col("rest") - F.col("run")) / F.col("size") + 0.5).cast("long"))
    nearer = lambda row: (2 * (F.col("run") + row * F.col("size")) + F.col("size") <= 2 * F.col("rest")).cast("long")
    # rounding may put ``near`` one off; the exact rule decides
    some = F.col("near") - 1 + nearer(F.col("near") - 1) + nearer(F.col("near"))
    out = (inside.withColumn("some", F.greatest(F.lit(0).cast("long"), some)).where(F.col("some") < F.col("of"))
           .groupBy("source").agg(F.min(F.struct("rank", "key", "size", "some")).alias("end")))
    last = met.groupBy("source").agg(F.max("range").alias("last_range"))
    return cut(plan.alias("p").join(last.alias("l"), F.expr("p.source <=> l.source"), "left")
               .join(out.alias("o"), F.expr("p.source <=> o.source"), "left")
               .select("p.*", "last_range", F.when(F.col("end").isNotNull(), F.struct("end.rank", "end.key", "end.size")).alias("first_out"),
                       F.coalesce("end.some", F.lit(0)).alias("some")))


def join_sources(rows: DataFrame, sources: DataFrame, small_sources: int = 100_000) -> DataFrame:
    """``rows`` with the columns of their source; broadcast only where the
    (materialised) table of sources is counted to be small."""
    named = sources.withColumnRenamed("source", "__source")
    named = F.broadcast(named) if sources.count() <= small_sources else named
    return rows.join(named, rows["source"].eqNullSafe(F.col("__source"))).drop("__source")


def allocate(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, odds_col: str | None = None,
             seed: str = "mix") -> DataFrame:
    """``row`` (the document as a struct), size, source_size, target, copies."""
    ends = thresholds(docs, id_col, source_col, text_col, weights, share, most, odds_col, seed)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       *_measured(docs, id_col, source_col, text_col, odds_col, seed))
    place = F.struct("rank", "key", "size")
    able = (F.col("rest") > 0) & F.col("rank").isNotNull() & (F.col("last_range").isNull() | (_range() <= F.col("last_range")))
    drawn = able & (F.col("first_out").isNull() | (place < F.col("first_out")))
    found = join_sources(rows, ends).select(
        "row", "source", "size", "source_size", "target", "whole", "some", F.coalesce(drawn, F.lit(False)).cast("long").alias("drawn"),
        F.coalesce(able & (F.col("some") > 0) & (place == F.col("first_out")), F.lit(False)).alias("tied"))
    out = ["row", "size", "source_size", "target"]
    plain = found.where("not tied").select(*out, (F.col("whole") + F.col("drawn")).alias("copies"))
    if ends.where("some > 0").isEmpty():
        return plain
    # rows that repeat the id and size at a threshold: the first ``some`` in order of a hash of the row
    alike = [F.col("row")[f.name] for f in docs.schema.fields if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    group = F.concat(F.col("source").isNull().cast("string"), F.coalesce(F.col("source").cast("string"), F.lit("")))
    ties = found.where("tied").select(*out, "whole", "some", group.alias("group"), F.xxhash64(*alike).alias("hash"))
    ties = with_slots(ties, "group", ["hash"], "slot")
    return plain.unionByName(ties.select(*out, (F.col("whole") + (F.col("slot") < F.col("some")).cast("long")).alias("copies")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each as often as it was allotted copies."""
    rows = allocate(docs, **options).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
