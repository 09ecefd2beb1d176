"""Secret scans: known formats, and a battery of randomness tests for the rest
(SQL functions only).

Base spans are assignments, access keys and long hexadecimal runs.  Other runs
of 20 key characters or more are candidates.  For each, an encoding is inferred
(hexadecimal, base 32, 36, 62 or 64) and three tests ask whether it could be
random in that alphabet: chi-squared uniformity, the number of runs of
character classes, and the serial correlation of alphabet positions.  A
candidate that passes all three is reported only if ordinary text is ruled out
as well: its chance under the text's own letter repetition and class changes
(both estimated from all candidates of the corpus) is bounded from the same two
statistics - the bound falls with length - and a Benjamini-Hochberg step within
each length class keeps the share of false reports under ``rate``.

Texts are read once.  What crosses the cluster is a histogram of chances (a few
hundred rows per length class) and one row of corpus statistics.

Defined cases: a null text counts as empty and has no spans (the digest is that
of the empty string); a very long text is searched whole; candidates of one
length class whose chances tie (fall into one bin) are all reported or all not;
repeated rows get equal results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import cut
from tillroll.llm.spans import joined, labelled, let, overlaps, spans

# The contract's patterns.  Lengths that a maximal run must have
# are part of the last two (a shorter run holds no longer one).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex")
#: Candidates of the randomness battery, and the kind of what it adds.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ADDED = "random"
#: Letter repetition of European text (chance that two letters are equal),
#: used where no candidate is made of letters alone.
TEXT_REPEAT = 0.065
_STEP = 0.25
_DEEPEST = 400


def base_spans(text: Column) -> dict[str, Column]:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    valued = F.zip_with(spans(text, ASSIGN), values, lambda s, v: F.struct(s.alias("s"), v.alias("v")))
    assign = F.transform(F.filter(valued, lambda x: F.length(x["v"]) >= 8), lambda x: x["s"])
    return {"assign": assign, "access": spans(text, ACCESS), "hex": spans(text, HEX)}


def _statistics(span: Column) -> Column:
    """Counts of one candidate: length, alphabet size, squared letter counts,
    class changes and their share under randomness, serial correlation."""
    s = span["text"]
    n = F.length(s)
    size = (F.when(s.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16).when(s.rlike("^[A-Z2-7]+$"), 32)
            .when(s.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), 36).when(s.rlike("^[0-9A-Za-z]+$"), 62).otherwise(64))
    letters = F.filter(F.split(s, ""), lambda c: c != "")
    squares = F.aggregate(F.array_distinct(letters), F.lit(0).cast("long"),
                          lambda t, c: t + F.pow(n - F.length(F.replace(s, c, F.lit(""))), F.lit(2)).cast("long"))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        s, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0"), "[+/_=-]", "-")
    changes = F.length(F.regexp_replace(classes, r"(.)\1*+", "x")) - 1
    random_change = (F.when(size == 16, 1 - (6 / 16) ** 2 - (10 / 16) ** 2).when(size == 32, 1 - (26 / 32) ** 2 - (6 / 32) ** 2)
                     .when(size == 36, 1 - (26 / 36) ** 2 - (10 / 36) ** 2).otherwise(1 - 2 * (26 / 62) ** 2 - (10 / 62) ** 2))
    places = F.transform(letters, lambda c: F.instr(F.lit(
        "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-="), c).cast("double"))

    def sums(x):
        def total(values):
            return F.aggregate(values, F.lit(0.0), lambda t, v: t + v)

        ahead = F.zip_with(F.slice(x, 1, n - 1), F.slice(x, 2, n - 1), lambda a, b: a * b)
        return F.struct(total(x).alias("one"), total(F.transform(x, lambda v: v * v)).alias("two"),
                        total(ahead).alias("lag"), (F.element_at(x, 1) + F.element_at(x, -1)).alias("ends"))

    def serial(t):
        mean = t["one"] / n
        spread = t["two"] - mean * t["one"]
        lagged = t["lag"] - mean * (2 * t["one"] - t["ends"]) + (n - 1) * mean * mean
        return F.when(spread > 1e-6, lagged / spread * F.sqrt(n)).otherwise(F.lit(1e9))

    return F.struct(span["start"].alias("start"), span["end"].alias("end"), n.alias("n"), size.alias("size"),
                    squares.alias("squares"), changes.alias("changes"), random_change.alias("random_change"),
                    s.rlike("^[A-Za-z]+$").alias("letters"), let(let(places, sums), serial).alias("serial"))


def _chi_squared(c: Column) -> Column:
    return c["size"] * c["squares"] / c["n"] - c["n"]


def looks_random(c: Column, most: float = 3.5) -> Column:
    """None of the three tests rejects randomness (scores of about normal spread)."""
    k = c["size"] - 1
    uniform = (F.pow(_chi_squared(c) / k, 1 / 3) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k))
    m, share = c["n"] - 1, c["random_change"]
    runs = (c["changes"] - m * share) / F.sqrt(m * share * (1 - share))
    return (uniform <= most) & (F.abs(runs) <= most) & (F.abs(c["serial"]) <= most)


def text_evidence(c: Column, repeat: float, change: float) -> Column:
    """Minus the log of a bound on the chance that ordinary text looks so
    uniform and changes class so often; grows with the length."""
    n, k = c["n"], c["size"] - 1
    excess = F.greatest(F.lit(0.0), c["size"] * F.lit(repeat) - 1) * (n - 1)
    z = (k + excess - _chi_squared(c)) / F.sqrt(2 * k + 4 * excess)
    uniform = F.when(z > 0, z * z / 2 + F.log(F.lit(2.0))).otherwise(F.lit(0.0))
    q = F.least(F.lit(0.999), F.greatest(F.lit(1e-3), c["changes"] / (n - 1)))
    far = q * F.log(q / change) + (1 - q) * F.log((1 - q) / (1 - change))
    runs = F.when(q > change, far * (n - 1)).otherwise(F.lit(0.0))
    both = uniform + runs
    return both - F.log(1 + both)  # two chances combined


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01) -> DataFrame:
    """doc_id and the spans of each kind (start, end), those of the battery as ``random``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    base = base_spans(text)
    rows = rows.select("doc_id", "text", *[base[kind].alias(kind) for kind in KINDS])
    free = let(F.concat(*KINDS), lambda known: F.filter(
        spans(text, CANDIDATE), lambda r: ~F.exists(known, lambda b: overlaps(r, b))))
    slim = lambda kind: F.transform(kind, lambda s: F.struct(s["start"], s["end"]))
    found = cut(rows.select("doc_id", *[slim(kind).alias(kind) for kind in KINDS],
                            F.transform(free, _statistics).alias("candidates")))

    each = found.select(F.explode("candidates").alias("c")).select("c.*")
    pairs = F.col("n") * (F.col("n") - 1)
    corpus = each.agg(F.sum(F.when(F.col("letters"), F.col("squares") - F.col("n"))).alias("same"),
                      F.sum(F.when(F.col("letters"), pairs)).alias("pairs"),
                      F.sum("changes").alias("changes"), F.sum(F.col("n") - 1).alias("steps")).first()
    repeat = max(TEXT_REPEAT, corpus["same"] / corpus["pairs"]) if corpus["pairs"] else TEXT_REPEAT
    change = ((corpus["changes"] or 0) + 1) / ((corpus["steps"] or 0) + 10)
    change = min(max(change, 0.05), 0.3)

    def judged(c):
        evidence = F.least(F.lit(float(_DEEPEST)), text_evidence(c, repeat, change))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.floor(F.log2(c["n"])).alias("class"),
                        F.when(looks_random(c), F.floor(evidence / _STEP)).otherwise(F.lit(0)).alias("bin"))

    rated = found.withColumn("candidates", F.transform("candidates", judged))
    counts = (rated.select(F.explode("candidates").alias("c")).groupBy("c.class", "c.bin").count())
    deeper = Window.partitionBy("class").orderBy(F.col("bin").desc())
    table = (counts.withColumn("reported", F.sum("count").over(deeper))
             .withColumn("all", F.sum("count").over(Window.partitionBy("class")))
             .where((F.col("bin") > 0) & (F.exp(-F.col("bin") * _STEP) <= rate * F.col("reported") / F.col("all")))
             .groupBy("class").agg(F.min("bin").alias("bin")).collect())  # one row per power of two of the length
    limits = F.create_map(*[F.lit(v) for r in table for v in (r["class"], r["bin"])]) if table else None
    added = (F.filter("candidates", lambda c: F.coalesce(c["bin"] >= limits[c["class"]], F.lit(False))) if table
             else F.filter("candidates", lambda c: F.lit(False)))
    return rated.select("doc_id", *KINDS, added.alias(ADDED))


def report(found: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of the base spans, all spans."""
    parts = [labelled(F.col(kind), kind, place) for place, kind in enumerate((*KINDS, ADDED))]
    return found.select("doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
                        F.sha2(joined(parts[:-1]), 256).alias("base_sha256"), joined(parts).alias("spans"))
