"""Match recipe ingredients to product names.

Containment ("name contains ingredient", case-insensitive) is a theta join.
Instead of a nested loop over names x ingredients we index it exactly with
equi-joins on substrings of ``GRAM`` characters (grams):

* the distinct names are materialised once; the catalogue rows themselves are
  touched only when the matching names are joined back;
* a name that contains an ingredient contains each of its grams, so any one
  serves as the ingredient's anchor.  The grams that ingredients have are
  counted over the names (combined map-side), and each ingredient takes its
  rarest: one whose first letters begin half the catalogue is anchored on
  something else, and one with a gram that no name has is done at once;
* names meet the anchors by an equi-join on the gram, and each candidate is
  verified by comparing the whole ingredient.

The result is exactly the set of containing pairs, with no cap, and the work
grows with (distinct names x name length) + candidates, not names x needles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import norm_text
from tillroll.operators.dedup import latest_per_key
from tillroll.session import materialise, small_side

GRAM = 3
# Diagnostic labels.
MATCH, NO_MATCH = "MATCH", "SIN MATCH"


def _grams(table: DataFrame, text: str, gram: int, lengths: DataFrame | None = None) -> DataFrame:
    """``table`` with a row (_g, _gram) per distinct substring of ``gram``
    characters, and of each shorter length in ``lengths``.  Without ``lengths``
    a shorter text is its own gram."""
    size = F.length(text)
    if lengths is None:
        sized = table.withColumn("_g", F.least(size, F.lit(gram)))
    else:
        sized = table.withColumn("_g", F.explode(F.sequence(F.lit(1), F.lit(gram)))).join(F.broadcast(lengths), "_g", "left_semi")
    places = F.when(size >= F.col("_g"), F.sequence(F.lit(1), size - F.col("_g") + 1))
    return sized.withColumn("_gram", F.explode(F.array_distinct(F.transform(places, lambda p: F.col(text).substr(p, F.col("_g"))))))


def contains_pairs(names: DataFrame, name_col: str, needles: DataFrame, needle_col: str,
                   trim: bool = True, gram: int = GRAM) -> DataFrame:
    """Distinct (name, needle) with norm(name) containing norm(needle).

    Output columns: ``_name``, ``_needle``, ``_nn`` and ``_nk`` (normalised
    forms).  Empty or null needles match nothing.  The distinct names are
    computed when this is called."""
    n = materialise(names.select(F.col(name_col).alias("_name")).where(F.col("_name").isNotNull())
                    .distinct().withColumn("_nn", norm_text("_name", trim)))
    k = (needles.select(F.col(needle_col).alias("_needle")).distinct()
         .withColumn("_nk", norm_text("_needle", trim)).where(F.length("_nk") > 0))
    needle_grams = _grams(k, "_nk", gram)
    lengths = needle_grams.select("_g").distinct()  # at most ``gram`` rows
    counts = (_grams(n, "_nn", gram, lengths).select("_gram")
              .join(needle_grams.select("_gram").distinct(), "_gram")
              .groupBy("_gram").agg(F.count(F.lit(1)).alias("_names")))
    weighed = needle_grams.join(counts, "_gram", "left").withColumn("_names", F.coalesce("_names", F.lit(0)))
    anchors = latest_per_key(weighed, ["_needle"], [F.col("_names"), F.col("_gram")])
    anchors = materialise(anchors.where("_names > 0").select("_needle", "_nk", "_g", "_gram"))
    met = _grams(n, "_nn", gram, anchors.select("_g").distinct()).join(
        small_side(anchors).withColumnRenamed("_g", "_anchor_g"), "_gram")
    return met.where(F.col("_nn").contains(F.col("_nk"))).select("_name", "_needle", "_nn", "_nk")


def score_pairs(pairs: DataFrame) -> DataFrame:
    """match_score: 1 equal, 2 prefix, 3 contains; nombre_length of the name."""
    score = (F.when(F.col("_nn") == F.col("_nk"), F.lit(1))
             .when(F.col("_nn").startswith(F.col("_nk")), F.lit(2))
             .otherwise(F.lit(3)))
    return pairs.withColumn("match_score", score).withColumn("nombre_length", F.length("_name"))


def containment_join(items: DataFrame, needles: DataFrame, name_col: str = "nombre",
                     needle_col: str = "ingrediente", trim: bool = True) -> DataFrame:
    """Every (item row, needle row) where the name contains the needle,
    with match_score and nombre_length.  ``items`` is read twice: its names
    alone, and once more when the matching names are joined back; hand over
    a table, or a materialised layer."""
    pairs = score_pairs(contains_pairs(items, name_col, needles, needle_col, trim))
    per_needle = needles.join(pairs, needles[needle_col] == pairs._needle)
    out = items.join(per_needle, items[name_col] == per_needle._name)
    return out.drop("_name", "_needle", "_nn", "_nk")


def best_match(items: DataFrame, needles: DataFrame, group=("receta", "ingrediente", "fecha_extraccion"),
               name_col: str = "nombre", needle_col: str = "ingrediente",
               tie_break=("supermercado",)) -> DataFrame:
    """One item per (recipe, ingredient, date): best score, then the
    shortest name, then name and ``tie_break`` for a total order."""
    joined = containment_join(items, needles, name_col, needle_col)
    order = [F.col("match_score"), F.col("nombre_length"), F.col(name_col)]
    order += [F.col(c) for c in tie_break]
    return latest_per_key(joined, list(group), order)


def exact_join(items: DataFrame, needles: DataFrame, name_col: str = "nombre",
               needle_col: str = "ingrediente", how: str = "inner") -> DataFrame:
    """Equi-join on trim(lower(name)) = trim(lower(needle))."""
    return items.join(needles, norm_text(items[name_col]) == norm_text(needles[needle_col]), how)


def unmatched(needles: DataFrame, items: DataFrame, keys=("receta", "ingrediente"),
              name_col: str = "nombre", needle_col: str = "ingrediente") -> DataFrame:
    """C4 (live form): needles with no equal name at all (anti-join on
    distinct names), labelled like the diagnostic listing."""
    names = items.select(F.col(name_col).alias("_n")).distinct()
    miss = needles.select(*keys).distinct().join(
        names, norm_text(F.col(needle_col)) == norm_text(F.col("_n")), "left_anti")
    return (miss.withColumn("nombre_en_tabla", F.lit(None).cast("string"))
                .withColumn("estado", F.lit(NO_MATCH)))


def match_status(needles: DataFrame, items: DataFrame, since, keys=("receta", "ingrediente"),
                 name_col: str = "nombre", needle_col: str = "ingrediente",
                 date_col: str = "fecha_extraccion") -> DataFrame:
    """C4 (full form): distinct needles with every equal item name not older
    than ``since`` (or undated), and needles that equal no name at all; a needle
    that only matches old rows disappears, as in the source query.

    Items stream past the needles (the small side of inner joins, which
    Catalyst may broadcast); only the needles met are grouped and taken off."""
    left = needles.select(*keys).distinct().withColumn("_k", norm_text(needle_col))
    right = items.select(F.col(name_col).alias("nombre_en_tabla"), F.col(date_col).alias("_d"),
                         norm_text(name_col).alias("_k"))
    recent = (right.where((F.col("_d") >= F.lit(since)) | F.col("_d").isNull()).join(left, "_k")
              .select(*keys, "nombre_en_tabla", F.lit(MATCH).alias("estado")))
    met = right.join(left.select("_k").distinct(), "_k").select("_k").distinct()
    missed = left.join(met, "_k", "left_anti").select(
        *keys, F.lit(None).cast("string").alias("nombre_en_tabla"), F.lit(NO_MATCH).alias("estado"))
    return recent.unionByName(missed)
