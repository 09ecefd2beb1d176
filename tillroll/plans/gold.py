"""Q3-Q11: price evolution, unit-price catalogue, recipe costing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.analysis import category_index, price_trend, store_comparison
from tillroll.operators.change import change_alerts as alerts
from tillroll.operators.change import price_change
from tillroll.operators.costing import (all_matches_cost, catalogue, exact_name_costs,
                                        ingredient_costs, recipe_pivot, recipe_summary,
                                        rule_recipe_cost, sale_catalogue)
from tillroll.operators.match import match_status, unmatched
from tillroll.plans import params as P
from tillroll.plans.silver import silver
from tillroll.session import materialise


def evolution(spark: SparkSession, base: str, category: str | None = P.PROMO_CATEGORY) -> DataFrame:
    """Q3: day-over-day change for one category (filter first, as the view)."""
    s = silver(spark, base)
    if category is not None:
        s = s.where(F.col("categoria") == F.lit(category))
    out = price_change(s)
    out = out.select("fecha_extraccion", "nombre", "supermercado", "categoria",
                     "precio_normalizado", "cambio_diario", "cambio_porcentual", "url")
    return out.orderBy(F.col("fecha_extraccion").desc(), "supermercado", "nombre")


def change_alerts(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the evolution whose |change| exceeds 10 %."""
    return alerts(evolution(spark, base))


def evolution_all(spark: SparkSession, base: str) -> DataFrame:
    return evolution(spark, base, None)


def unit_catalogue(spark: SparkSession, base: str) -> DataFrame:
    """Q4."""
    return catalogue(silver(spark, base))


def recipe_costs(spark: SparkSession, base: str) -> DataFrame:
    """Q5, over the catalogue as a table: Silver is derived once."""
    return ingredient_costs(materialise(unit_catalogue(spark, base)), P.recipes_df(spark))


def recipe_cost_summary(spark: SparkSession, base: str) -> DataFrame:
    """Q6 (flagship)."""
    return recipe_summary(recipe_costs(spark, base), since=P.SINCE,
                          comments=P.FIXTURE_COMMENTS).orderBy("receta", "fecha_extraccion")


def recipe_cost_all_matches(spark: SparkSession, base: str) -> DataFrame:
    """Q7."""
    today = unit_catalogue(spark, base).where(F.col("fecha_extraccion") == F.lit(P.AS_OF))
    return all_matches_cost(materialise(today), P.recipes_df(spark), P.AS_OF)


def rule_cost_a(spark: SparkSession, base: str) -> DataFrame:
    """Q8 (first recipe, yield 2)."""
    return rule_recipe_cost(silver(spark, base), P.rules_df(spark, P.RULES_A),
                            P.quantities_df(spark, P.QTY_A), P.DIVISOR_A, P.SINCE,
                            "costo_receta").orderBy("fecha_extraccion")


def rule_cost_b(spark: SparkSession, base: str) -> DataFrame:
    """Q8 (second recipe, yield 3)."""
    return rule_recipe_cost(silver(spark, base), P.rules_df(spark, P.RULES_B),
                            P.quantities_df(spark, P.QTY_B), P.DIVISOR_B, P.SINCE,
                            "costo_receta").orderBy("fecha_extraccion")


def rule_pivot(spark: SparkSession, base: str) -> DataFrame:
    """Q9."""
    return recipe_pivot(silver(spark, base), P.rules_df(spark, P.RULES_ALL),
                        P.quantities_df(spark, P.QTY_A + P.QTY_B), P.PIVOT_COLUMNS,
                        P.SINCE).orderBy("fecha_extraccion")


def _sale_catalogue(spark, base):
    return sale_catalogue(silver(spark, base), P.EXACT_WEIGHT_NAMES, P.EXACT_BEFORE,
                          P.EXACT_AFTER, P.EXACT_NAMES)


def exact_name_summary(spark: SparkSession, base: str) -> DataFrame:
    """Q10: summary over the exact-name join."""
    costs = exact_name_costs(_sale_catalogue(spark, base), P.recipes_df(spark, P.EXACT_RECIPES))
    return recipe_summary(costs, since=P.SINCE, comments=P.FIXTURE_COMMENTS).orderBy(
        "receta", "fecha_extraccion")


def exact_name_detail(spark: SparkSession, base: str) -> DataFrame:
    """Q10 detail: cost per ingredient and product row, with measure class and sale unit."""
    return exact_name_costs(_sale_catalogue(spark, base), P.recipes_df(spark, P.EXACT_RECIPES))


def named_sale_catalogue(spark: SparkSession, base: str) -> DataFrame:
    """B11 / B12 over product names that carry the package (`500g`, `X 30u`,
    `Litro`): the description, a word for the litre packs added."""
    litre = F.when(F.col("unidad") == "medio_ltr", F.lit(" Litro")).when(F.col("unidad") == "kg", F.lit(" Grm")).otherwise(F.lit(""))
    return sale_catalogue(silver(spark, base).withColumn("nombre", F.concat("descripcion", litre)))


def stores_compared(spark: SparkSession, base: str) -> DataFrame:
    return store_comparison(materialise(silver(spark, base).select("supermercado", "nombre", "fecha_extraccion", "precio_normalizado")))


def category_indices(spark: SparkSession, base: str) -> DataFrame:
    return category_index(silver(spark, base))


def price_trends(spark: SparkSession, base: str) -> DataFrame:
    return price_trend(silver(spark, base), P.TREND_RECORDS)


def exact_name_unmatched(spark: SparkSession, base: str) -> DataFrame:
    """Q10 live query: ingredients with no equal product name."""
    return unmatched(P.recipes_df(spark, P.EXACT_RECIPES), _sale_catalogue(spark, base)).orderBy(
        "receta", "ingrediente")


def match_diagnostics(spark: SparkSession, base: str) -> DataFrame:
    """Q11: match status of every (recipe, ingredient) against all products
    observed since ``SINCE`` (one row per matching product row)."""
    return match_status(P.recipes_df(spark), silver(spark, base), P.SINCE)


def unmatched_ingredients(spark: SparkSession, base: str) -> DataFrame:
    """Q11 (live form): ingredients without any equal product name."""
    return unmatched(P.recipes_df(spark), silver(spark, base)).orderBy("receta", "ingrediente")
