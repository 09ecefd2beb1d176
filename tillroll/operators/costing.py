"""Unit-price catalogue and recipe (bill of materials)
costing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.quantity import (base_quantity, first_integer, measure_class,
                                         sale_quantity, sale_unit, unit_price)
from tillroll.functions.text import half_up_div, norm_text
from tillroll.operators.match import best_match, containment_join, exact_join
from tillroll.schemas import PRICE

# Portion notes of the three reference recipes.
DEFAULT_COMMENTS = {
    "Pizza": "Porcion = 1 pizza",
    "Empanadas": "Porcion = 1 docena",
    "Milanesas": "Porcion = 1 kg",
}

CATALOGUE_COLUMNS = ("nombre", "descripcion", "categoria", "precio_normalizado", "unidad",
                     "cantidad_base", "precio_unitario", "fecha_extraccion", "url")


def catalogue(silver: DataFrame, extra: Sequence[str] = ("supermercado",)) -> DataFrame:
    """Q4: package size in base units and price per base unit (4 decimals).

    ``extra`` keeps columns beyond the view's nine (the store is the
    tie-break of the best match)."""
    out = (silver.withColumn("cantidad_base", base_quantity("unidad", "descripcion"))
                 .withColumn("precio_unitario", unit_price("precio_normalizado", "cantidad_base")))
    return out.select(*CATALOGUE_COLUMNS, *extra)


def _comment(recipe: Column, comments: Mapping[str, str] | None) -> Column:
    chain = None
    for name, text in (comments or {}).items():
        cond = recipe == F.lit(name)
        chain = F.when(cond, F.lit(text)) if chain is None else chain.when(cond, F.lit(text))
    return chain if chain is not None else F.lit(None).cast("string")


def ingredient_costs(cat: DataFrame, recipes: DataFrame) -> DataFrame:
    """Q5: the best product per (recipe, ingredient, date) and its cost."""
    best = best_match(cat, recipes)
    return best.select(
        "receta", "ingrediente",
        F.col("nombre").alias("nombre_producto_completo"),
        "descripcion", "categoria",
        F.col("precio_normalizado").alias("precio_producto"),
        "cantidad_base", "precio_unitario", "unidad", "cantidad_necesaria", "unidad_receta",
        F.round(F.col("precio_unitario") * F.col("cantidad_necesaria"), 2).cast(PRICE)
         .alias("costo_ingrediente"),
        "rendimiento_porciones", "fecha_extraccion", "match_score", "nombre_length", "url")


def recipe_summary(costs: DataFrame, since=None, comments: Mapping[str, str] | None = None,
                   cost_col: str = "costo_ingrediente") -> DataFrame:
    """Total, portions and cost per portion by recipe and date."""
    if since is not None:
        costs = costs.where(F.col("fecha_extraccion") >= F.lit(since))
    agg = costs.groupBy("receta", "fecha_extraccion").agg(
        F.sum(cost_col).alias("_s"), F.max("rendimiento_porciones").alias("porciones"))
    return agg.select(
        "receta", "fecha_extraccion",
        F.round("_s", 2).cast(PRICE).alias("costo_total"),
        "porciones",
        half_up_div("_s", "porciones", 2).cast(PRICE).alias("costo_por_porcion"),
        _comment(F.col("receta"), DEFAULT_COMMENTS if comments is None else comments)
         .alias("comentarios"))


def all_matches_cost(cat: DataFrame, recipes: DataFrame, day) -> DataFrame:
    """Q7: cost on one day summing *every* containing product (no ranking),
    lower-case match without trimming, per-ingredient cost not rounded."""
    today = cat.where(F.col("fecha_extraccion") == F.lit(day))
    j = containment_join(today, recipes, trim=False)
    j = j.withColumn("_c", F.col("precio_unitario") * F.col("cantidad_necesaria"))
    agg = j.groupBy("receta").agg(F.sum("_c").alias("_s"),
                                  F.max("rendimiento_porciones").alias("porciones"))
    return agg.select("receta", F.round("_s", 2).cast(PRICE).alias("costo_total"), "porciones",
                      half_up_div("_s", "porciones", 2).cast(PRICE).alias("costo_por_porcion"))


# ---------------------------------------------------------------- name rules
def _round_by(x: Column, scale: Column) -> Column:
    """Round half up to the row's own scale: ``round`` needs a literal one, so
    each scale up to a price's (18 digits) has its branch; another one is an error."""
    chain = F.when(scale.isNull(), F.raise_error(F.lit("a rule needs a scale")))
    for s in range(19):
        chain = chain.when(scale == s, F.round(x, s).cast("decimal(38,18)"))
    return chain.otherwise(F.raise_error(F.concat(F.lit("no such scale: "), scale.cast("string"))))


def rule_priced(silver: DataFrame, rules: DataFrame) -> DataFrame:
    """Per-name package rules -> price per gram / per unit.

    ``rules`` (one row per product name): nombre, gramos INT (explicit
    grams), gramos_de_nombre BOOLEAN (read the first integer of the name),
    unidades INT, op ('mul' | 'div' | null), divisor INT (null: unidades,
    then 1), escala INT (0 to 18).  The inner join is the name list."""
    p = silver.select(F.col("nombre"), F.col("precio_normalizado").alias("precio"),
                      "fecha_extraccion", "url").join(rules, "nombre")
    grams = F.when(F.col("gramos").isNotNull(), F.col("gramos")) \
             .when(F.col("gramos_de_nombre"), first_integer("nombre"))
    p = p.withColumn("peso_en_gramos", grams.cast("int"))
    per_gram = F.round(F.try_divide(F.col("precio"), F.nullif(F.col("peso_en_gramos"), F.lit(0))), 2)
    div = F.coalesce(F.col("divisor"), F.col("unidades"), F.lit(1))
    per_unit = (F.when(F.col("op") == "mul", _round_by(F.col("precio") * F.col("unidades"), F.col("escala")))
                 .when(F.col("op") == "div",
                       _round_by(F.try_divide(F.col("precio"), F.nullif(div, F.lit(0))), F.col("escala"))))
    return (p.withColumn("precio_por_gramo", per_gram)
             .withColumn("precio_por_unidad", per_unit)
             .withColumn("precio_unitario_regla", F.coalesce("precio_por_gramo", "precio_por_unidad")))


def rule_costs(silver: DataFrame, rules: DataFrame, quantities: DataFrame,
               how: str = "left") -> DataFrame:
    """Per product row and recipe: cost = round(unit price x quantity, 2).
    ``quantities``: receta, nombre, cantidad_receta; joined on the
    normalised name (``how='left'`` keeps products without a quantity)."""
    p = rule_priced(silver, rules)
    q = quantities.select("receta", F.col("nombre").alias("_qn"), "cantidad_receta")
    j = p.join(q, norm_text(p.nombre) == norm_text(q._qn), how)
    return j.withColumn("costo", F.round(F.col("precio_unitario_regla") * F.col("cantidad_receta"), 2))


def rule_recipe_cost(silver: DataFrame, rules: DataFrame, quantities: DataFrame, divisor: int,
                     since=None, out: str = "costo_receta") -> DataFrame:
    """One recipe, cost per date divided by the yield."""
    c = rule_costs(silver, rules, quantities, "left")
    if since is not None:
        c = c.where(F.col("fecha_extraccion") >= F.lit(since))
    agg = c.groupBy("fecha_extraccion").agg(F.sum("costo").alias("_s"))
    return agg.select("fecha_extraccion", half_up_div("_s", F.lit(divisor), 2).cast(PRICE).alias(out))


def recipe_pivot(silver: DataFrame, rules: DataFrame, quantities: DataFrame,
                 columns: Mapping[str, tuple[str, int]], since=None,
                 total: str = "costo_total_recetas") -> DataFrame:
    """One row per date, one cost column per recipe (ELSE 0, so a
    recipe without rows on a date costs 0.00) and the grand total."""
    c = rule_costs(silver, rules, quantities, "inner")
    if since is not None:
        c = c.where(F.col("fecha_extraccion") >= F.lit(since))
    aggs = [F.sum(F.when(F.col("receta") == F.lit(r), F.col("costo")).otherwise(F.lit(0)))
             .alias(f"_s_{i}") for i, r in enumerate(columns)]
    agg = c.groupBy("fecha_extraccion").agg(*aggs, F.sum("costo").alias("_t"))
    outs = [half_up_div(f"_s_{i}", F.lit(k), 2).cast(PRICE).alias(name)
            for i, (name, k) in enumerate(columns.values())]
    return agg.select("fecha_extraccion", *outs, F.round("_t", 2).cast(PRICE).alias(total))


# ---------------------------------------------------------- exact-name costing
def sale_catalogue(silver: DataFrame, weight_names=(), before=None, after=None,
                   names: Sequence[str] | None = None) -> DataFrame:
    """B11/B12 catalogue: measure class, sale unit, sale quantity and price
    per base unit, driven by the product name."""
    s = silver if names is None else silver.where(F.col("nombre").isin(*names))
    out = s.select(
        "nombre", F.col("precio_normalizado").alias("precio"), "fecha_extraccion",
        measure_class("nombre", weight_names).alias("tipo_medida"),
        sale_quantity("nombre", before, after).alias("cantidad_venta"),
        sale_unit("nombre", weight_names).alias("unidad_venta"), "url")
    return out.withColumn("precio_por_unidad_base",
                          unit_price("precio", "cantidad_venta"))


def exact_name_costs(cat: DataFrame, recipes: DataFrame) -> DataFrame:
    """Q10 detail: inner equi-join on the normalised name, cost per row."""
    j = exact_join(cat, recipes)
    return j.select(
        "receta", "ingrediente", "tipo_medida", F.col("precio").alias("precio_producto"),
        "cantidad_venta", "precio_por_unidad_base", "unidad_venta", "cantidad_necesaria",
        "unidad_receta",
        F.round(F.col("precio_por_unidad_base") * F.col("cantidad_necesaria"), 2).cast(PRICE)
         .alias("costo_ingrediente"),
        "rendimiento_porciones", "fecha_extraccion")

