"""The layer tables and Gold results as named (temporary) views, so
SQL users query them by name as before (``SELECT * FROM
resumen_costos_recetas``).  Views stay lazy: each query over them is
planned (and pruned / pushed down) as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.change import price_change
from tillroll.operators.costing import catalogue, ingredient_costs, recipe_summary
from tillroll.sources.recipes import reference_recipes

VIEW_NAMES = ("precios_scraping", "precios_productos", "catalogo_productos", "recetas",
              "costos_recetas", "resumen_costos_recetas", "evolucion_precios")


def register_views(spark: SparkSession, silver: DataFrame, bronze: DataFrame | None = None,
                   recipes: DataFrame | None = None, since=None, comments=None) -> dict[str, DataFrame]:
    rec = recipes if recipes is not None else reference_recipes(spark)
    cat = catalogue(silver)
    costs = ingredient_costs(cat, rec)
    views = {
        "precios_productos": silver,
        "catalogo_productos": cat,
        "recetas": rec,
        "costos_recetas": costs,
        "resumen_costos_recetas": recipe_summary(costs, since=since, comments=comments),
        "evolucion_precios": price_change(silver),
    }
    if bronze is not None:
        views["precios_scraping"] = bronze
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
