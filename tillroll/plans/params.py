"""Parameters of the registered queries (run dates, fixture recipes, rules).

Clock functions of the reference (CURRENT_DATE / CURRENT_TIMESTAMP) become
these explicit values so that results repeat and can be checked.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tillroll.schemas import RECIPES

UPDATED_AT = dt.datetime(2002, 1, 1, 0, 0, 0)   # Silver run time
AS_OF = dt.date(1998, 6, 1)                       # "today" of daily reports
SINCE = dt.date(1998, 1, 1)                       # "fecha >= ..." report filters
LATEST_DAY = dt.date(2001, 11, 2)                  # day after the newest obs month
TOP_N = 10
PROMO_CATEGORY = "PROMO"                            # plays the meat category
UPSERT_CUTOFF = dt.date(1998, 1, 1)                 # target = silver before this day
UPSERT_SOURCE_FROM = dt.date(1997, 1, 1)            # source = silver from this day
PREVIEW_DAY = dt.date(2001, 10, 1)                  # day copied by the merge preview
PREVIEW_NEXT = dt.date(2001, 10, 2)
PREVIEW_FACTOR = "1.05"
PREVIEW_ROWS = 20
TREND_RECORDS = 6                                   # records of a product that a trend looks back on

# Recipes over the fixture's part names: (recipe, ingredient, qty, unit, portions).
FIXTURE_RECIPES = [
    ("A", "gear", "500", "gramos", 2),
    ("A", "blue", "3", "gramos", 2),
    ("B", "cold anvil", "0.167", "unidades", 3),
    ("B", "rod", "1", "unidades", 3),
    ("B", "saffron", "2", "gramos", 3),
]
FIXTURE_COMMENTS = {"A": "Portion = 1 tray", "B": "Portion = 1 dozen"}


def recipes_df(spark: SparkSession, rows=None) -> DataFrame:
    from tillroll.sources.literal import literal_table
    return literal_table(spark, rows or FIXTURE_RECIPES, RECIPES)

# Exact-name recipes (Q10): ingredients are whole part names.
EXACT_RECIPES = [
    ("A", "blue gear", "500", "gramos", 2),
    ("A", "red rod", "1", "unidades", 2),
    ("B", "small ring", "200", "gramos", 3),
    ("B", "new plate", "5", "unidades", 3),
    ("B", "no such part", "1", "unidades", 3),
]
EXACT_WEIGHT_NAMES = ("blue gear", "small ring")
EXACT_BEFORE = {"blue gear": 1000, "small ring": 1000}
EXACT_AFTER = {"new plate": 30, "red rod": 1}
EXACT_NAMES = ("blue gear", "red rod", "small ring", "new plate")

# Name-rule costing (Q8/Q9): per-name package rules and per-recipe quantities.
# (nombre, gramos, gramos_de_nombre, unidades, op, divisor, escala)
RULES_A = [
    ("blue gear", 1000, False, None, None, None, None),
    ("red rod", None, False, 1, "mul", None, 0),
    ("cold anvil", None, True, None, None, None, None),
    ("hot bolt", 1000, False, None, None, None, None),
]
RULES_B = [
    ("small ring", 1000, False, None, None, None, None),
    ("new plate", None, False, 30, "div", None, 0),
    ("old widget", None, False, 1, "mul", None, 0),
    ("blue gear", 1000, False, None, None, None, None),
]
RULES_ALL = [
    ("blue gear", 1000, False, None, None, None, None),
    ("red rod", None, False, None, "div", None, 2),
    ("cold anvil", None, True, None, None, None, None),
    ("hot bolt", 1000, False, None, None, None, None),
    ("small ring", 1000, False, None, None, None, None),
    ("new plate", None, False, 30, "div", None, 2),
    ("old widget", None, False, 1, "div", 300, 4),
]
QTY_A = [("A", "blue gear", "500"), ("A", "red rod", "0.166667"), ("A", "cold anvil", "3"),
         ("A", "hot bolt", "600")]
QTY_B = [("B", "small ring", "200"), ("B", "new plate", "5"), ("B", "old widget", "3"),
         ("B", "blue gear", "250")]
DIVISOR_A, DIVISOR_B = 2, 3
PIVOT_COLUMNS = {"A": ("costo_a", 2), "B": ("costo_b", 3)}


def rules_df(spark: SparkSession, rows) -> DataFrame:
    from tillroll.sources.literal import literal_table
    schema = ("nombre string, gramos int, gramos_de_nombre boolean, unidades int, op string, "
              "divisor int, escala int")
    return literal_table(spark, rows, schema)


def quantities_df(spark: SparkSession, rows) -> DataFrame:
    from tillroll.sources.literal import literal_table
    return literal_table(spark, rows, "receta string, nombre string, cantidad_receta decimal(16,6)")

ERRORS_DAY = dt.date(2024, 1, 5)        # "today" of the error listing
PRODUCT_OF_INTEREST = "blue gear"      # product-name filter of the inspection query
