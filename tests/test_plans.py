"""Physical-plan checks: the plans we want at scale."""

import datetime as dt

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tillroll.operators.match import match_status
from tillroll.plans import gold, qa, silver
from tillroll.sources.literal import literal_table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_dedup_uses_group_limit_and_pruned_scan(spark):
    p = plan(silver.silver(spark, SF_SMALL))
    # top-1 per key is limited map-side before the shuffle
    assert "WindowGroupLimit" in p
    # only the needed line-item columns are read
    assert "l_quantity" not in p and "l_discount" not in p


def test_recipe_match_has_no_nested_loop(spark):
    p = plan(gold.recipe_cost_summary(spark, SF_SMALL))
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_category_filter_placement(spark, scratch):
    from pyspark.sql import functions as F

    from tillroll.operators.change import price_change
    # on derived Silver the category filter must stay above the newest-row
    # window (pushing it below would change which row is the newest)
    derived = plan(gold.evolution(spark, SF_SMALL))
    assert "WindowGroupLimit" in derived and "PROMO" in derived
    # on stored Silver it is pushed into the parquet scan
    path = f"{scratch}/silver"
    silver.silver(spark, SF_SMALL).write.parquet(path)
    stored = price_change(spark.read.parquet(path).where(F.col("categoria") == "PROMO"))
    assert "EqualTo(categoria,PROMO)" in plan(stored)


def test_quality_report_is_single_scan(spark):
    p = plan(qa.exploration(spark, SF_SMALL))
    assert "Cartesian" not in p and "NestedLoop" not in p


def test_match_status_streams_items_past_the_needles(spark):
    needles = spark.createDataFrame([("r", "Pan"), ("r", "leche"), ("r", "sal"), ("r", "té"), ("r", None)],
                                    "receta string, ingrediente string")
    old, new = dt.date(2020, 1, 1), dt.date(2026, 5, 1)
    items = spark.createDataFrame([(" PAN ", new), ("pan", old), ("leche", old), ("sal", None), (None, new)],
                                  "nombre string, fecha_extraccion date")
    got = match_status(needles, items, dt.date(2026, 1, 1))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        ("r", "Pan", " PAN ", "MATCH"), ("r", "sal", "sal", "MATCH"),  # leche only matches an old row
        ("r", "té", None, "SIN MATCH"), ("r", None, None, "SIN MATCH")]))

    many = spark.range(50_000_000).select(F.concat(F.lit("n"), "id").alias("nombre"), F.lit(new).alias("fecha_extraccion"))
    literal = literal_table(spark, [("r", "Pan")], "receta string, ingrediente string")
    p = plan(match_status(literal, many, old))
    assert p.count("BroadcastHashJoin") >= 2
