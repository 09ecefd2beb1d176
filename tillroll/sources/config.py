"""A1-A3: product configuration and fetch targets.

A configuration row is (key, nombre, unidad, categoria, urls: map store ->
url).  Targets are the exploded (product, store, url) pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.clean import with_defaults
from tillroll.schemas import PRODUCT_CONFIG
from tillroll.sources.tables import read_table


def config_df(spark: SparkSession, rows) -> DataFrame:
    """A1 from literal rows (a dict per product, as a config file holds)."""
    data = [(r["key"], r.get("nombre"), r.get("unidad"), r.get("categoria"), r.get("urls", {}))
            for r in rows]
    return spark.createDataFrame(data, PRODUCT_CONFIG)


def config_from_parts(spark: SparkSession, base: str) -> DataFrame:
    """A1 over the driver's ``part`` table: one product per part, one or
    two store urls, unit and category sometimes missing."""
    p = read_table(spark, base, "part")
    k = F.col("p_partkey")
    url = F.concat(F.lit("http://s/"), k.cast("string"))
    one = F.create_map(F.concat(F.lit("Store_"), (k % 3).cast("string")), url)
    two = F.map_concat(one, F.create_map(F.lit("Store_9"), F.concat(url, F.lit("?alt"))))
    return p.select(
        F.concat(F.lit("p"), k.cast("string")).alias("key"),
        F.col("p_name").alias("nombre"),
        F.when(F.col("p_size") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.element_at(F.array(F.lit("kg"), F.lit("gr"), F.lit("ml"), F.lit("unidad")),
                                 (F.col("p_size") % 4 + 1).cast("int"))).alias("unidad"),
        F.when(k % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type")).alias("categoria"),
        F.when(k % 10 == 0, two).otherwise(one).alias("urls"))


def expand_targets(config: DataFrame) -> DataFrame:
    """A2 + A3: one row per (product, store, url), defaults applied."""
    t = config.select("key", "nombre", "unidad", "categoria",
                      F.explode(F.map_entries("urls")).alias("_e"))
    t = t.select("key", "nombre", "unidad", "categoria",
                 F.col("_e.key").alias("supermercado"), F.col("_e.value").alias("url"))
    return with_defaults(t)


def complete_fetches(targets: DataFrame, raw: DataFrame) -> DataFrame:
    """The run's fetches by target: one row per configured target, with the
    payload of its fetch, null where it was not fetched (A12: such a target
    counts, and fails).  Of several fetches of a target one with a payload
    stays; fetches of urls that are not configured are left out."""
    pages = raw.groupBy("supermercado", "url").agg(F.max("payload").alias("payload"))
    return (targets.select(F.col("nombre").alias("corte"), "supermercado", "url", "categoria", "unidad")
            .join(pages, ["supermercado", "url"], "left"))


def target_counts(config: DataFrame) -> DataFrame:
    """A2: products configured and urls targeted."""
    return config.agg(F.count(F.lit(1)).alias("products_configured"),
                      F.sum(F.size("urls")).cast("long").alias("urls_target"))
