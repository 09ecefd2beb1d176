"""Analyses over the price history: stores compared on the same products,
category price indices and product trends.

Sums are exact (whole cents and days), so results do not depend on the order
in which tasks add up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Trend labels.
RISING, FALLING, STEADY = "SUBE", "BAJA", "ESTABLE"


def cents(price: str = "precio_normalizado") -> Column:
    return (F.col(price) * 100).cast("long")


def store_comparison(silver: DataFrame, price: str = "precio_normalizado") -> DataFrame:
    """Per store and date, over the names that two stores or more sell that
    day: how many, how often this store is (one of) the cheapest, and its mean
    price relative to the names' mean price over stores, in millionths.

    Names are summed per date with map-side combining and joined back, so a
    name that every store sells is no group of one task.  ``silver`` is read
    twice; hand over a table or a materialised layer."""
    rows = silver.where(F.col("nombre").isNotNull()).select("supermercado", "nombre", "fecha_extraccion", cents(price).alias("c"))
    names = rows.groupBy("nombre", "fecha_extraccion").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c").alias("total"), F.min("c").alias("least")).where("n > 1 and total > 0")
    each = rows.join(names, ["nombre", "fecha_extraccion"]).withColumn("relative", F.expr("c * n * 1000000 div total"))
    return each.groupBy("supermercado", "fecha_extraccion").agg(
        F.count(F.lit(1)).alias("productos_comparables"), F.count_if(F.col("c") == F.col("least")).alias("veces_mas_barato"),
        F.expr("sum(relative) div count(1)").alias("indice_relativo_ppm"))


def month_before(date: Column) -> Column:
    return F.add_months(date, -1)


def category_index(silver: DataFrame, period_before: Callable[[Column], Column] = month_before, key: str = "producto_id",
                   price: str = "precio_normalizado") -> DataFrame:
    """Chained price index per category (base 100): for each date the products
    that also have a record one period before are matched, the ratio of their
    summed prices moves the index, and products that come or go do not.  A
    date without matched products has no row; the chain goes on after it.

    The product's window is bounded by the calendar; the chain runs over one
    row per category and date.  Rows without a category have no index."""
    w = Window.partitionBy(key).orderBy("fecha_extraccion")
    rows = silver.where(F.col("categoria").isNotNull()).select(
        "categoria", key, "fecha_extraccion", cents(price).alias("now"))
    rows = rows.withColumn("then", F.lag("now").over(w)).withColumn("at", F.lag("fecha_extraccion").over(w))
    matched = rows.where(F.col("at") == period_before(F.col("fecha_extraccion")))
    moved = matched.groupBy("categoria", "fecha_extraccion").agg(
        F.count(F.lit(1)).alias("productos_comparables"), F.sum("now").alias("now"), F.sum("then").alias("then"))
    chain = Window.partitionBy("categoria").orderBy("fecha_extraccion").rowsBetween(Window.unboundedPreceding, 0)
    step = F.ln(F.col("now").cast("double") / F.col("then").cast("double"))
    return moved.select("categoria", "fecha_extraccion", "productos_comparables",
                        F.round(F.exp(F.sum(step).over(chain)) * 100, 4).alias("indice"))


def price_trend(silver: DataFrame, records: int = 6, key: str = "producto_id", price: str = "precio_normalizado") -> DataFrame:
    """Per record the least-squares slope (price per day) over the product's
    last ``records`` records, this one included, from two on, and whether the
    price rises or falls.  Sums run in whole cents and days."""
    w = Window.partitionBy(key).orderBy("fecha_extraccion").rowsBetween(1 - records, 0)
    x, y = F.unix_date("fecha_extraccion").cast("long"), cents(price)
    rows = silver.select(key, "nombre", "supermercado", "fecha_extraccion", x.alias("x"), y.alias("y"))
    rows = rows.select("*", F.count(F.lit(1)).over(w).alias("registros"), F.sum("x").over(w).alias("sx"), F.sum("y").over(w).alias("sy"),
                       F.sum(F.col("x") * F.col("x")).over(w).alias("sxx"), F.sum(F.col("x") * F.col("y")).over(w).alias("sxy"))
    up = F.col("registros") * F.col("sxy") - F.col("sx") * F.col("sy")
    across = F.col("registros") * F.col("sxx") - F.col("sx") * F.col("sx")
    rows = rows.withColumn("up", up).withColumn("across", across).where("registros > 1 and across > 0")
    label = F.when(F.col("up") > 0, RISING).when(F.col("up") < 0, FALLING).otherwise(STEADY)
    return rows.select(key, "nombre", "supermercado", "fecha_extraccion", "registros",
                       F.round(F.col("up").cast("double") / (F.col("across") * 100).cast("double"), 6).alias("pendiente_diaria"),
                       label.alias("tendencia"))
