"""History profile, load counts, top prices, and the
next-day merge preview."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.session import materialise

# Preview row tags.
TAG_CURRENT = "REGISTRO ACTUAL"
TAG_SIMULATED = "NUEVO MAÑANA (simulado)"
PREVIEW_PRICE = "decimal(22,4)"


def simulate_day(silver: DataFrame, day, new_day, factor: str = "1.05") -> DataFrame:
    """Rows of ``day`` copied to ``new_day`` with price x factor."""
    exact = Decimal(factor)
    digits, scale = len(exact.as_tuple().digits), max(0, -exact.as_tuple().exponent)
    f = F.lit(exact).cast(f"decimal({max(digits, scale + 1)},{scale})")
    return (silver.where(F.col("fecha_extraccion") == F.lit(day))
                  .withColumn("precio_normalizado", F.col("precio_normalizado") * f)
                  .withColumn("fecha_extraccion", F.lit(new_day)))


def merge_preview(silver: DataFrame, day, new_day, factor: str = "1.05",
                  limit: int | None = None) -> DataFrame:
    """Current history plus the simulated day, tagged.  ``limit``
    gives the sorted preview (name, date; ids and tags break ties)."""
    cols = ["nombre", "producto_id", "fecha_extraccion"]
    cur = silver.select(*cols, F.col("precio_normalizado").cast(PREVIEW_PRICE).alias("precio_normalizado"),
                        F.lit(TAG_CURRENT).alias("tipo"))
    sim = simulate_day(silver, day, new_day, factor).select(
        *cols, F.col("precio_normalizado").cast(PREVIEW_PRICE).alias("precio_normalizado"),
        F.lit(TAG_SIMULATED).alias("tipo"))
    out = cur.unionByName(sim)
    if limit is not None:
        out = out.orderBy("nombre", "fecha_extraccion", "producto_id", "tipo").limit(limit)
    return out


def row_count(df: DataFrame, out: str = "total_registros") -> DataFrame:
    """D1."""
    return df.agg(F.count(F.lit(1)).alias(out))


def history_profile(silver: DataFrame) -> DataFrame:
    """Distinct products and dates, rows, first and last date.

    No row is expanded per distinct count: products and dates are each counted
    in two levels, and a task ships at most one row per product (which also
    adds up rows and finds the first and last date) or date.  Both read the
    two narrow columns, materialised once."""
    rows = materialise(silver.select("producto_id", "fecha_extraccion"))
    products = rows.groupBy("producto_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("fecha_extraccion").alias("first"), F.max("fecha_extraccion").alias("last"))
    nothing, no_date = F.lit(None).cast("long"), F.lit(None).cast("date")
    totals = products.agg(F.count("producto_id").alias("productos_unicos"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_filas"),
                          F.min("first").alias("primer_registro"), F.max("last").alias("ultimo_registro"))
    days = rows.groupBy("fecha_extraccion").agg(F.count(F.lit(1)).alias("n"))
    dates = days.agg(F.count("fecha_extraccion").alias("fechas_distintas"))
    both = totals.withColumn("fechas_distintas", nothing).unionByName(dates.select(
        nothing.alias("productos_unicos"), nothing.alias("total_filas"), no_date.alias("primer_registro"),
        no_date.alias("ultimo_registro"), "fechas_distintas"))
    order = ("productos_unicos", "fechas_distintas", "total_filas", "primer_registro", "ultimo_registro")
    return both.agg(*[F.max(c).alias(c) for c in order])


def rows_per_load(bronze: DataFrame) -> DataFrame:
    """D3: rows per load date and batch."""
    return bronze.groupBy("load_date", "batch_id").agg(F.count(F.lit(1)).alias("filas"))


def top_prices(silver: DataFrame, day, n: int = 10) -> DataFrame:
    """the n highest prices of a day (top-k; product id breaks ties)."""
    return (silver.where(F.col("fecha_extraccion") == F.lit(day))
                  .select("nombre", "supermercado", "precio_normalizado", "fecha_extraccion", "producto_id")
                  .orderBy(F.col("precio_normalizado").desc(), F.col("producto_id"))
                  .limit(n)
                  .drop("producto_id"))


def product_listing(bronze: DataFrame) -> DataFrame:
    """G5 (Q21): distinct (name, description, category)."""
    return bronze.select("nombre", "descripcion", "categoria").distinct()
