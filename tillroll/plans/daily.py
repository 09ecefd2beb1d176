"""One daily run end to end, on files: raw payloads -> Bronze + audit ->
Silver history (upsert of the days just loaded) -> Gold tables.

Each step reads what the previous step wrote, as the layered tables do;
only the days present in the new Bronze batch are rewritten in Silver, and in
Gold those and the days on which a product's next record is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import ingest as I
from tillroll.operators.costing import catalogue, ingredient_costs, recipe_summary
from tillroll.operators.maintain import refresh_changes, refresh_dates
from tillroll.operators.upsert import merge_into_path
from tillroll.plans.silver import silver_from_bronze
from tillroll.schemas import SILVER_STAMPS
from tillroll.sources.config import complete_fetches
from tillroll.sources.payload import parse_shop
from tillroll.sources.recipes import reference_recipes
from tillroll.sources.sinks import write_ingest_run


def parse_shop_payloads(raw: DataFrame) -> DataFrame:
    """A4 on the shop payload shape (price inside a JSON string)."""
    return parse_shop(raw)


def run_daily(spark: SparkSession, raw: DataFrame, root: str, batch_id: str | None = None, run_at: dt.datetime | None = None,
              recipes: DataFrame | None = None, since=None, comments=None, targets: DataFrame | None = None) -> DataFrame:
    """``raw``: corte, supermercado, url, payload, categoria, unidad (one row
    per fetched page).  Writes under ``root`` and returns the run metrics.

    With ``targets`` (``sources.config.expand_targets``) every configured url
    counts, fetched or not.  A run without any parsed row, or without any
    fetch, is logged (0 %, FAILED with stack) and raises.  Only the Bronze rows
    of this batch are read back, and only the touched dates of Silver and Gold
    are read and replaced."""
    batch_id = batch_id or I.new_batch_id()
    run_at = run_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    fetches = complete_fetches(targets, raw) if targets is not None else raw
    parsed = I.stamp_batch(parse_shop_payloads(fetches), batch_id, run_at)
    routed = I.with_status(parsed, F.col("_fault"))
    metrics = write_ingest_run(spark, routed, f"{root}/bronze_run", runs=I.one_run(spark, batch_id, run_at))
    if metrics.where(F.col("rows_success") > 0).isEmpty():
        raise I.empty_batch_error()[0]
    bronze = spark.read.parquet(f"{root}/bronze_run/bronze")
    loaded = bronze.where((F.col("load_date") == F.lit(run_at.date())) & (F.col("batch_id") == batch_id))
    dates = merge_into_path(spark, silver_from_bronze(loaded, run_at, stamps=True), f"{root}/silver", newer_by=SILVER_STAMPS)
    refresh_gold(spark, root, dates, recipes if recipes is not None else reference_recipes(spark), since, comments)
    return metrics


def refresh_gold(spark: SparkSession, root: str, dates, recipes: DataFrame, since=None, comments=None) -> None:
    """The Gold tables after ``dates`` of Silver were written.  Each step reads
    the table before it, and of it the touched dates only."""
    gold = f"{root}/gold"
    refresh_dates(spark, catalogue, spark.read.parquet(f"{root}/silver"), f"{gold}/catalogo_productos", dates)
    refresh_dates(spark, lambda cat: ingredient_costs(cat, recipes), spark.read.parquet(f"{gold}/catalogo_productos"),
                  f"{gold}/costos_recetas", dates)
    refresh_dates(spark, lambda costs: recipe_summary(costs, since=since, comments=comments),
                  spark.read.parquet(f"{gold}/costos_recetas"), f"{gold}/resumen_costos_recetas", dates)
    refresh_changes(spark, f"{root}/silver", f"{gold}/evolucion_precios", f"{gold}/productos_fechas", dates)
