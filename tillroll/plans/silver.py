"""Q1 Silver build and Q2 Silver upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import ntz_lit
from tillroll.operators.clean import (quality_filter, to_silver, with_price,
                                      with_product_id)
from tillroll.operators.dedup import latest_per_key
from tillroll.plans import params
from tillroll.sources.feed import TIE_BREAK, price_feed, tie_break_order

# Generic total order for Bronze rows without line keys: newest first, then
# batch and row content (rows equal on all of these are identical).
GENERIC_ORDER = ("ingestion_timestamp", "batch_id", "url", "precio", "descripcion", "categoria",
                 "unidad")


def bronze_order(columns) -> list:
    if all(c in columns for c in TIE_BREAK):
        return tie_break_order()
    return [F.col(c).desc_nulls_last() for c in GENERIC_ORDER if c in columns]


def silver_from_bronze(bronze: DataFrame, updated_at: dt.datetime = params.UPDATED_AT,
                       order=None, thousands: str | None = None, stamps: bool = False) -> DataFrame:
    """Q1: parse, filter (a null observation date is rejected as well: it is
    part of the key), key, keep the newest row per (product, day)."""
    clean = quality_filter(with_price(bronze, thousands=thousands), date_col="fecha_extraccion")
    keyed = with_product_id(clean)
    newest = latest_per_key(keyed, ["producto_id", "fecha_extraccion"],
                            order if order is not None else bronze_order(bronze.columns))
    return to_silver(newest, ntz_lit(updated_at), stamps)


def bronze(spark: SparkSession, base: str) -> DataFrame:
    return price_feed(spark, base)


def silver(spark: SparkSession, base: str) -> DataFrame:
    return silver_from_bronze(price_feed(spark, base))
