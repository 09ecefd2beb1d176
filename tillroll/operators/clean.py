"""Parse prices, filter bad rows, list rejects, shape Silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.price import normalize_price, surrogate_key
from tillroll.schemas import SILVER_STAMPS

# Defaults for a missing category / unit, reject reasons.
DEFAULT_CATEGORY = "Sin Categoría"
DEFAULT_UNIT = "Sin unidad"
REASONS = ("price_unparsable", "price_not_positive", "store_null", "name_null",
           "category_null", "date_null")

REQUIRED = ("supermercado", "nombre", "categoria")


def with_defaults(df: DataFrame, category: str = "categoria", unit: str = "unidad") -> DataFrame:
    """A3: fill a missing category / unit with the configured defaults."""
    return (df.withColumn(category, F.coalesce(F.col(category), F.lit(DEFAULT_CATEGORY)))
              .withColumn(unit, F.coalesce(F.col(unit), F.lit(DEFAULT_UNIT))))


def with_price(df: DataFrame, price_text: str = "precio", out: str = "precio_normalizado",
               thousands: str | None = None) -> DataFrame:
    """B1: computed once, reused by the filter and the projection."""
    return df.withColumn(out, normalize_price(price_text, thousands))


def quality_condition(price: str = "precio_normalizado", required=REQUIRED,
                      date_col: str | None = None) -> Column:
    """Price parsed and > 0, required columns not null.  ``date_col``
    additionally rejects a null observation date (a null key never matches
    an upsert and would be inserted again on every run).

    ``price > 0`` alone also drops an unparsed (null) price; written this
    way the parse expression, which Catalyst pushes into the scan, is
    evaluated once per row instead of twice."""
    cond = F.col(price) > 0
    for c in required:
        cond = cond & F.col(c).isNotNull()
    if date_col:
        cond = cond & F.col(date_col).isNotNull()
    return cond


def quality_filter(df: DataFrame, **kw) -> DataFrame:
    return df.filter(quality_condition(**kw))


def reject_reason(price: str = "precio_normalizado", required=REQUIRED,
                  check_positive: bool = True, date_col: str | None = None) -> Column:
    """First failing rule, null when the row passes."""
    chain = F.when(F.col(price).isNull(), F.lit(REASONS[0]))
    if check_positive:
        chain = chain.when(F.col(price) <= 0, F.lit(REASONS[1]))
    for c, reason in zip(required, REASONS[2:5]):
        chain = chain.when(F.col(c).isNull(), F.lit(reason))
    if date_col:
        chain = chain.when(F.col(date_col).isNull(), F.lit(REASONS[5]))
    return chain


def rejected(df: DataFrame, price: str = "precio_normalizado", check_positive: bool = False,
             limit: int | None = None, order_by: list | None = None, date_col: str | None = None) -> DataFrame:
    """Rows the quality filter drops, with the reason.  The troubleshooting
    form does not test price <= 0 (``check_positive=False``).

    The reason comes out of a generator that gives no row for a good one: a
    filter on it would be pushed below the parsed price and parse each price
    once more."""
    reason = reject_reason(price, check_positive=check_positive, date_col=date_col)
    out = df.select("*", F.explode(F.when(reason.isNotNull(), F.array(reason))).alias("reject_reason"))
    if limit is not None:
        out = out.orderBy(*(order_by or df.columns)).limit(limit)
    return out


def with_product_id(df: DataFrame, store: str = "supermercado", name: str = "nombre",
                    out: str = "producto_id") -> DataFrame:
    """B2: md5(store || '|' || name), stable across days."""
    return df.withColumn(out, surrogate_key(store, name))


SILVER_COLUMNS = ("producto_id", "supermercado", "categoria", "nombre", "descripcion", "url",
                  "precio_normalizado", "unidad", "fecha_extraccion", "fecha_actualizacion")


def to_silver(df: DataFrame, updated_at: Column, stamps: bool = False) -> DataFrame:
    """Drop technical columns, stamp the update time.  ``stamps`` keeps the
    ingest time and batch of the row (``SILVER_STAMPS``) for conditional upserts."""
    kept = [F.col(c).alias(s) for c, s in zip(("ingestion_timestamp", "batch_id"), SILVER_STAMPS)] if stamps else []
    return df.withColumn("fecha_actualizacion", updated_at).select(*SILVER_COLUMNS, *kept)
