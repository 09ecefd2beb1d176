"""Change against the previous record of the same product.

One window (partition = product, order = date) feeds both outputs; the
previous value is computed once.  After Silver's dedup a product holds one
row per day, so a window partition is bounded by the length of the
calendar, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.schemas import PRICE

PCT = PRICE


def price_change(df: DataFrame, key: str = "producto_id", order: str = "fecha_extraccion",
                 value: str = "precio_normalizado", abs_out: str = "cambio_diario",
                 pct_out: str = "cambio_porcentual", max_gap_days: int | None = None) -> DataFrame:
    """``max_gap_days`` (optional) blanks the change when the previous record
    is more than that many days older (previous *day* instead of *record*)."""
    w = Window.partitionBy(key).orderBy(order)
    prev = F.lag(value).over(w)
    out = df.withColumn("_prev", prev)
    if max_gap_days is not None:
        gap = F.datediff(F.col(order), F.lag(order).over(w))
        out = out.withColumn("_prev", F.when(gap <= max_gap_days, F.col("_prev")))
    diff = F.col(value) - F.col("_prev")
    pct = F.round(F.try_divide(diff, F.col("_prev")) * 100, 2)
    return (out.withColumn(abs_out, diff.cast(PRICE))
               .withColumn(pct_out, pct.cast(PCT))
               .drop("_prev"))


def change_alerts(changes: DataFrame, threshold_pct: float = 10.0,
                  pct_col: str = "cambio_porcentual") -> DataFrame:
    """Rows whose |percent change| exceeds the alert threshold (10 %)."""
    return changes.where(F.abs(F.col(pct_col)) > F.lit(threshold_pct))
