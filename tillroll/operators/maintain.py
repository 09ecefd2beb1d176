"""Keep materialised Gold tables up to date by partition.

Gold tables are partitioned by the observation date, like Silver.  A run that
touched some Silver dates recomputes what depends on them and replaces exactly
those partitions (dynamic overwrite); rows of a date never vanish from Silver,
so a partition is never left behind.

* ``refresh_dates``: views whose rows depend on Silver rows of their own date
  (catalogue, ingredient costs, summaries).
* ``refresh_changes``: the change against the previous record (E3 / E4), where a
  touched date also changes each product's next record, on whatever date that
  is.  The last record before the touched dates is carried in, the first one
  after is recomputed; both are looked for outwards from the touched dates in
  windows of dates that double, only for products that a small table of each
  product's first and last date says to have one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.operators.change import price_change
from tillroll.operators.dedup import latest_per_key
from tillroll.operators.upsert import read_or_none, touched_dates
from tillroll.session import materialise
from tillroll.sources.sinks import save_table


def partition_values(table: DataFrame, column: str) -> list[str]:
    """The values of a partition column as the file names give them, in order:
    no row and no file footer is read."""
    found = {part.split("=", 1)[1] for f in table.inputFiles() for part in f.split("/") if part.startswith(f"{column}=")}
    return sorted(unquote(v) for v in found)


def replace_dates(rows: DataFrame, path: str, date_col: str) -> None:
    """Replace the partitions that ``rows`` (materialised) has rows of."""
    (rows.hint("rebalance", date_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))


def refresh_dates(spark: SparkSession, build: Callable[[DataFrame], DataFrame], source: DataFrame, path: str,
                  dates: Sequence, date_col: str = "fecha_extraccion") -> None:
    """Bring the table at ``path`` up to date with ``build(source)``, given the
    touched dates; without a table there, build it whole."""
    if read_or_none(spark, path) is None:
        save_table(build(source), path, [date_col])
    elif dates:
        replace_dates(build(source.where(F.col(date_col).isin(list(dates)))), path, date_col)


def _nearest(silver: DataFrame, products: DataFrame, days: Sequence[str], latest: bool, key: str, date_col: str) -> DataFrame:
    """The record of each product nearest to the touched dates, among ``days``
    (ordered by nearness)."""
    products, at, width, found = materialise(products), 0, 1, silver.where("false")
    order = F.col(date_col).desc() if latest else F.col(date_col).asc()
    while at < len(days) and not products.isEmpty():
        ends = sorted((days[at], days[min(at + width, len(days)) - 1]))
        window = silver.where(F.col(date_col).between(*[F.lit(e).cast("date") for e in ends]))
        hit = materialise(latest_per_key(window.join(products, key, "left_semi"), [key], [order]))
        found, products = found.unionByName(hit), materialise(products.join(hit, key, "left_anti"))
        at, width = at + width, 2 * width
    return found


def refresh_changes(spark: SparkSession, silver_path: str, path: str, spans_path: str, dates: Sequence,
                    key: str = "producto_id", date_col: str = "fecha_extraccion", value: str = "precio_normalizado",
                    keep: Sequence[str] = ("nombre", "supermercado", "categoria", "url")) -> list:
    """Bring the table of changes at ``path`` (and ``spans_path``, each
    product's first and last date) up to date; the dates that were written."""
    silver = spark.read.parquet(silver_path).select(key, date_col, value, *keep)
    spans, old = read_or_none(spark, spans_path), read_or_none(spark, path)
    each = silver.groupBy(key).agg(F.min(date_col).alias("primera"), F.max(date_col).alias("ultima"))
    if spans is None or old is None:
        save_table(price_change(silver, key, date_col, value), path, [date_col])
        save_table(each, spans_path)
        return partition_values(silver, date_col)
    if not dates:
        return []
    first, last = min(dates), max(dates)
    new = materialise(silver.where(F.col(date_col).isin(list(dates))))
    touched = materialise(new.groupBy(key).agg(F.min(date_col).alias("primera"), F.max(date_col).alias("ultima")))
    known = materialise(spans.join(touched.select(key), key, "left_semi"))
    days = partition_values(silver, date_col)
    before = [d for d in reversed(days) if d < str(first)]
    after = [d for d in days if d > str(last)]
    inside = silver.where(F.col(date_col).between(F.lit(first), F.lit(last))).join(touched.select(key), key, "left_semi")
    rows = (inside.unionByName(_nearest(silver, known.where(F.col("primera") < F.lit(first)).select(key), before, True, key, date_col))
            .unionByName(_nearest(silver, known.where(F.col("ultima") > F.lit(last)).select(key), after, False, key, date_col)))
    previous = F.lag(date_col).over(Window.partitionBy(key).orderBy(date_col))
    changed = price_change(rows.withColumn("_before", previous), key, date_col, value)
    hit = F.col(date_col).isin(list(dates)) | F.coalesce(F.col("_before").isin(list(dates)), F.lit(False))
    changed = materialise(changed.where(hit).drop("_before").select(*old.columns))
    also = [d for d in touched_dates(changed, date_col) if d not in set(dates)]
    kept = old.where(F.col(date_col).isin(also)).join(changed.select(key, date_col), [key, date_col], "left_anti")
    replace_dates(materialise(changed.unionByName(kept.select(*old.columns))), path, date_col)
    merged = spans.unionByName(touched).groupBy(key).agg(F.min("primera").alias("primera"), F.max("ultima").alias("ultima"))
    save_table(materialise(merged), spans_path)
    return sorted([*dates, *also])
