"""Data-quality checks and reports.

Multi-check reports are computed in one grouped pass and then unpivoted
with ``inline`` (instead of one scan per UNION ALL branch).  Checks that
need a per-group count (duplicates) and row-level checks share that pass:
grouping by the duplicate key gives the group sizes, and per-group flag
counts add up to the row-level totals.  Grouping aggregates partially
before the shuffle, so a key holding a large share of the rows costs no
more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import col_
from tillroll.operators import selection
from tillroll.operators.clean import with_price
from tillroll.session import materialise, small_side

# Report labels.
EXPLORATION_LABELS = (
    "Registros con supermercado nulo",
    "Registros con nombre nulo",
    "Registros con categoría nula",
    "Registros con URL inválida",
    "Registros duplicados",
    "Outliers de precio (alto)",
    "Nombres muy cortos (<3 caracteres)",
)
EXTRA_EXPLORATION_LABELS = ("Outliers de precio (bajo)", "URL sin formato http")
OUTLIER_HIGH, OUTLIER_LOW, PRICE_NORMAL = "OUTLIER_ALTO", "OUTLIER_BAJO", "PRECIO_NORMAL"
URL_VALID, URL_INVALID = "URL_VALIDA", "URL_INVALIDA"
SUITE_NAMES = ("TEST_1_DUPLICADOS", "TEST_2_NULLS", "TEST_3_PRECIOS_INVALIDOS", "TEST_4_FRESHNESS")
PASS, FAIL = "PASS", "FAIL"
PRICE_CEILING = 1_000_000


def flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def pct_text(part, total) -> Column:
    """D12: '12.34%' = round(100.0 * part / total, 2) as text."""
    ratio = F.try_divide(F.lit(100).cast("decimal(4,1)") * col_(part), col_(total))
    return F.concat(F.round(ratio, 2).cast("decimal(9,2)").cast("string"), F.lit("%"))


def unpivot(row: DataFrame, pairs: Sequence[tuple[str, Column]], label: str,
            value: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row -> len(pairs) rows (label, value), preserving ``keep``."""
    structs = [F.struct(F.lit(name).alias(label), v.alias(value)) for name, v in pairs]
    return row.select(*keep, F.inline(F.array(*structs)))


def group_percentiles(df: DataFrame, group: Sequence[str], value: str,
                      qs: dict[str, float], approx: bool = False,
                      accuracy: int = 100_000, stored: bool = False) -> DataFrame:
    """Exact (interpolated between ranks, by distributed selection) or
    approximate percentiles of ``value`` (as double) per group.  ``stored``:
    ``df`` is a table or materialised, and need not be materialised again."""
    if not approx:
        return selection.group_percentiles(df, group, value, qs, stored=stored)
    v = F.col(value).cast("double")
    return df.groupBy(*group).agg(*[F.percentile_approx(v, q, accuracy).alias(name) for name, q in qs.items()])


def _priced(bronze: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a valid price, computed once: the passes after it read them."""
    valid = with_price(bronze, out="precio_num").where(F.col("precio_num") > 0)
    return materialise(valid.select(*columns, "precio_num"))


def _with_limits(valid: DataFrame, approx: bool) -> DataFrame:
    """Each row with the p99 and p01 of its category (null is a category)."""
    stats = group_percentiles(valid, ["categoria"], "precio_num", {"_p99": 0.99, "_p01": 0.01}, approx, stored=True)
    stats = stats.withColumnRenamed("categoria", "_cat")
    stats = stats if approx else small_side(stats)
    return valid.join(stats, F.col("categoria").eqNullSafe(F.col("_cat"))).drop("_cat")


def _outlier_label() -> Column:
    price = F.col("precio_num").cast("double")
    return (F.when(price > F.col("_p99"), F.lit(OUTLIER_HIGH)).when(price < F.col("_p01"), F.lit(OUTLIER_LOW))
            .otherwise(F.lit(PRICE_NORMAL)))


def duplicate_rows(df: DataFrame, keys: Sequence[str], out: str = "dup_rows") -> DataFrame:
    """E5 as an aggregate: rows whose key occurs more than once."""
    g = df.groupBy(*keys).count()
    return g.agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count"))), F.lit(0))
                 .cast("long").alias(out))


# ------------------------------------------------------------------ Q12
def exploration_summary(bronze: DataFrame, extra: bool = False, approx: bool = False) -> DataFrame:
    """Q12: seven quality counts (and %) over rows with a valid price.

    ``extra=True`` adds the two checks the source computes but never
    reports (low outliers, url without http)."""
    valid = _priced(bronze, ["supermercado", "nombre", "categoria", "url", "fecha_extraccion"])
    rows = _with_limits(valid, approx)
    label = _outlier_label()
    url_label = F.when(~F.col("url").like("http%"), F.lit(URL_INVALID)).otherwise(F.lit(URL_VALID))
    flags = {
        "c0": F.col("supermercado").isNull(),
        "c1": F.col("nombre").isNull(),
        "c2": F.col("categoria").isNull(),
        "c3": F.col("url").isNull() | (F.col("url") == ""),
        "c5": label == OUTLIER_HIGH,
        "c6": F.length("nombre") < 3,
        "c7": label == OUTLIER_LOW,
        "c8": url_label == URL_INVALID,
    }
    # One grouped pass over (store, name, day): per-group row counts give the
    # duplicates, per-group flag counts sum up to the row-level checks.
    g = rows.groupBy("supermercado", "nombre", "fecha_extraccion").agg(
        F.count(F.lit(1)).alias("_k"), *[F.count_if(c).alias(name) for name, c in flags.items()])
    one = g.agg(F.sum("_k").alias("n"),
                F.sum(F.when(F.col("_k") > 1, F.col("_k")).otherwise(F.lit(0))).alias("c4"),
                *[F.sum(name).alias(name) for name in flags])
    labels = EXPLORATION_LABELS + (EXTRA_EXPLORATION_LABELS if extra else ())
    pairs = [(name, F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long")) for i, name in enumerate(labels)]
    long = unpivot(one, pairs, "tipo_validacion", "registros_problema", keep=["n"])
    return long.select("tipo_validacion", "registros_problema",
                       pct_text("registros_problema", "n").alias("porcentaje"))


def outlier_labels(bronze: DataFrame, approx: bool = False) -> DataFrame:
    """E6 per row: p99/p01 label by category (row-level form)."""
    rows = _with_limits(_priced(bronze, bronze.columns), approx)
    return rows.withColumn("precio_outlier", _outlier_label()).drop("_p99", "_p01")


def row_flags(bronze: DataFrame, approx: bool = False) -> DataFrame:
    """B14 + E5 + E6 per row (the exploration's validation rows): null
    flags, duplicate multiplicity, p99/p01 label, url label, lengths.

    Bronze is read once; percentiles, multiplicities and the rows themselves
    come from the valid rows materialised then.  The multiplicity is a grouped
    count (combined map-side) joined back on the (null-safe) key, not a window
    over a possibly hot key."""
    keys = ("supermercado", "nombre", "fecha_extraccion")
    valid = _priced(bronze, [*keys, "descripcion", "precio", "categoria", "url", "batch_id"])
    counts = valid.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("duplicados"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    rows = _with_limits(valid, approx).join(counts, same)
    return rows.select(
        "supermercado", "nombre", "descripcion", F.col("precio").alias("precio_raw"), "precio_num",
        "categoria", "url", "fecha_extraccion", "batch_id",
        flag(F.col("supermercado").isNull()).alias("null_supermercado"),
        flag(F.col("nombre").isNull()).alias("null_nombre"),
        flag(F.col("categoria").isNull()).alias("null_categoria"),
        flag(F.col("url").isNull() | (F.col("url") == "")).alias("null_url"),
        "duplicados", _outlier_label().alias("precio_outlier"),
        F.when(~F.col("url").like("http%"), F.lit(URL_INVALID)).otherwise(F.lit(URL_VALID)).alias("url_valida"),
        F.length("nombre").alias("longitud_nombre"), F.length("descripcion").alias("longitud_descripcion"))


# ------------------------------------------------------------------ Q13
def duplicate_keys(silver: DataFrame, keys=("producto_id", "fecha_extraccion")) -> DataFrame:
    """Keys occurring more than once."""
    return (silver.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_duplicados"))
                  .where(F.col("num_duplicados") > 1))


NULL_FIELDS = ("producto_id", "supermercado", "nombre", "categoria", "precio_normalizado",
               "fecha_extraccion")


def null_counts(silver: DataFrame, fields: Sequence[str] = NULL_FIELDS) -> DataFrame:
    """One row per field with its null count, from one scan."""
    m = silver.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(fields)])
    pairs = [(c, F.col(f"_{i}")) for i, c in enumerate(fields)]
    return unpivot(m, pairs, "campo", "registros_nulos")


def price_range(silver: DataFrame, lo=0, hi=PRICE_CEILING, price: str = "precio_normalizado") -> DataFrame:
    """Count, min and max of prices outside (lo, hi]."""
    bad = silver.where((F.col(price) <= lo) | (F.col(price) > hi))
    return bad.agg(F.count(F.lit(1)).alias("precios_invalidos"),
                   F.min(price).alias("precio_minimo"), F.max(price).alias("precio_maximo"))


def id_consistency(silver: DataFrame) -> DataFrame:
    """(name, store) with more than one product id."""
    return (silver.groupBy("nombre", "supermercado")
                  .agg(F.countDistinct("producto_id").alias("num_ids_distintos"))
                  .where(F.col("num_ids_distintos") > 1))


def freshness(silver: DataFrame, as_of, days: int = 2) -> DataFrame:
    """Rows per recent date and their age in days."""
    d = F.col("fecha_extraccion")
    recent = silver.where(d >= F.date_sub(F.lit(as_of), days))
    return recent.groupBy("fecha_extraccion").agg(
        F.count(F.lit(1)).alias("registros"),
        F.datediff(F.lit(as_of), F.col("fecha_extraccion")).alias("dias_antiguedad"))


def store_distribution(silver: DataFrame) -> DataFrame:
    """T6 / D10."""
    return silver.groupBy("supermercado").agg(
        F.count(F.lit(1)).alias("total_productos"),
        F.countDistinct("producto_id").alias("productos_unicos"),
        F.max("fecha_extraccion").alias("ultima_carga"))


def iqr_outliers(silver: DataFrame, as_of, k: float = 1.5, approx: bool = False) -> DataFrame:
    """T7 / D7 + C5: IQR outliers of one day by category (stats joined back
    on category; a null category matches nothing, as the source's JOIN)."""
    day = materialise(silver.where(F.col("fecha_extraccion") == F.lit(as_of))
                      .select("categoria", "nombre", "supermercado", "precio_normalizado"))
    stats = group_percentiles(day, ["categoria"], "precio_normalizado", {"p25": 0.25, "p75": 0.75}, approx, stored=True)
    stats = stats if approx else small_side(stats)
    j = day.join(stats, "categoria").withColumn("iqr", F.col("p75") - F.col("p25"))
    price = F.col("precio_normalizado").cast("double")
    low = price < F.col("p25") - k * F.col("iqr")
    high = price > F.col("p75") + k * F.col("iqr")
    return j.where(low | high).select(
        "categoria", "nombre", "supermercado", "precio_normalizado",
        F.round("p25", 6).alias("p25"), F.round("p75", 6).alias("p75"),
        F.when(low, F.lit(OUTLIER_LOW)).when(high, F.lit(OUTLIER_HIGH)).alias("tipo_outlier"))


def url_format(silver: DataFrame) -> DataFrame:
    """Urls present but not starting with http."""
    return silver.agg(F.count_if(F.col("url").isNotNull() & ~F.col("url").like("http%"))
                      .alias("urls_invalidas"))


# ------------------------------------------------------------------ Q14
def suite(silver: DataFrame, as_of, keys=("producto_id", "fecha_extraccion")) -> DataFrame:
    """Q14 / D13 + G3: four verdict rows from one grouped pass on the key."""
    any_null = None
    for c in NULL_FIELDS:
        any_null = F.col(c).isNull() if any_null is None else any_null | F.col(c).isNull()
    p = F.col("precio_normalizado")
    # One grouped pass on the key (Silver is already partitioned by it after
    # its dedup, so this adds no shuffle there); the key count gives test 1.
    g = silver.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_k"),
        F.count_if(any_null).alias("_t2"),
        F.count_if((p <= 0) | (p > PRICE_CEILING)).alias("_t3"),
        F.count_if(F.col("fecha_extraccion") >= F.date_sub(F.lit(as_of), 1)).alias("_t4"))
    one = g.agg(F.count_if(F.col("_k") > 1).alias("t1"), F.sum("_t2").cast("long").alias("t2"),
                F.sum("_t3").cast("long").alias("t3"), F.sum("_t4").cast("long").alias("t4"))
    one = one.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("t1", "t2", "t3", "t4")])
    checks = [(SUITE_NAMES[0], "t1", F.col("t1") == 0), (SUITE_NAMES[1], "t2", F.col("t2") == 0),
              (SUITE_NAMES[2], "t3", F.col("t3") == 0), (SUITE_NAMES[3], "t4", F.col("t4") > 0)]
    structs = [F.struct(F.lit(name).alias("test_name"),
                        F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
                        F.col(c).alias("issues_found"))
               for name, c, ok in checks]
    return one.select(F.inline(F.array(*structs)))


# ------------------------------------------------------------------ Q15, Q16
def rejection_rate(bronze: DataFrame, silver: DataFrame, as_of) -> DataFrame:
    """Q15: all Bronze rows against Silver rows of one day (as the source
    computes it, dedup counts as rejection).  Counts come from a union of
    the two inputs and one aggregate - no cross join."""
    b = bronze.select(F.lit(1).alias("_b"), F.lit(0).alias("_s"))
    s = silver.where(F.col("fecha_extraccion") == F.lit(as_of)).select(F.lit(0).alias("_b"), F.lit(1).alias("_s"))
    m = b.unionByName(s).agg(F.sum("_b").cast("long").alias("registros_bronze"),
                            F.sum("_s").cast("long").alias("registros_silver"))
    diff = F.col("registros_bronze") - F.col("registros_silver")
    rate = F.round(F.try_divide(F.lit(100).cast("decimal(4,1)") * diff, F.col("registros_bronze")), 2)
    return m.select("registros_bronze", "registros_silver", diff.alias("registros_rechazados"),
                    rate.cast("decimal(9,2)").alias("tasa_rechazo_pct"))


def rejection_rate_by_day(bronze: DataFrame, silver: DataFrame, date_col: str = "fecha_extraccion") -> DataFrame:
    """Q15 per observation day: Bronze rows of the day vs Silver rows kept."""
    b = bronze.select(F.col(date_col), F.lit(1).alias("_b"), F.lit(0).alias("_s"))
    s = silver.select(F.col(date_col), F.lit(0).alias("_b"), F.lit(1).alias("_s"))
    m = b.unionByName(s).groupBy(date_col).agg(F.sum("_b").cast("long").alias("registros_bronze"),
                                               F.sum("_s").cast("long").alias("registros_silver"))
    diff = F.col("registros_bronze") - F.col("registros_silver")
    rate = F.round(F.try_divide(F.lit(100).cast("decimal(4,1)") * diff, F.col("registros_bronze")), 2)
    return m.select(date_col, "registros_bronze", "registros_silver", diff.alias("registros_rechazados"),
                    rate.cast("decimal(9,2)").alias("tasa_rechazo_pct"))
