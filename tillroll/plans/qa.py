"""Q12-Q16: exploration report, DQ tests, suite, rejection rate, rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import quality as Q
from tillroll.operators.clean import rejected, with_price
from tillroll.plans import params as P
from tillroll.plans.silver import silver
from tillroll.sources.feed import price_feed


def bronze_rows(spark: SparkSession, base: str) -> DataFrame:
    return price_feed(spark, base, with_tie_break=False)


def exploration(spark, base):
    return Q.exploration_summary(bronze_rows(spark, base)).orderBy(
        F.col("registros_problema").desc(), "tipo_validacion")


def row_flags(spark, base):
    return Q.row_flags(bronze_rows(spark, base))


def exploration_extra(spark, base):
    return Q.exploration_summary(bronze_rows(spark, base), extra=True)


def faulty_history(spark: SparkSession, base: str) -> DataFrame:
    """Silver as a careless load would leave it, by part number: repeated keys
    (11), ids that change in March (7), lost names (13), urls without scheme (17)."""
    s, part = silver(spark, base), F.substring("url", 10, 20).cast("long")
    renamed = (part % 7 == 0) & (F.month("fecha_extraccion") == 3)
    return (s.withColumn("producto_id", F.when(renamed, F.concat("producto_id", F.lit("_v2"))).otherwise(F.col("producto_id")))
             .withColumn("nombre", F.when(part % 13 != 0, F.col("nombre")))
             .withColumn("veces", F.explode(F.sequence(F.lit(1), F.when(part % 11 == 0, 2).otherwise(1)))).drop("veces")
             .withColumn("url", F.when(part % 17 == 0, F.substring("url", 8, 30)).otherwise(F.col("url"))))


def t1_faulty(spark, base):
    return Q.duplicate_keys(faulty_history(spark, base))


def t2_faulty(spark, base):
    return Q.null_counts(faulty_history(spark, base))


def t4_faulty(spark, base):
    return Q.id_consistency(faulty_history(spark, base))


def t8_faulty(spark, base):
    return Q.url_format(faulty_history(spark, base))


def suite_faulty(spark, base):
    return Q.suite(faulty_history(spark, base), P.LATEST_DAY)


def t1_duplicates(spark, base):
    return Q.duplicate_keys(silver(spark, base))


def t2_nulls(spark, base):
    return Q.null_counts(silver(spark, base))


def t3_price_range(spark, base):
    return Q.price_range(silver(spark, base))


def t4_id_consistency(spark, base):
    return Q.id_consistency(silver(spark, base))


def t5_freshness(spark, base):
    return Q.freshness(silver(spark, base), P.LATEST_DAY).orderBy(F.col("fecha_extraccion").desc())


def t6_stores(spark, base):
    return Q.store_distribution(silver(spark, base)).orderBy(F.col("total_productos").desc(), "supermercado")


def t7_iqr(spark, base):
    return Q.iqr_outliers(silver(spark, base), P.AS_OF).orderBy("categoria", "tipo_outlier")


def t8_urls(spark, base):
    return Q.url_format(silver(spark, base))


def dq_suite(spark, base):
    return Q.suite(silver(spark, base), P.LATEST_DAY)


def rejection(spark, base):
    b = price_feed(spark, base)
    return Q.rejection_rate(b, silver(spark, base), P.AS_OF)


def rejection_by_day(spark, base):
    return Q.rejection_rate_by_day(bronze_rows(spark, base), silver(spark, base))


def rejected_rows(spark, base):
    """Q16: every rejected row (the troubleshooting LIMIT is a display
    option of ``rejected``, not applied here)."""
    return rejected(with_price(bronze_rows(spark, base)), date_col="fecha_extraccion").drop("precio_normalizado")
