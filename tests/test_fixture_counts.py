"""Sizes the fixture mapping documents for sf0.01 (FIXTURES.md §4)."""

from conftest import SF_CHECK
from pyspark.sql import functions as F

from tillroll.operators.clean import with_price
from tillroll.plans import bronze as B
from tillroll.plans import gold, silver
from tillroll.sources.feed import price_feed


def test_fixture_sizes(spark):
    b = with_price(price_feed(spark, SF_CHECK))
    assert b.count() == 60_000
    assert b.where(F.col("precio_normalizado").isNull()).count() == 18_940
    assert b.where(F.col("precio_normalizado") <= 0).count() == 10_064
    assert silver.silver(spark, SF_CHECK).count() == 26_069
    assert gold.unit_catalogue(spark, SF_CHECK).where(F.col("cantidad_base").isNull()).count() == 3_540
    target, source = B._upsert_inputs(spark, SF_CHECK)
    assert (target.count(), source.count()) == (11_510, 18_327)
    assert B.silver_upsert(spark, SF_CHECK).count() == 26_069
