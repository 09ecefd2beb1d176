"""Analyses, distinct counts and the containment index on small tables."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.operators import analysis as A
from tillroll.operators.history import history_profile
from tillroll.operators.match import contains_pairs
from tillroll.plans import registry


def day(m, d=1):
    return dt.date(2026, m, d)


def silver(spark, rows):
    """(store, name, category, date, price)"""
    return spark.createDataFrame(
        [(f"{s}|{n}", s, c, n, d, None if p is None else Decimal(str(p))) for s, n, c, d, p in rows],
        "producto_id string, supermercado string, categoria string, nombre string, fecha_extraccion date, precio_normalizado decimal(18,2)")


ROWS = [("A", "ajo", "V", day(1), 10), ("B", "ajo", "V", day(1), 20), ("A", "sal", "G", day(1), 5), ("A", "ajo", "V", day(2), 12),
        ("B", "ajo", "V", day(2), 18), ("A", "sal", "G", day(3), 8), ("A", "ajo", "V", day(4), 12), ("A", "ajo", "V", day(5), 24),
        ("A", "pan", None, day(4), 3), ("A", "pan", None, day(5), 4), ("B", None, "V", day(1), 7)]


def test_store_comparison(spark):
    got = {(r.supermercado, r.fecha_extraccion): tuple(r[2:]) for r in A.store_comparison(silver(spark, ROWS)).select(
        "supermercado", "fecha_extraccion", "productos_comparables", "veces_mas_barato", "indice_relativo_ppm").collect()}
    assert got == {("A", day(1)): (1, 1, 666_666), ("B", day(1)): (1, 0, 1_333_333), ("A", day(2)): (1, 1, 800_000), ("B", day(2)): (1, 0, 1_200_000)}


def test_category_index_chains_matched_products(spark):
    got = {(r.categoria, r.fecha_extraccion): (r.productos_comparables, r.indice) for r in A.category_index(silver(spark, ROWS)).collect()}
    # January to February 30 -> 30; March has no match; April to May 12 -> 24; the product that left does not move the index
    assert got == {("V", day(2)): (2, 100.0), ("V", day(5)): (1, 200.0)}


def test_price_trend(spark):
    rows = [("A", "ajo", "V", day(1, 1 + 3 * k), p) for k, p in enumerate([10, 13, 9, 9, 9, 20])] + [("B", "solo", "V", day(1), 1)]
    got = {r.fecha_extraccion: r for r in A.price_trend(silver(spark, rows), records=3).collect()}
    assert set(got) == {day(1, 1 + 3 * k) for k in range(1, 6)}
    for k in range(1, 6):
        use = range(max(0, k - 2), k + 1)
        xs, ys = [3 * j for j in use], [[10, 13, 9, 9, 9, 20][j] for j in use]
        mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
        slope = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sum((x - mx) ** 2 for x in xs)
        r = got[day(1, 1 + 3 * k)]
        assert math.isclose(r.pendiente_diaria, slope, abs_tol=1e-6) and r.registros == len(xs)
        assert r.tendencia == ("SUBE" if slope > 1e-9 else "BAJA" if slope < -1e-9 else "ESTABLE")


def test_analyses_of_nothing(spark):
    none = silver(spark, [])
    assert [A.store_comparison(none).count(), A.category_index(none).count(), A.price_trend(none).count()] == [0, 0, 0]


@pytest.mark.parametrize("rows", [ROWS, [], [(None, None, None, None, None)], [("A", "x", "c", dt.date(1, 1, 1), 1), ("A", "x", "c", dt.date(9999, 12, 31), 1)]])
def test_history_profile(spark, rows):
    df = silver(spark, rows).withColumn("producto_id", F.when(F.col("nombre").isNotNull(), F.col("producto_id")))
    want = df.agg(F.countDistinct("producto_id").alias("productos_unicos"), F.countDistinct("fecha_extraccion").alias("fechas_distintas"),
                  F.count(F.lit(1)).alias("total_filas"), F.min("fecha_extraccion").alias("primer_registro"),
                  F.max("fecha_extraccion").alias("ultimo_registro")).first()
    assert history_profile(df).first() == want


def test_distinct_counts_expand_no_rows(spark):
    for name in ("q17_history_profile", "q13_t6_store_distribution", "q13_t4_id_consistency"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan, name


def test_needles_are_anchored_on_their_rarest_gram(spark):
    """Half the names begin like the needle; it meets only those that hold its rare end."""
    names = spark.createDataFrame([(f"leche {k}",) for k in range(500)] + [("leche zq",), ("zqx",)], "nombre string")
    needles = spark.createDataFrame([("leche zq",), ("leche w",), ("zq",)], "ingrediente string")
    pairs = contains_pairs(names, "nombre", needles, "ingrediente")
    assert sorted((r._name, r._needle) for r in pairs.collect()) == [("leche zq", "leche zq"), ("leche zq", "zq"), ("zqx", "zq")]
    joined = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in joined and "Cartesian" not in joined
