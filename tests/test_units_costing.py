from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.functions.quantity import base_quantity, measure_class, sale_quantity, unit_price
from tillroll.operators.costing import catalogue, ingredient_costs, recipe_summary
from tillroll.operators.match import best_match, contains_pairs, unmatched

QUANTITY = [
    ("kg", "any", 1000), ("ltr", "any", 1000), ("medio_kg", "any", 500), ("medio_ltr", "x", 500),
    ("unidad", "Huevo Blanco Maple X 30u", 30), ("unidad", "Ajo X unidad", None), ("unidad", "Ajo", 1),
    ("ml", "2250ml", 2250), ("ml", "2,25 Lt", 2250), ("ml", "900 ml", None), ("ml", "Agua", 1),
    ("gr", "Sal Fina CELUSAL 500g", 500), ("ml", "Jugo 1,005 Lt", 1004), ("gr", "sin numero", None),
]


def test_base_quantity_golden(spark):
    df = spark.createDataFrame([(u, d) for u, d, _ in QUANTITY], "unidad string, descripcion string")
    got = [r[0] for r in df.select(base_quantity("unidad", "descripcion")).collect()]
    assert got == [q for _, _, q in QUANTITY]


def test_unit_price_rounds_half_up_and_guards_zero(spark):
    df = spark.createDataFrame([(Decimal("3799.00"), 1000), (Decimal("0.05"), 1000), (Decimal("10.00"), 0),
                                (Decimal("10.00"), None)], "p decimal(18,2), q int")
    got = [r[0] for r in df.select(unit_price("p", "q")).collect()]
    assert got == [Decimal("3.7990"), Decimal("0.0001"), None, None]


def test_measure_class_and_sale_quantity(spark):
    df = spark.createDataFrame([("Harina 1kg",), ("Leche 1 Litro",), ("Sal 500g",), ("Tapa X12 500g",),
                                ("Huevo Maple X 30u",), ("Ajo",)], "nombre string")
    got = df.select(measure_class("nombre"), sale_quantity("nombre", after={"Huevo Maple X 30u": 30, "Ajo": 1})).collect()
    assert [tuple(r) for r in got] == [("peso", 1), ("volumen", 1000), ("unidad", 500), ("unidad", 12),
                                       ("unidad", 30), ("unidad", 1)]


def test_best_match_prefers_exact_then_shorter(spark):
    cat = spark.createDataFrame(
        [("Cebolla de verdeo", "x", 5), ("Cebolla", "y", 7), ("Cebolla Morada", "z", 7), ("Papa", "w", 7)],
        "nombre string, supermercado string, d int")
    rec = spark.createDataFrame([("R", " cebolla ")], "receta string, ingrediente string")
    got = best_match(cat, rec, group=("receta", "ingrediente", "d"))
    assert sorted((r.d, r.nombre, r.match_score) for r in got.collect()) == [(5, "Cebolla de verdeo", 2),
                                                                          (7, "Cebolla", 1)]


@pytest.mark.parametrize("gram", [1, 2, 3, 5])
def test_contains_pairs_equals_brute_force(spark, gram):
    import random
    rnd = random.Random(gram)
    alphabet = "abcde "
    names = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(60)]
    needles = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 5))) for _ in range(25)] + ["AB"]
    ndf = spark.createDataFrame([(n,) for n in names], "nombre string")
    kdf = spark.createDataFrame([(k,) for k in needles], "ingrediente string")
    got = {(r._name, r._needle) for r in contains_pairs(ndf, "nombre", kdf, "ingrediente", gram=gram).collect()}
    want = {(n, k) for n in set(names) for k in set(needles)
            if k.strip().lower() and k.strip().lower() in n.strip().lower()}
    assert got == want


def test_containment_plan_has_no_nested_loop(spark):
    ndf = spark.createDataFrame([("abc",)], "nombre string")
    kdf = spark.createDataFrame([("b",)], "ingrediente string")
    plan = contains_pairs(ndf, "nombre", kdf, "ingrediente")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_cost_example(spark):
    silver = spark.createDataFrame(
        [("Morron rojo", "d", "Verdura", Decimal("3799.00"), "kg", "2026-04-15", "u", "StoreA")],
        "nombre string, descripcion string, categoria string, precio_normalizado decimal(18,2), unidad string, "
        "fecha_extraccion string, url string, supermercado string").withColumn("fecha_extraccion", F.to_date("fecha_extraccion"))
    rec = spark.createDataFrame([("Pizza", "Morron rojo", Decimal("150"), "gramos", 2)],
                                "receta string, ingrediente string, cantidad_necesaria decimal(13,3), "
                                "unidad_receta string, rendimiento_porciones int")
    costs = ingredient_costs(catalogue(silver), rec)
    row = costs.first()
    assert row.precio_unitario == Decimal("3.7990") and row.costo_ingrediente == Decimal("569.85")
    summ = recipe_summary(costs).first()
    assert (summ.costo_total, summ.porciones, summ.costo_por_porcion, summ.comentarios) == (
        Decimal("569.85"), 2, Decimal("284.93"), "Porcion = 1 pizza")


def test_unmatched_lists_missing_ingredients(spark):
    cat = spark.createDataFrame([("Ajo",)], "nombre string")
    rec = spark.createDataFrame([("R", " ajo"), ("R", "Perejil")], "receta string, ingrediente string")
    got = [(r.ingrediente, r.estado) for r in unmatched(rec, cat).collect()]
    assert got == [("Perejil", "SIN MATCH")]
