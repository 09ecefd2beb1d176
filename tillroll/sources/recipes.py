"""The source project's recipe table: 28 rows of 3 recipes.

Fixed values: (recipe, ingredient, quantity, recipe unit, portions), in the
order the source lists them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.schemas import RECIPES
from tillroll.sources.literal import literal_table

REFERENCE_RECIPES = [
    ("Pizza", "Harina Trigo 0000", "500", "gramos", 2),
    ("Pizza", "Condimento Para Pizza", "3", "gramos", 2),
    ("Pizza", "Sal Fina", "10", "gramos", 2),
    ("Pizza", "Pimenton", "2", "gramos", 2),
    ("Pizza", "Orégano", "5", "gramos", 2),
    ("Pizza", "Tomate Perita en lata", "1", "unidades", 2),
    ("Pizza", "Levadura Seca", "1", "unidades", 2),
    ("Pizza", "Aji Molido", "2", "gramos", 2),
    ("Pizza", "Ajo", "0.167", "unidades", 2),
    ("Pizza", "Queso Mozzarella", "600", "gramos", 2),
    ("Empanadas", "Picada Desgrasada", "1000", "gramos", 3),
    ("Empanadas", "Tapa Para Empanadas X12", "3", "unidades", 3),
    ("Empanadas", "Cebolla", "200", "gramos", 3),
    ("Empanadas", "Puerro", "2", "unidades", 3),
    ("Empanadas", "Cebolla de verdeo", "2", "unidades", 3),
    ("Empanadas", "Zanahoria", "150", "gramos", 3),
    ("Empanadas", "Morron rojo", "250", "gramos", 3),
    ("Empanadas", "Sal Fina", "50", "gramos", 3),
    ("Empanadas", "Condimento Para Empanadas", "5", "gramos", 3),
    ("Empanadas", "Aceitunas Verdes Descarozadas", "300", "unidades", 3),
    ("Empanadas", "Maple Huevo", "5", "unidades", 3),
    ("Milanesas", "Bola de Lomo", "1000", "gramos", 1),
    ("Milanesas", "Sal Fina", "50", "gramos", 1),
    ("Milanesas", "Maple Huevo", "5", "unidades", 1),
    ("Milanesas", "Pan Rallado", "500", "gramos", 1),
    ("Milanesas", "Perejil", "1", "unidades", 1),
    ("Milanesas", "Ajo", "1", "unidades", 1),
    ("Milanesas", "Harina Trigo 0000", "100", "gramos", 1),
]


def reference_recipes(spark: SparkSession) -> DataFrame:
    return literal_table(spark, REFERENCE_RECIPES, RECIPES)
