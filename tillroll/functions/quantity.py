"""Package quantity in base units and the unit price.

``base_quantity`` turns (unit, description) into grams / millilitres /
pieces; ``unit_price`` divides the price by it.  ``measure_class``,
``sale_unit`` and ``sale_quantity`` are the name-driven variants (a product
name decides weight / volume / piece) with explicit name overrides.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import col_, half_up_div
from tillroll.schemas import UNIT_PRICE

# Unit codes and their base quantity, patterns of the rules.
FULL_UNITS = ("kg", "ltr")          # -> 1000
HALF_UNITS = ("medio_ltr", "medio_kg")  # -> 500
PIECE_UNIT = "unidad"
ML_UNIT = "ml"
PACK_PATTERNS = ("%X %u%", "%x %u%")    # "Maple X 30u"
PACK_COUNT_RE = r"[Xx] (\d+)u"
ML_LIKE = "%ml%"
ML_COUNT_RE = r"(\d+)ml"
LITRE_LIKES = ("%Lt%", "%L %", "% L")
LITRE_NUMBER_RE = r"([0-9]+[.,]?[0-9]*)"
FIRST_INT_RE = r"(\d+)"


def _extract_int(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("int")


def first_integer(text) -> Column:
    """First run of digits in the trimmed text as INT, null when none."""
    return _extract_int(F.trim(col_(text)), FIRST_INT_RE, 0)


def base_quantity(unit="unidad", description="descripcion") -> Column:
    """Quantity of one package in base units (g, ml or pieces) as INT."""
    u, d = col_(unit), col_(description)
    td = F.trim(d)
    litres = F.replace(F.nullif(F.regexp_extract(td, LITRE_NUMBER_RE, 1), F.lit("")),
                       F.lit(","), F.lit("."))
    ml = (F.when(d.like(ML_LIKE), _extract_int(td, ML_COUNT_RE, 1))
          .when(d.like(LITRE_LIKES[0]) | d.like(LITRE_LIKES[1]) | d.like(LITRE_LIKES[2]),
                (litres.try_cast("double") * 1000).try_cast("int"))
          .otherwise(F.lit(1)))
    return (F.when(u.isin(*FULL_UNITS), F.lit(1000))
            .when(u.isin(*HALF_UNITS), F.lit(500))
            .when((u == PIECE_UNIT) & (d.like(PACK_PATTERNS[0]) | d.like(PACK_PATTERNS[1])),
                  _extract_int(td, PACK_COUNT_RE, 1))
            .when(u == PIECE_UNIT, F.lit(1))
            .when(u == ML_UNIT, ml)
            .otherwise(_extract_int(td, FIRST_INT_RE, 0))
            .cast("int"))


def unit_price(price="precio_normalizado", quantity="cantidad_base", scale: int = 4) -> Column:
    """round(price / quantity, scale); null for a null or zero quantity."""
    return half_up_div(price, quantity, scale).cast(UNIT_PRICE)


def _lookup(name: Column, mapping: Mapping[str, object]):
    expr = None
    for key, value in mapping.items():
        cond = name == F.lit(key)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr


def measure_class(name="nombre", weight_names=(), labels=("peso", "volumen", "unidad")) -> Column:
    """peso / volumen / unidad from the product name."""
    n = col_(name)
    weight = n.like("%kg%") | n.like("%Grm%")
    if weight_names:
        weight = weight | n.isin(*weight_names)
    return (F.when(weight, F.lit(labels[0]))
            .when(n.like("%Litro%") | n.like("%ml%"), F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def sale_unit(name="nombre", weight_names=()) -> Column:
    """gramos / ml / unidades from the product name."""
    return measure_class(name, weight_names, labels=("gramos", "ml", "unidades"))


def sale_quantity(name="nombre", before: Mapping[str, int] | None = None,
                  after: Mapping[str, int] | None = None,
                  gram_likes=("%Grm%", "%g%"), litre_like="%Litro%") -> Column:
    """Name-driven package size (B12): ``before`` overrides, then grams read
    from a name that looks like a weight, then ``after`` overrides, then a
    litre name -> 1000, else null."""
    n = col_(name)
    chain = None

    def add(cond, value):
        nonlocal chain
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)

    for key, value in (before or {}).items():
        add(n == F.lit(key), F.lit(value))
    grams = None
    for pattern in gram_likes:
        grams = n.like(pattern) if grams is None else grams | n.like(pattern)
    add(grams, first_integer(n))
    for key, value in (after or {}).items():
        add(n == F.lit(key), F.lit(value))
    add(n.like(litre_like), F.lit(1000))
    return chain.otherwise(F.lit(None)).cast("int")
