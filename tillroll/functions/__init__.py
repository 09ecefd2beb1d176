"""Column expressions (pure ``Column -> Column`` builders, all JVM-side)."""

from tillroll.functions.price import normalize_price, surrogate_key
from tillroll.functions.quantity import (base_quantity, measure_class, sale_quantity,
                                         sale_unit, unit_price, first_integer)
from tillroll.functions.text import norm_text, half_up_div

__all__ = ["normalize_price", "surrogate_key", "base_quantity", "measure_class",
           "sale_quantity", "sale_unit", "unit_price", "first_integer", "norm_text",
           "half_up_div"]
