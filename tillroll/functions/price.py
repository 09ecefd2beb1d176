"""B1/B2: price text -> DECIMAL(18,2) and the product surrogate key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import col_
from tillroll.schemas import PRICE

# Runs of characters dropped from a price text, and the decimal comma.
PRICE_DROP_PATTERN = "[^0-9,.-]+"
DECIMAL_COMMA = ","


def normalize_price(price_text, thousands: str | None = None) -> Column:
    """Trim, drop everything but digits ``, . -``, turn the comma into a dot
    and try-cast to DECIMAL(18,2) (unparsable text gives null).

    ``thousands='.'`` reads ``21.999,00`` as 21999.00 (dots are thousands
    separators); the default keeps the plain rule, where that text is null.
    """
    cleaned = F.regexp_replace(F.trim(col_(price_text)), PRICE_DROP_PATTERN, "")
    if thousands is not None:
        cleaned = F.regexp_replace(cleaned, "\\" + thousands, "")
    return F.translate(cleaned, DECIMAL_COMMA, ".").try_cast(PRICE)


def surrogate_key(*cols, sep: str = "|") -> Column:
    """md5 of the columns joined by ``sep``; null when any part is null."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(col_(c))
    return F.md5(F.concat(*parts))
