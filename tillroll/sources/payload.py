"""A4: flatten raw JSON payloads (one row per fetched page) into fields.

Everything runs in SQL functions on the executors; a field that holds a JSON
document as a string (double encoding) is parsed a second time.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.text import col_

# Paths of the shop payload (attribute keys contain dots).
SHOP_ATTRIBUTES = "$.contents[0].Main[0].record.attributes"
SHOP_PRICE_PATH = SHOP_ATTRIBUTES + "['sku.dtoPrice'][0]"
SHOP_PRICE_FIELD = "$.precioLista"
BAD_JSON, NO_FIELD = "JSONDecodeError", "KeyError"
SHOP_NAME_PATH = SHOP_ATTRIBUTES + "['product.displayName'][0]"


def json_field(payload, path: str, inner_path: str | None = None) -> Column:
    """Value at ``path`` as text; with ``inner_path`` the value is itself a
    JSON document and the inner field is returned.  Null when absent or
    when the payload is not JSON."""
    value = F.get_json_object(col_(payload), path)
    return F.get_json_object(value, inner_path) if inner_path else value


def parsed_once(df: DataFrame, payload: str, path: str, inner_path: str | None = None, fields: Mapping[str, str] | None = None,
                value: str = "precio", fault: str = "_fault") -> DataFrame:
    """A4 + A5: ``df`` with the text at ``path`` (at ``inner_path`` of the JSON
    document there) as ``value``, those of ``fields`` (name -> path), and in
    ``fault`` why no value is found, as struct (error_type, error_message);
    null where it is, and where nothing was fetched.

    The page becomes a Variant once, and all its paths and faults are read from
    that; a generator after each parse keeps the optimizer from copying it into
    every expression that uses it."""
    page = F.struct(F.try_parse_json(payload).alias("doc"))
    out = df.select("*", F.explode(F.array(page)).alias("_page"))
    doc = F.col("_page")["doc"]
    text = F.try_variant_get(doc, path, "string")
    if inner_path:
        # one path of the inner document is wanted, as it is written (a Variant would rewrite 1.0 as 1);
        # it is looked at again only where the path is missing
        found = F.get_json_object(text, inner_path)
        inner = F.struct(text.alias("text"), found.alias("found"))
        out = out.select("*", F.explode(F.array(inner)).alias("_inner"))
        text, found = F.col("_inner")["text"], F.col("_inner")["found"]
    else:
        found = text

    def because(kind, message):
        return F.struct(F.lit(kind).alias("error_type"), F.lit(message).alias("error_message"))

    why = F.when(F.coalesce(F.trim(F.col(payload)), F.lit("")) == "", None)
    why = why.when(found.isNotNull(), None)
    why = why.when(doc.isNull(), because(BAD_JSON, "payload")).when(text.isNull(), because(NO_FIELD, path))
    if inner_path:
        why = (why.when(F.try_parse_json(text).isNull(), because(BAD_JSON, path))
               .otherwise(because(NO_FIELD, f"{path} {inner_path}")))
    more = {name: F.try_variant_get(doc, p, "string") for name, p in (fields or {}).items()}
    out = out.withColumns({value: found, fault: why, **more})
    return out.drop("_page", "_inner")


def parse_shop(raw: DataFrame) -> DataFrame:
    """Price, name and fault of the shop's pages."""
    return parsed_once(raw, "payload", SHOP_PRICE_PATH, SHOP_PRICE_FIELD, {"descripcion": SHOP_NAME_PATH})
