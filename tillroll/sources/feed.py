"""Raw price observations derived from the order tables.

The reference collects prices from a web shop; our inputs are the driver's
line items.  Each line item becomes one bronze observation (mapping below),
so the pipeline's work grows with ``lineitem``.  The same mapping is written
in SQL in ``tillroll.plans.oracle`` for the independent check.

| bronze column       | derivation                                         |
|---------------------|----------------------------------------------------|
| supermercado        | 'Store_' + supplier nation                         |
| nombre              | part name; null when orderkey % 97 = 0             |
| descripcion, unidad | by part size % 7 (see ``_DESCRIPTIONS``)           |
| precio              | text forms of the extended price (see ``_price``)  |
| categoria           | part type; null when partkey % 50 = 0              |
| url                 | 'http://s/' + partkey                              |
| fecha_extraccion    | first day of the ship month                        |
| ingestion_timestamp | ship timestamp                                     |
| batch_id            | ship month 'yyyy-MM'; load_date = ship day         |

The line keys (orderkey, linenumber, partkey, suppkey) are kept as the
total-order tie-break of the newest-observation rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import ymd_text
from tillroll.schemas import PRICE
from tillroll.sources.tables import read_table

TIE_BREAK = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _descriptions(name: Column, size: Column) -> tuple[Column, Column]:
    kind = size % 7
    s = size.cast("string")
    desc = (F.when(kind == 0, F.concat(name, F.lit(" x kg")))
            .when(kind == 1, F.concat(name, F.lit(" "), (size * 10).cast("string"), F.lit("g")))
            .when(kind == 2, F.concat(name, F.lit(" "), (size * 100).cast("string"), F.lit("ml")))
            .when(kind == 3, F.concat(name, F.lit(" Maple X "), s, F.lit("u")))
            .when(kind == 4, F.concat(name, F.lit(" "), s, F.lit(",5 Lt")))
            .when(kind == 5, F.concat(name, F.lit(" pack")))
            .otherwise(F.concat(name, F.lit(" X unidad"))))
    unit = (F.when(kind == 0, "kg").when(kind == 1, "gr").when(kind == 2, "ml")
            .when(kind == 3, "unidad").when(kind == 4, "ml").when(kind == 5, "medio_ltr")
            .otherwise("unidad"))
    return desc, unit


def _price(orderkey: Column, linenumber: Column, extended: Column) -> Column:
    amount = extended.cast(PRICE)
    base = amount.cast("string")
    comma = F.replace(base, F.lit("."), F.lit(","))
    m = orderkey % 5
    return (F.when(linenumber == 7, F.lit("Sin stock"))
            .when(orderkey % 113 == 0, F.concat(F.lit("$ "), (amount * 25).cast("string")))
            .when(m == 0, F.concat(F.lit("$ "), comma))
            .when(m == 1, F.concat(F.lit("Precio: "), base))
            .when(m == 2, F.concat(F.lit("-"), base))
            .when(m == 3, F.concat(F.lit("$ 1."), comma))
            .otherwise(base))


def price_feed(spark: SparkSession, base: str, with_tie_break: bool = True) -> DataFrame:
    """Bronze-shaped observations, one per line item.

    Two equi-joins on the foreign keys; Catalyst/AQE choose broadcast or
    sort-merge from the measured sizes (no hint: part and supplier grow with
    the data)."""
    li = read_table(spark, base, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    part = read_table(spark, base, "part").select("p_partkey", "p_name", "p_type", "p_size")
    sup = read_table(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(sup, li.l_suppkey == sup.s_suppkey))
    desc, unit = _descriptions(F.col("p_name"), F.col("p_size"))
    cols = [
        F.concat(F.lit("Store_"), F.col("s_nationkey").cast("string")).alias("supermercado"),
        F.when(F.col("l_orderkey") % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_name")).alias("nombre"),
        desc.alias("descripcion"),
        _price(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice")).alias("precio"),
        F.when(F.col("l_partkey") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("categoria"),
        unit.alias("unidad"),
        F.concat(F.lit("http://s/"), F.col("l_partkey").cast("string")).alias("url"),
        F.trunc(F.to_date("l_shipdate"), "month").alias("fecha_extraccion"),
        ymd_text("l_shipdate", parts=2).alias("batch_id"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
        F.to_date("l_shipdate").alias("load_date"),
    ]
    if with_tie_break:
        cols += [F.col(c) for c in TIE_BREAK]
    return j.select(*cols)


def tie_break_order() -> list[Column]:
    """Newest first, then the line keys descending: a total order."""
    return [F.col("ingestion_timestamp").desc()] + [F.col(c).desc() for c in TIE_BREAK]


def audit_events(spark: SparkSession, base: str) -> DataFrame:
    """etl_logs-shaped events: status <- event_type, batch <- user, time <- ts."""
    ev = read_table(spark, base, "events")
    rows = F.floor("value").cast("long")
    return ev.select(
        F.col("ts").alias("event_ts"),
        F.when(F.col("user_id") % 2 == 0, "extract_prices").otherwise("load_silver").alias("pipeline"),
        F.lit("Store").alias("source"),
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "SUCCESS")
         .when(F.col("event_type") == "signup", "STARTED").otherwise(F.upper("event_type")).alias("status"),
        F.col("user_id").cast("string").alias("batch_id"),
        rows.alias("rows_read"),
        F.when(F.col("event_type") == "error", F.lit(0).cast("long")).otherwise(rows).alias("rows_written"),
        F.when(F.col("event_type") == "error", F.lit("HTTPError")).alias("error_type"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.lit(None).cast("string").alias("stacktrace"),
    )


def nested_payloads(spark: SparkSession, base: str) -> DataFrame:
    """``raw_payloads`` in the shop's shape: the price is a JSON document
    inside a string, under attribute names with dots.  By event_id % 10, page 3
    is cut short, page 5 has no contents, page 7's price is no JSON and page 9
    lacks the price field."""
    raw, turn = raw_payloads(spark, base), F.col("event_id") % 10
    number = F.get_json_object("payload", "$.k").cast("long")
    price = (F.when(turn == 7, "sin precio").when(turn == 9, F.to_json(F.struct(number.alias("precio"))))
              .otherwise(F.to_json(F.struct(number.alias("precioLista")))))
    name = F.concat("corte", F.lit(" "), number.cast("string"), F.lit("g"))
    fields = F.struct(F.array(price).alias("sku.dtoPrice"), F.array(name).alias("product.displayName"))
    main = F.array(F.struct(F.struct(fields.alias("attributes")).alias("record")))
    page = F.to_json(F.struct(F.array(F.struct(main.alias("Main"))).alias("contents")))
    page = F.when(turn == 3, F.left(page, F.lit(40))).when(turn == 5, '{"contents":[]}').otherwise(page)
    return raw.withColumn("payload", F.when(F.col("payload").isNotNull(), page))


def raw_payloads(spark: SparkSession, base: str) -> DataFrame:
    """One fetch per event: product <- event type, store <- user % 3,
    payload <- props (missing for error events: the fetch returned nothing),
    fetched at the event time; category / unit sometimes unconfigured."""
    ev = read_table(spark, base, "events")
    return ev.select(
        F.initcap("event_type").alias("corte"),
        F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("string")).otherwise(F.lit("Eventos")).alias("categoria"),
        F.when(F.col("event_id") % 6 == 0, F.lit(None).cast("string")).otherwise(F.lit("unidad")).alias("unidad"),
        F.concat(F.lit("Store_"), (F.col("user_id") % 3).cast("string")).alias("supermercado"),
        F.concat(F.lit("http://s/e/"), F.col("event_id").cast("string")).alias("url"),
        F.when(F.col("event_type") != "error", F.col("props")).alias("payload"),
        F.col("ts").alias("fetched_at"),
        F.col("event_id"),
    )
