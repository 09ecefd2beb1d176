"""Property tests: operators against small pure-Python models."""

import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.price import normalize_price
from tillroll.operators.dedup import latest_per_key
from tillroll.operators.upsert import upsert

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def model_price(text):
    if text is None:
        return None
    s = re.sub(r"[^0-9,.-]", "", text.strip()).replace(",", ".")
    if not re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", s):
        return None
    try:
        d = Decimal(s).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return None
    return d if len(d.as_tuple().digits) <= 18 else None


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789,.-$ aeX", max_size=14)), min_size=1, max_size=40))
def test_normalize_price_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "precio string")
    got = [r[0] for r in df.select(normalize_price("precio")).collect()]
    assert got == [model_price(t) for t in texts]


rows_st = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 2), st.integers(0, 50), st.integers(0, 9)),
                   min_size=1, max_size=30)


@SETTINGS
@given(rows_st)
def test_latest_per_key_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "k int, d int, t int, v int")
    out = latest_per_key(df, ["k", "d"], [F.col("t").desc(), F.col("v").desc()])
    got = sorted(tuple(r) for r in out.collect())
    best = {}
    for k, d, t, v in rows:
        if (k, d) not in best or (t, v) > best[(k, d)][2:]:
            best[(k, d)] = (k, d, t, v)
    assert got == sorted(best.values())


@SETTINGS
@given(st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 3)), st.tuples(st.integers(0, 99), st.sampled_from("abc")), max_size=15),
       st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 3)), st.tuples(st.integers(0, 99), st.sampled_from("xyz")), max_size=15))
def test_upsert_matches_model(spark, target, source):
    base = dt.date(2026, 1, 1)
    schema = "producto_id string, fecha_extraccion date, precio_normalizado int, unidad string"

    def df(d):
        return spark.createDataFrame([(f"p{k}", base + dt.timedelta(days=day), p, u) for (k, day), (p, u) in d.items()],
                                     schema)
    out = upsert(df(target), df(source), update_cols=("precio_normalizado",))
    got = {(r.producto_id, r.fecha_extraccion): (r.precio_normalizado, r.unidad) for r in out.collect()}
    want = {}
    for key, (p, u) in target.items():
        want[key] = (p, u)
    for key, (p, u) in source.items():
        want[key] = (p, want[key][1]) if key in want else (p, u)
    want = {(f"p{k}", base + dt.timedelta(days=d)): v for (k, d), v in want.items()}
    assert got == want
    assert out.count() == len(set(target) | set(source))
