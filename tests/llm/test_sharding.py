"""Rendezvous sharding against a brute-force version."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.llm import rendezvous


def brute_shard(key, weights):
    def claim(s):
        text = f"shard:{s}" + ("" if key is None else f":{key}")
        return -weights[s] / math.log((int(hashlib.md5(text.encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48)

    return max((s for s, w in enumerate(weights) if w > 0), key=lambda s: (claim(s), -s))


def brute_layout(rows, weights):
    out, of = [], {}
    for i, text in rows:
        raw = (text or "").encode()
        of.setdefault(brute_shard(i, weights), []).append((i is not None, i, len(raw) + 1, zlib.crc32(raw)))
    for shard, members in of.items():
        members.sort(key=lambda m: (m[0], m[1] or 0, m[2], m[3]))
        out += [(i, size, crc, shard, brute_shard(i, [*weights, 1.0]), slot) for slot, (_, i, size, crc) in enumerate(members)]
    return sorted(out, key=str)


ROWS = ([(i, f"text é {i % 7}" * (i % 40)) for i in range(400)] + [(5, "hot")] * 300  # one id, one text: a hot row
        + [(None, None), (None, "x"), (7, None), (8, ""), (9, "long " * 60_000)])


@pytest.mark.parametrize("weights", [[1.0] * 8, [1.0, 0.0, 4.0], [2.0]])
def test_layout(spark, weights):
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in ROWS], "doc_id long, text string, slot int, shard string").repartition(5)
    got = rendezvous.layout(df, weights)
    assert sorted((tuple(r) for r in got.select("doc_id", "size", "text_crc32", "shard", "grown_shard", "slot").collect()),
                  key=str) == brute_layout(ROWS, weights)
    assert rendezvous.layout(df.where("false"), weights).count() == 0


def test_shares_follow_weights_and_growth_moves_few(spark):
    keys = spark.range(40_000)
    found = keys.select(rendezvous.shard_of(F.col("id"), [1.0, 2.0, 5.0]).alias("a"),
                        rendezvous.grown_shard_of(F.col("id"), [1.0, 2.0, 5.0], added=2.0).alias("b")).collect()
    share = Counter(r["a"] for r in found)
    for shard, part in enumerate((0.125, 0.25, 0.625)):
        assert abs(share[shard] / 40_000 - part) < 0.01
    assert all(r["b"] in (r["a"], 3) for r in found)
    assert abs(sum(r["b"] == 3 for r in found) / 40_000 - 0.2) < 0.01
    with pytest.raises(ValueError):
        rendezvous.shard_of(F.col("id"), [0.0])


def test_written_shards(spark, scratch):
    df = spark.createDataFrame([(i, t, "kept") for i, t in ROWS], "doc_id long, text string, shard string")
    rendezvous.write_shards(df, f"{scratch}/shards", [1.0] * 4)
    back = spark.read.parquet(f"{scratch}/shards")
    assert sorted(((r["doc_id"], r["text"], r["shard"]) for r in back.collect()), key=str) == \
        sorted(((i, t, brute_shard(i, [1.0] * 4)) for i, t in ROWS), key=str)
