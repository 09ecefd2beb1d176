"""Ranked lexical search against a brute-force version."""

import math
import random
import re
from collections import Counter

import pytest

from tillroll.llm import dualtree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(items, docs, k):
    split = [(i, Counter(terms(t))) for i, t in docs]
    split = [(i, tf, sum(tf.values())) for i, tf in split if tf]
    n_docs, words = len(split), sum(n for _, _, n in split)
    df = Counter(t for _, tf, _ in split for t in tf)
    out = []
    for item, text in items:
        scored = []
        for i, tf, n in split:
            m = 100 - 50 + (50 * n * n_docs) // words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in set(terms(text)) if t in tf)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(spark, items, docs, **options):
    a = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    b = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, `rank` int, terms string").repartition(5)
    got = dualtree.rank(a, b, **options)
    return sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def texts(seed, n, size=30):
    rng = random.Random(seed)
    words = [f"W{k}x" for k in range(300)] + ["é", "ÉÀ", "naïve", "a1", "I"]
    return [" ".join(rng.choice(words[:10 + 5 * rng.randrange(60)]) + rng.choice(["", ",", "\t-", "　"])
                     for _ in range(rng.randrange(1, size))) for _ in range(n)]


@pytest.mark.parametrize("options", [{"k": 50}, {"k": 3, "node_docs": 16, "leaf_docs": 4}, {"k": 7, "block_terms": 60, "node_docs": 8, "leaf_docs": 8}])
def test_against_brute_force(spark, monkeypatch, options):
    monkeypatch.setattr(dualtree, "_GROUP_ITEMS", 5)
    docs = list(enumerate(texts(1, 400)))
    docs += [(i, docs[7][1]) for i in range(400, 600)] + [(7, docs[7][1])] * 60  # copies, repeated rows
    docs += [(None, docs[7][1]), (None, docs[7][1]), (700, None), (701, ""), (702, " -- "), (703, "w1x " * 300_000), (7, "w2x w3x")]
    items = list(enumerate(texts(2, 40, 12))) + [(100, None), (101, "..."), (102, "unheard of"), (3, docs[7][1]), (3, docs[7][1]), (None, "W1x w2X")]
    got = run(spark, items, docs, **options)
    assert got == brute(items, docs, options["k"])


def test_empty(spark):
    assert run(spark, [], [(1, "a")]) == [] == run(spark, [(1, "a")], []) == run(spark, [(1, "a")], [(1, None), (2, "!")])


def test_pieces():
    text = "Añ-b  C" * 50
    words = [w.decode() for part in dualtree.pieces(text.encode(), 7) for w in part]
    assert words == terms(text)
