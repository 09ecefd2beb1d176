"""Hard-negative mining against a brute-force version."""

import math

import numpy as np
import pytest

from tillroll.llm import angular

LEAST, MOST = -(1 << 63), (1 << 63) - 1


def brute(rows, positives=5, negatives=10, low=30, high=90):
    good = [(n, i, label, [math.floor(256 * x) for x in v]) for n, (i, v, label) in enumerate(rows)
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, label, v in good:
        if i % 10:
            continue
        scored = [(max(LEAST, min(MOST, sum(a * b for a, b in zip(v, w, strict=False)))), j, m, k) for k, j, m, w in good if k != n]
        near = sorted((-s, j, k) for s, j, m, k in scored if m == label)[:positives]
        for s, j, _ in near:
            inside = sorted((-t, q) for t, q, m, _ in scored if m != label and low * -s <= 100 * t <= high * -s)
            out += [(i, j, r + 1, q, -s, -t) for r, (t, q) in enumerate(inside[:negatives])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows],
                               "vec_id long, embedding array<double>, label int, score string, `rank` int").repartition(4)
    got = angular.mine(df, df["vec_id"] % 10 == 0, **options)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect())


@pytest.mark.parametrize("options", [{}, {"rows_per_block": 16, "chunk_bytes": 2000, "references": 2},
                                     {"references": 1, "positives": 2, "negatives": 3}])
def test_against_brute_force(spark, options):
    rng = np.random.default_rng(4)
    centre = rng.normal(0, 1, (4, 6))
    rows = [(i, [float(x) for x in centre[i % 4] + rng.normal(0, 0.7, 6)], int(rng.integers(0, 4))) for i in range(240)]
    same = [0.5, 0.25, -0.125, 1.0, 0.0, 0.5]
    rows += [(i, same, i % 3) for i in range(240, 330)] + [(330, same, 1)] * 4  # a common vector, repeated rows
    rows += [(400, [0.0] * 6, 1), (410, [], 2), (420, [1.0, 2.0], 0), (430, [-x for x in same], 1), (440, [1.0] * 8, 3),
             (450, None, 1), (460, [1.0, None], 1), (470, [float("nan")] * 6, 1), (480, [float("inf")] * 6, 1),
             (490, same, None), (None, same, 1), (500, same, 77), (-10, same, 2)]
    few = {k: v for k, v in options.items() if k in ("positives", "negatives")}
    got = run(spark, rows, **options)
    assert got and got == brute(rows, **few)


@pytest.mark.parametrize("power", [4, 8, 12, 30])
def test_large_values(spark, power):
    rng = np.random.default_rng(power)
    rows = [(i, [float(x) for x in rng.normal(1, 1, 3) * 10.0 ** rng.uniform(0, power, 3)], i % 2) for i in range(50)]
    assert run(spark, rows, rows_per_block=8) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == [] == run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == run(spark, [(10, None, 1)])


def test_intervals_hold(spark):
    rng = np.random.default_rng(5)
    v = np.floor(256 * rng.normal(0, 1, (200, 5)) * 10 ** rng.uniform(-3, 3, (200, 1)))
    norms, angles = angular.angles_to(v, angular.far_apart(v, 3))
    lower, upper = angular.score_interval(norms, angles, (norms, norms), (angles, angles))
    assert (lower <= v @ v.T).all() and (v @ v.T <= upper).all()
    whole = angular.score_interval(norms, angles, (norms.min(keepdims=True), norms.max(keepdims=True)),
                                   (angles.min(axis=0, keepdims=True), angles.max(axis=0, keepdims=True)))
    assert (whole[0][:, 0] <= (v @ v.T).min(axis=1)).all() and (whole[1][:, 0] >= (v @ v.T).max(axis=1)).all()
