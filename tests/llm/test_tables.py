"""Vector search and chat formatting against brute force; the registered
queries and the pipeline."""

import math
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tillroll.llm import chat, vafile
from tillroll.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


def brute_top(rows, k):
    good = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in sorted(set(good)):
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in good if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("cells,k", [(32, 5), (2, 3), (1, 20)])
def test_vector_search(spark, cells, k):
    rng = np.random.default_rng(1)
    same = [0.5, -0.25, 0.125]
    rows = [(i, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(150)]
    rows += [(i, same) for i in range(150, 260)] + [(260, same), (260, same)]  # a common vector, repeated rows
    rows += [(7, [2.0, 2.0, 2.0])] * 3 + [(5, same)] * 50
    rows += [(300, None), (320, [1.0, None, 2.0]), (340, [float("nan"), 1.0, 1.0]), (341, [float("inf"), 1.0, 1.0]),
             (360, []), (361, [2.0]), (380, [0.0, 0.0, 0.0]), (None, same), (400, [9.0, 9.0, 9.0, 9.0]), (7, same)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                               "vec_id long, embedding array<float>, score string, `rank` int").repartition(4)
    got = vafile.top_k(df, df["vec_id"] % 20 == 0, k=k, cells=cells, rows_per_block=40, queries_per_block=7)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == brute_top(rows, k)
    assert vafile.top_k(df.where("false"), df["vec_id"] % 20 == 0).count() == 0
    assert vafile.top_k(df, df["vec_id"] < 0).count() == 0


def test_vector_search_of_large_values(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1, 1]) * 10 ** rng.uniform(-3, 6) for _ in range(5)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vafile.top_k(df, df["vec_id"] % 20 == 0, k=4, rows_per_block=16)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 4)


def test_cells_hold_their_values_and_stay_narrow_beside_far_ones():
    rng = np.random.default_rng(4)
    v = rng.integers(-60, 60, (5000, 3))
    v[7] = [10 ** 15, -10 ** 15, 0]
    v[:, 2] = 5
    borders = np.sort(np.quantile(v, np.linspace(0, 1, 257), axis=0, method="lower").T, axis=1)
    grid = vafile.Cells(borders.astype(float))
    middle, half = grid.around(grid.code(v))
    assert (np.abs(v - middle) <= half).all() and (half[:, 2] == 0).all()
    assert np.mean(half[:, :2] <= 2) > 0.95


@pytest.mark.parametrize("far", [0.0, 1e9])
def test_vector_search_beside_a_far_vector(spark, far):
    """Same rows as brute force where one vector lies far off the others and
    blocks are much smaller than the table."""
    rng = np.random.default_rng(int(far) % 97)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 6)]) for i in range(300)]
    rows[11] = (11, [far, -far, far, 0.0, 1.0, -1.0])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vafile.top_k(df, df["vec_id"] % 20 == 0, k=6, rows_per_block=32, queries_per_block=4)
    ints = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64)
    want = []
    for q in range(0, 300, 20):
        scores = ints @ ints[q]
        near = sorted((-int(s), i) for i, s in enumerate(scores) if i != q)[:6]
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(near, 1)]
    assert sorted(map(tuple, got.collect())) == want


def test_vector_search_counts_every_row_and_finite_component(spark):
    for rows in ([(20, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (3, [0.5, 0.5])],
                 [(20, [1 / 64, 0.0]), (2, [1e17, 0.0]), (3, [-1e17, 4.0]), (4, [0.0, 1e17])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = vafile.top_k(df, df["vec_id"] % 20 == 0, k=5)
        assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 5)


def render(turns, me):
    text, mask = "", []
    for _, name, body in turns:
        text += "<|assistant|>\n" if name == me else "<|system|>\n" if name == "system" else f"<|user:{name}|>\n"
        if name == me:
            mask.append((len(text), len(text) + len(body) + len("<|end|>\n")))
        text += body + "<|end|>\n"
    return text, mask


def test_chat_rotation(spark):
    rows = [(1, 0, "system", "be nice"), (1, 1, "Ann", "hi é😀"), (1, 2, "Bob", None), (1, 3, None, "<|end|> x"), (1, 3, None, "<|end|> x"),
            (1, None, "Ann", "first"), (2, 5, "", "alone"), (3, 0, "system", "only"), (None, 0, "user", "lost"),
            (4, 0, "user", "a"), (4, 3, "assistant", "b"), (4, 4, "user", "c"), (4, 9, "user", "d"),
            (5, None, "a", "yes"), (5, None, "b", "no"), (5, None, "a", "yes")]  # turns without numbers, one of them twice
    rows += [(6, 1 if k % 2 else None, "pq"[k % 2], f"hot {k % 3}") for k in range(41)]  # equal and null numbers beyond a part
    df = spark.createDataFrame([(*r, "m", 3) for r in rows], "conv_id long, turn long, role string, text string, mask string, part int")
    got = {(r["conv_id"], r["perspective"], r["part"]): (r["text"], [(m["start"], m["end"]) for m in r["mask"]], r["n_turns"])
           for r in chat.rotate(df, part_turns=4).collect()}
    want = {}
    for conv in (1, 2, 4, 5, 6):
        turns = sorted((-1 if t is None else t, n or "unknown", (x or "").replace("<|", "< |")) for c, t, n, x in rows if c == conv)
        for me in {n for _, n, _ in turns} - {"system"}:
            for part in range(-(-len(turns) // 4)):
                own = turns[4 * part:4 * part + 4]
                want[conv, me, part] = (*render(own, me), len(own))
    assert got == want
    assert chat.rotate(df.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query(spark, name):
    out = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in out.select(sorted(out.columns)).collect()]
    if name not in ORACLE_SQL:
        assert rows
        return
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    sql = db.sql(ORACLE_SQL[name])
    want = db.sql(f"SELECT {', '.join(f'{c}' for c in sorted(sql.columns))} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(sql.columns) == sorted(out.columns)
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_pipeline_against_brute_force(spark):
    """Stage by stage: what the operators decide (each tested on its own) takes effect."""
    import test_documents as brute  # same folder

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, SMALL)
    assert kept.columns == docs.columns
    left = {r["doc_id"]: r for r in kept.collect()}
    assert 0 < len(left) <= docs.count()
    best = {}
    for i, r in left.items():
        best[r["text"] or ""] = max(i, best.get(r["text"] or "", i))
    left = {i: left[i] for i in best.values()}
    exact = corpus_pipeline.exact_stage(spark, kept, SMALL)
    assert {r["doc_id"] for r in exact.collect()} == set(left)
    fps = {i: brute.brute_fingerprint(r["text"]) for i, r in left.items()}
    root = brute.brute_components(set(fps.values()), 2)
    first = {}
    for i in sorted(left):
        first.setdefault(root[fps[i]], i)
    near = corpus_pipeline.simhash_stage(spark, exact, SMALL)
    assert {r["doc_id"] for r in near.collect()} == set(first.values())
    mixed = corpus_pipeline.mixing_stage(spark, near, SMALL)
    assert mixed.columns == docs.columns
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r["doc_id"] for r in whole) == sorted(r["doc_id"] for r in mixed.collect())
    from tokenizers import Tokenizer

    from tillroll.llm.queries import TOKENIZER
    lib = Tokenizer.from_file(TOKENIZER)
    for r in whole:
        ids = lib.encode(left[r["doc_id"]]["text"], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], dtype="<u4").tolist() == ids and r["n_tokens"] == len(ids)
