"""Registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (angular, bpe, chat, dualtree, exact_dedup, license_scan, mixing, pii, quality, rendezvous, secret_scan,
                          simhash, vafile)
from tillroll.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.allocate(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("row.doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (~quality.learnable(F.col("doc_id"))).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.coded_digests(read(spark, sf_dir, "documents"), TOKENIZER)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.scan(read(spark, sf_dir, "documents")))


def op8_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.rotate(read(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return rendered.withColumn("mask", F.array_join(spans, ","))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.scan(read(spark, sf_dir, "documents")))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(read(spark, sf_dir, "documents"), shingle=3, budget=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dualtree.rank(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return angular.mine(rows, F.col("vec_id") % 100 == 0)


def op13_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = rendezvous.layout(read(spark, sf_dir, "documents"), weights=[1.0] * 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_source_mixing": op2_source_mixing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_secret_scan": op7_secret_scan,
    "op8_chat_rotation": op8_chat_rotation,
    "op9_pii": op9_pii,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_rendezvous_sharding": op13_rendezvous_sharding,
}

#: DuckDB SQL of the operators that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op2_source_mixing": r"""
        WITH docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5)::DOUBLE
                   / 281474976710656::DOUBLE AS u
            FROM documents),
        placed AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
            FROM docs GROUP BY source),
        weighed AS (
            SELECT *, 2.0::DOUBLE * source_size AS cap,
                   CASE (place - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END::DOUBLE AS weight
            FROM placed),
        levels AS (
            SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT
                       - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY cap / weight, place
                                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM weighed),
        aims AS (
            SELECT source, source_size,
                   CASE WHEN cap > weight * level THEN weight * first(level) OVER (
                            PARTITION BY cap > weight * level ORDER BY cap / weight, place)
                        ELSE cap END AS target
            FROM levels),
        plans AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
            FROM aims),
        ordered AS (
            SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, target - whole * source_size AS rest,
                   coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY u / (1 - u) / size NULLS LAST,
                                              coalesce(doc_id::VARCHAR, ''), size
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS run
            FROM docs d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, source_size, target,
               size * (whole + (rest > 0 AND 2 * run + size <= 2 * rest)::BIGINT) AS taken
        FROM ordered
    """,
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_exact_top_k": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
            FROM pairs)
        SELECT * FROM ranked WHERE rank <= 20
    """,
    "op8_chat_rotation": """
        WITH said AS (
            SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS name, replace(coalesce(text, ''), '<|', '< |') AS body
            FROM conversations WHERE conv_id IS NOT NULL),
        turns AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name, body) - 1 AS place, place // 4096 AS part
            FROM said),
        people AS (SELECT DISTINCT conv_id, name AS perspective FROM turns WHERE name <> 'system'),
        lines AS (
            SELECT t.*, perspective, name = perspective AS own,
                   CASE WHEN name = perspective THEN '<|assistant|>' WHEN name = 'system' THEN '<|system|>'
                        ELSE '<|user:' || replace(name, '<|', '< |') || '|>' END || chr(10) AS head,
                   body || '<|end|>' || chr(10) AS tail
            FROM turns t JOIN people USING (conv_id)),
        placed AS (
            SELECT *, sum(length(head) + length(tail)) OVER (
                       PARTITION BY conv_id, perspective, part ORDER BY place
                       ROWS UNBOUNDED PRECEDING) AS stop
            FROM lines)
        SELECT conv_id, perspective, part, count(*) AS n_turns,
               string_agg(head || tail, '' ORDER BY stop) AS text,
               coalesce(string_agg((stop - length(tail))::VARCHAR || ':' || stop::VARCHAR, ',' ORDER BY stop)
                        FILTER (own), '') AS mask
        FROM placed GROUP BY conv_id, perspective, part
    """,
    "op11_ranked_search": r"""
        WITH asked AS (
            SELECT row_number() OVER () AS place, item_id, text FROM benchmark),
        wanted AS (
            SELECT DISTINCT place, item_id, unnest(regexp_extract_all(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM asked),
        docs AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL),
        sized AS (SELECT row, doc_id, terms, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
        whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS words FROM sized),
        postings AS (
            SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
            FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM sized)
            WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM postings, whole GROUP BY term, n_docs),
        scored AS (
            SELECT place, item_id, row, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // words))))::BIGINT AS score
            FROM wanted JOIN postings USING (term) JOIN weights USING (term), whole
            GROUP BY place, item_id, row, doc_id),
        ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY place ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank,
                   doc_id, score
            FROM scored WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 50
    """,
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT row_number() OVER () AS place, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.place, a.vec_id AS anchor_id, b.place AS other, b.vec_id, a.label = b.label AS same,
                   coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.place <> b.place),
        near AS (
            SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id, other) AS nth
            FROM scored WHERE same),
        found AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
                   n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.place, p.nth ORDER BY n.score DESC, n.vec_id)::INT AS rank
            FROM near p JOIN scored n ON p.place = n.place AND p.nth <= 5 AND NOT n.same
                 AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
        SELECT * FROM found WHERE rank <= 10
    """,
    "op13_rendezvous_sharding": """
        WITH crc_table AS (
            SELECT list(c ORDER BY i) AS t
            FROM (SELECT i, list_reduce([i] || range(8), lambda c, b:
                             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                  FROM range(256) bytes(i))),
        docs AS (
            SELECT row_number() OVER () AS place, doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
                   xor(4294967295, list_reduce(
                       [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                                              lambda x: ('0x' || x)::BIGINT),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32
            FROM documents, crc_table),
        claims AS (
            SELECT place, s, -1 / ln((('0x' || substr(md5('shard:' || s || coalesce(':' || doc_id, '')), 1, 12))::BIGINT + 0.5)
                                     / 281474976710656::DOUBLE) AS claim
            FROM docs, range(9) shards(s)),
        won AS (
            SELECT place, arg_max(s, (claim, -s)) FILTER (s < 8)::INT AS shard, arg_max(s, (claim, -s))::INT AS grown_shard
            FROM claims GROUP BY place)
        SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
               row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
        FROM docs JOIN won USING (place)
    """,
}
