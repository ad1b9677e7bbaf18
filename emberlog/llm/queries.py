"""Registered queries of the training-data operators: thin calls with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import forest, frames, jaccard, licences, lines, negatives, packing, pieces, repeats, sharding, toxicity, trie, voronoi
from emberlog.llm.common import read
from emberlog.session import utc

Plan = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(read(spark, sf_dir, "embeddings"), every=50, k=5)


def op2_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_duplicates(read(spark, sf_dir, "documents"), width=5, threshold=0.8)
    return found.select("doc_id", "class_id", "n_links")


def op3_passage_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.without_repeats(read(spark, sf_dir, "documents"), window=35)
    return done.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.without_similar_lines(read(spark, sf_dir, "documents"), min_words=5, least=0.8, short_copies=True)
    return done.select("row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op5_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text under seeded merge-dropout, and whether they decode to the text."""
    model = tokenizer_path("piece_bpe_32k.model")
    coded = pieces.encode(read(spark, sf_dir, "documents"), model, dropout=0.1, seed=1, check=True)
    text = F.coalesce("text", F.lit(""))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"), (F.col("decoded") == text).alias("lossless"),
    )


def op6_voronoi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.largest_products(read(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


def op7_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = frames.write(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return frames.scan(files)


def op8_toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")), threshold=0.3)
    return scored.select("row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=0, capacity=2048)


def op10_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=24)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = trie.prefix_trie(read(spark, sf_dir, "conversations"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.labelled(licences.scan(read(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), every=50, positives=5, negatives=3, scale=256)


PLANS: dict[str, Plan] = {
    f.__name__: f
    for f in (
        op1_projection_forest, op2_chosen_path, op3_passage_index, op4_simhash_lines, op5_merge_dropout, op6_voronoi_join, op7_token_frames, op8_toxicity_lexicon, op9_best_fit_packing, op10_vector_shards,
        op11_prefix_trie, op12_license_rules, op13_hard_negatives,
    )
}
SQL: dict[str, str] = {
    "op6_voronoi_join": """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM valid q JOIN valid d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM placed WHERE r <= 5""",
    "op11_prefix_trie": """
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
lens AS (
  SELECT c, count(*) AS n, c - c % 100 AS base,
    xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(unicode(x) AS UBIGINT))),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, CAST(3988292384 AS UBIGINT) * (v & 1)))), CAST(4294967295 AS UBIGINT)) % 6 AS h
  FROM own GROUP BY c),
conv AS (
  SELECT a.c, a.base, CAST(a.h AS BIGINT) AS h, least(CAST(a.h AS BIGINT), coalesce(b.n, 0)) AS m FROM lens a LEFT JOIN lens b ON b.c = a.base),
turns AS (
  SELECT v.c, o.pos AS d, o.role, o.text FROM conv v JOIN own o ON o.c = v.base AND o.pos <= v.m
  UNION ALL SELECT v.c, o.pos - v.h + v.m, o.role, o.text FROM conv v JOIN own o ON o.c = v.c AND o.pos > v.h),
paths AS (
  SELECT c, d, text, md5(CAST(list([role, text]) OVER (PARTITION BY c ORDER BY d) AS VARCHAR)) AS k FROM turns
  UNION ALL SELECT c, 0, '', '' FROM conv),
linked AS (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS pk, d = max(d) OVER (PARTITION BY c) AS ends FROM paths),
nodes AS (
  SELECT d, k, any_value(pk) AS pk, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(length(text)) AS saved,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '') AS ids FROM linked GROUP BY d, k),
kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
whole AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.d = n.d AND k.k = n.k),
below AS (
  SELECT p.d, p.k, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum(w.saved) AS saved_tokens
  FROM whole w JOIN paths p ON p.c = w.conv_id AND p.d <= w.d GROUP BY p.d, p.k)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens,
  sha256(w.ids) AS ends_sha256
FROM whole w JOIN below b ON b.d = w.d AND b.k = w.k LEFT JOIN nodes p ON p.d = w.d - 1 AND p.k = w.pk""",
    "op13_hard_negatives": """
WITH valid AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, d.vec_id AS vec_id, a.label = d.label AS same, CAST(list_dot_product(a.v, d.v) AS BIGINT) AS score
  FROM valid a JOIN valid d ON d.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
placed AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS r
  FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM placed WHERE r <= 3""",
}


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return PLANS[name](utc(spark), sf_dir)


def queries() -> dict[str, Plan]:
    return {name: partial(run, name) for name in PLANS}
