"""The registered queries of the operators: each over its whole table, in the form of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import read_table, training_rows
from strata.llm.oracles import OP13_SQL, op11_sql, op12_sql


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.ppm import score
    return score(read_table(spark, sf_dir, "documents"))


def op2_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.recompression import deduplicate
    return deduplicate(read_table(spark, sf_dir, "documents"), full=False)


def op3_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.pii import find_personal_data, span_text
    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "other")
    return found.select(
        "doc_id",
        *[F.size(F.filter("spans", _of_kind(k))).cast("bigint").alias(f"n_{k}")
          for k in ("email", "ip", "card", "phone")],
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def op4_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.toxicity import fit, score
    docs = read_table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (~training_rows("doc_id", 3, 1)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.ngram_quality import quality
    return quality(read_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.language_id import fit, predict
    docs = read_table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs))
    return found.select("doc_id", (~training_rows("doc_id", 3, 1)).alias("held_out"),
                        "lang_pred", "score")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.sharding import external_shuffle
    placed = external_shuffle(read_table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        "law", "shard", "slot", "grown_shard")


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.decontamination import find_contamination
    found = find_contamination(read_table(spark, sf_dir, "documents"),
                               read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated")


def op8_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.piece_bpe import encode_decode
    return encode_decode(read_table(spark, sf_dir, "documents"),
                         tokenizer_path("piece_bpe_32k.model"), full=False)


def op10_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.parity_join import similar_groups
    return similar_groups(read_table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.licenses import scan
    return scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        "score")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.centroids import cluster, with_inertia
    return with_inertia(cluster(read_table(spark, sf_dir, "embeddings"))).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.importance import resample
    return resample(read_table(spark, sf_dir, "documents"),
                    read_table(spark, sf_dir, "benchmark")).drop("n_words")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ppm": op1_ppm,
        "op2_recompression": op2_recompression,
        "op3_bootstrapped_pii": op3_bootstrapped_pii,
        "op4_compression_toxicity": op4_compression_toxicity,
        "op5_ngram_quality": op5_ngram_quality,
        "op6_language_id": op6_language_id,
        "op7_sharding": op7_sharding,
        "op8_piece_bpe": op8_piece_bpe,
        "op9_winnowing": op9_winnowing,
        "op10_parity_join": op10_parity_join,
        "op11_license_scan": op11_license_scan,
        "op12_centroid_clustering": op12_centroid_clustering,
        "op13_importance_resampling": op13_importance_resampling,
    }


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(w[s + 1 : s + 20], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS n FROM windows)
  WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s + 1, s + 21)) AS p FROM later)),
words AS (SELECT doc_id, p, w[p] AS word
          FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (
  SELECT words.doc_id, count(gone.p) AS n_removed,
    string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL) AS t
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p
  GROUP BY words.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT item_id, least(10, len(w)) AS n, unnest(range(0, len(w) - least(10, len(w)) + 1)) AS p, w
  FROM i WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, n, array_to_string(w[p + 1 : p + n], ' ') AS t FROM iw),
dw AS (
  SELECT doc_id, n, w, unnest(range(0, len(w) - n + 1)) AS p
  FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n),
hits AS (
  SELECT doc_id, item_id, p, dw.n AS n FROM dw JOIN items
  ON dw.n = items.n AND array_to_string(dw.w[p + 1 : p + dw.n], ' ') = items.t),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits))
  GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_recompression": OP2_SQL, "op9_winnowing": OP9_SQL,
            "op11_license_scan": op11_sql(), "op12_centroid_clustering": op12_sql(),
            "op13_importance_resampling": OP13_SQL}
