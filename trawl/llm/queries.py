"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.llm import (bpe, contamination, hmm, idfiles, language, lines, negatives, pii, quality, shards, simhash, sketches,
                       whitening)
from trawl.llm.common import read, scratch_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = bpe.vocabulary(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocab, decoded_col="decoded", drop=("text",)).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op2_simple8b_ids")
def op2_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "ids")
    idfiles.write_ids(read(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1,
                      added_tokens=True)
    return idfiles.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_bottom_k_sketch")
def op3_bottom_k_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sketches.edited_with_next(read(spark, sf_dir, "documents"))
    rows = rows.withColumn("edited_sketch", sketches.sketch(F.col("edited")))
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketches.to_string(own).alias("fingerprint"), sketches.to_string(edited).alias("edited_fingerprint"),
        sketches.resemblance(own, edited).alias("near_edited"),
        sketches.resemblance(own, following).alias("near_next"))


@query("op4_wu_manber")
def op4_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(
        read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"), drop=("text",))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_byte_shards")
def op7_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op8_line_runs", """
    WITH split AS (
      SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ), numbered AS (
      SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM split
    ), keyed AS (
      SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM numbered
    ), repeated AS (
      SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5
    ), marked AS (
      SELECT k.doc_id, k.i, k.line, r.key IS NOT NULL AND k.doc_id <> r.top AS gone
      FROM keyed k LEFT JOIN repeated r ON k.key = r.key
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
""")
def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_lines(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_bootstrapped_pii")
def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, pii.KINDS), F.sha2(pii.span_list(F.col("base")), 256).alias("base_sha256"),
        pii.span_list(F.concat("base", "more")).alias("spans"))


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query("op9_ppm_language")
def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.train(docs.where(_remainder(3) != 1))
    return language.identify(docs.select("doc_id", "text"), model, drop=("text",)).select(
        "doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score")


@query("op10_subword_quality")
def op10_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(_remainder(5) != 0)
    classifier = quality.train(docs, labels)
    return quality.with_scores(docs, classifier, drop=("text",)).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query("op11_hmm_scores")
def op11_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm.score_texts(read(spark, sf_dir, "documents"), learn=_remainder(7) != 2)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op12_jacobi_davidson_whitening")
def op12_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query("op13_anchor_lists", """
    WITH vectors AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ), scored AS (
      SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same, list_inner_product(a.x, v.x)::BIGINT AS score
      FROM vectors a JOIN vectors v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0
    ), positives AS (
      SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
      AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
    WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
    QUALIFY row_number() OVER w <= 3
""")
def op13_anchor_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)
