"""The corpus pipeline: from raw documents to the token ids of clean, distinct ones.

Each stage takes the documents that its predecessor kept and calls one operator; its result is
written as Parquet and read again before the next. All stages but the last return the columns of
the documents they get.

1. language: documents without a letter, of which no language can be told, go. All others stay, also
   when no document is labelled and so no language is learned.
2. lines: lines that at least five documents share stay in the one with the largest id only.
3. near_duplicates: of each group linked by near fingerprints the smallest id stays.
4. decontaminate: documents of which benchmark windows cover at least a twentieth go.
5. encode: byte-level BPE ids, with a check that they decode to the text.

Null texts are rejected by the first stage. Documents without an id keep their lines and are nobody's
duplicates. Empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from trawl.llm import bpe, contamination, language, lines, simhash
from trawl.llm.common import read, saved


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language.train(docs.where(~held_out | F.col("doc_id").isNull()))
    marked = language.identify(docs, model, lang_out="__lang", score_out="__score", lettered_out="__lettered")
    return marked.where("__lettered").select(docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(docs, out_col="text")
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contamination.find_contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocab = bpe.vocabulary(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    # a digest stands for the text, which else each task would hold a second time beside its ids
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    encoded = bpe.encode(docs, vocab, decoded_col="decoded", drop=("text",), words_held=200_000)
    return encoded.select(
        "doc_id", "lang", "source", "n_chars", "n_tokens", "ids",
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("language", keep_known_languages),
    ("lines", drop_shared_lines),
    ("near_duplicates", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("encode", encode),
]

# No SQL: frozen context trees, XXH64 fingerprints and ranked merges aren't SQL-expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
