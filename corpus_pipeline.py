"""The corpus pipeline: language id, line dedup, near dedup, mixing, subword encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; its result
is written as Parquet and read again as the next one's ``docs``. All stages but the last return the
columns of ``documents``.

1. ``language_id``: texts without a letter and texts that are not familiar (too few of their byte
   sequences occur in the labelled sample, see ``language_id``) go.
2. ``line_dedup``: later occurrences of repeated three-line windows are cut out of the texts,
   ``n_chars`` follows; documents left without any line go.
3. ``near_dedup``: one document of each group at 0.8 of distinct five-word shingles stays.
4. ``mixing``: rows are repeated or dropped so that sources meet their target weights.
5. ``sentencepiece``: token ids of each text and the text that they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planscore.llm import (entropy_mix, language_id, line_dedup, minhash_hamming,
                           sentencepiece_bpe)
from planscore.session import materialize

# the largest softmax share rejects nothing, as its least value hangs on the number of labels
MIN_SCORE = 0.0


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = language_id.identify(docs, language_id.fit(docs), pred_col="_lang_pred",
                               score_col="_lang_score", familiar_col="_lang_familiar")
    return out.filter((F.col("_lang_pred") != language_id.UNKNOWN)
                      & F.col("_lang_familiar")).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(docs)
    out = out.filter(~((F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_hamming.keep_one(docs, k=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return entropy_mix.mix_copies(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tables = sentencepiece_bpe.load_tables(sentencepiece_bpe.default_model())
    return sentencepiece_bpe.encode_decode(docs, tables).select(
        "doc_id", "lang", "source", "n_tokens", "token_ids", "decoded")


STAGES = [("language_id", language_stage), ("line_dedup", line_stage),
          ("near_dedup", near_stage), ("mixing", mix_stage), ("sentencepiece", encode_stage)]

# A trained network, near-duplicate groups and subword encoding are beyond SQL; tests/llm holds
# the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
