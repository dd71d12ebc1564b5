"""From raw documents to tokens: language identification, near duplicates, repeated passages, benchmark
passages, byte-level BPE. ``STAGES`` are applied in order; each result is written as Parquet and read again.

Rows are documents. All stages but the last return the columns of ``documents``. Defined cases are those of the
operators; of rows with one doc_id, one stays at the near-duplicate stage; rows without an id are never dropped
there."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import bpe, decontaminate, jaccard, langid, repeats
from lakeops.session import scratch_path
from lakeops.tables import table

BROADCAST_ROWS = 500_000


def _drop(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``gone``; ``gone`` is broadcast if it is counted to be small."""
    gone = gone.checkpoint()
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, key, "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned: all but those without a text or letter (and all, if no row has a
    label), whatever the number of languages and however short the text."""
    found = langid.predict(docs, langid.learn_from_folds(docs))
    return found.where(F.col("lang_pred") != langid.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five words, similarity 0.8)."""
    classes = jaccard.near_classes(docs.select("doc_id", "text"), width=5, share=80)
    gone = classes.where("component_id <> doc_id").select("doc_id").distinct()
    kept = _drop(docs, gone, "doc_id")
    again = classes.groupBy("doc_id").count().where("doc_id is not null and count > 1").select("doc_id").checkpoint()
    if again.isEmpty():
        return kept
    rest = [c for c in docs.columns if c != "doc_id"]
    one = (kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("r"))
           .select("doc_id", *[F.col("r")[c].alias(c) for c in rest]))
    return kept.join(again, "doc_id", "left_anti").unionByName(one)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 bytes and more that an earlier one has."""
    cut = repeats.remove_repeats(docs, length=50)
    text = F.when(F.size("spans") > 0, repeats.kept_text(F.col("kept"))).otherwise(F.col("text"))
    return cut.withColumn("text", text).withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    key = F.xxhash64("text")  # a verdict follows from the text alone
    found = decontaminate.find_leaks(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = found.where("n_hit > 0").select(F.col("doc_id").alias("_key")).distinct()
    return _drop(docs.withColumn("_key", key), gone, "_key").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    done = bpe.encode_decode(docs.withColumn("_text", F.col("text")), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    exact = F.col("decoded") == F.coalesce(F.col("_text"), F.lit("")).cast("binary")
    return done.select("doc_id", "lang", "source", "n_chars", "ids", F.size("ids").cast("long").alias("n_tokens"), exact.alias("exact"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("benchmark_passages", benchmark_passages), ("tokens", tokens)]

#: No SQL for suffix order, frozen byte statistics or BPE: tested against brute force (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
