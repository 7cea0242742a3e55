"""Corpus pipeline over ``documents``: toxic texts go, one of each group of near copies stays, repeated
passages and benchmark leaks go, and what is left is encoded."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from voxlode.llm import bpe, decontam, ngram_join, suffix_dedup, toxicity
from voxlode.llm.queries import given, tokenizer_path, toxicity_model
from voxlode.session import scratch_path, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def shipped(stage: Stage) -> Stage:
    """``stage`` on executors where this package isn't installed."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run


@shipped
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.reject(docs, toxicity_model(spark, sf_dir))


@shipped
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that chains of links tie together (five-word shingles, similarity 0.8) that with the smallest id stays."""
    return ngram_join.keep_one(docs, percent=80, width=5)


@shipped
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes inside a 100-byte string that also starts earlier go; documents stay, even with nothing left."""
    return suffix_dedup.shorten(docs)


@shipped
def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item go."""
    return decontam.remove_leaks(docs, given(spark, sf_dir, "benchmark"))


@shipped
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what is left as token ids, and decoded again."""
    return bpe.round_trip(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("suffix_dedup", without_repeats),
    ("decontamination", without_leaks),
    ("bpe", encoded),
]

#: Trained models, suffix merges and byte-pair merges are not expressible in SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again as the next one's input."""
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
