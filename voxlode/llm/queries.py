"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship
from . import bpe, decontam, divergence, idfile, licenses, lm, ngram_join, phrases, sharding, suffix_dedup, toxicity, vector_codes, warc

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def wrap(fn: Runner) -> Runner:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return wrap


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Bytes of text in a shard at most.
SHARD_LIMIT = 1 << 20


@query("op1_sharding", sharding.ORACLE.format(limit=SHARD_LIMIT))
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    return sharding.assign(given(spark, sf_dir, "documents"), SHARD_LIMIT)


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 100-byte strings."""
    return suffix_dedup.digest(suffix_dedup.remove_repeats(given(spark, sf_dir, "documents")))


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.round_trip(given(spark, sf_dir, "documents"), tokenizer_path())


@query("op4_id_files")
def op4_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from the files."""
    folder = scratch_path(spark, "op4-ids")
    idfile.write_ids(given(spark, sf_dir, "documents"), folder, tokenizer_path())
    return idfile.read_index(spark, folder)


OP9_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT digest, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY digest
)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n >= 100
"""


@query("op9_warc", OP9_SQL)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives."""
    folder = scratch_path(spark, "op9-warc")
    warc.write_archives(given(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder, payloads=False).drop("url")


@query("op10_decontamination", decontam.ORACLE.format(depth=10))
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of every document stand in a benchmark window, and of which items."""
    return decontam.digest(decontam.find_leaks(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark")))


@query("op5_lm")
def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document by the model and by smoothed counts; a tenth is held out."""
    return lm.score_texts(given(spark, sf_dir, "documents"), toxicity.fold("doc_id", 10) == 0)


@query("op6_divergence")
def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document, against references learned from all documents."""
    docs = given(spark, sf_dir, "documents")
    return divergence.judge(docs, divergence.learn_references(docs))


@query("op7_ngram_join")
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and component at similarity 0.85 on four-word shingles."""
    return ngram_join.components(given(spark, sf_dir, "documents"), percent=85, width=4)


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.learn(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"), toxicity.fold("doc_id", 5) != 0)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of the held-out fifth are not read."""
    scored = toxicity.score(given(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (toxicity.fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op11_phrases", phrases.ORACLE.format(least=30, top=2000))
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2000 phrases of two to four words of every language."""
    return phrases.collocations(*phrases.count_phrases(given(spark, sf_dir, "documents")))


@query("op12_licenses", licenses.ORACLE)
def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts of every document."""
    return licenses.scan(given(spark, sf_dir, "documents"))


@query("op13_vector_codes", vector_codes.ORACLE)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector: 8 parts, 16 entries, 6 rounds."""
    codes = vector_codes.compress(given(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes).drop("label")
