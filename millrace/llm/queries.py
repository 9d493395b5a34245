"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    addresses,
    bpe,
    divergence,
    idfiles,
    infill,
    mixing,
    nearest,
    neardup,
    perplexity,
    pii,
    quality,
    sourcemix,
    substrings,
)
from millrace.llm.tables import held_out, table
from millrace.session import scratch_path


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; a fifth of the keys is held out of learning."""
    docs, apart = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0)
    network = quality.fit(docs, table(spark, sf_dir, "labels"), ~apart)
    return quality.score(docs, network).select(
        "doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and line counts of every document, and whether it passes them and its language's perplexity band."""
    return perplexity.judged(table(spark, sf_dir, "documents"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


OP3_SQL = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    sqrt(list_sum([(q.v[i] - c.v[i]) * (q.v[i] - c.v[i]) FOR i IN range(1, len(q.v) + 1)])) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 100 = 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place FROM ranked
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM placed WHERE place <= 10
"""


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document; a seventh of the keys is held out of learning."""
    apart = held_out(F.col("doc_id"), 7, 2)
    return mixing.scores(table(spark, sf_dir, "documents"), ~apart).select(
        "doc_id", apart.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "bits_per_byte")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with alike sets of two-word shingles."""
    found = neardup.groups(table(spark, sf_dir, "documents"), n=2, least=80)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"),
                        (F.col("component") == F.col("doc_id")).alias("kept"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of earlier ones, as digests."""
    return substrings.digest(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text decoded from them, as digests."""
    return bpe.digest(table(spark, sf_dir, "documents"))


#: Wanted shares of all tokens. The two domains of low quality overlap, so their shares keep the proportion they have.
TARGETS = {"quality=1,toxic=0": 0.92, "quality=1,toxic=1": 0.04, "quality=0,toxic=0": 0.034, "quality=0,toxic=1": 0.006}


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document under the wanted shares."""
    return sourcemix.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["quality", "toxic"],
                           TARGETS)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(table(spark, sf_dir, "documents"))


def op10_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written in order to compressed files and read back."""
    path = scratch_path(spark, "ids")
    idfiles.write(table(spark, sf_dir, "documents"), path, end_id=2)
    return idfiles.read(spark, path, ids=False).withColumnRenamed("key", "doc_id")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for filling in its middle, as digests."""
    return infill.digest(table(spark, sf_dir, "documents"))


def op12_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's address."""
    return addresses.filtered(table(spark, sf_dir, "pages"), addresses.RULES)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that set each source apart."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_perplexity": op2_perplexity,
    "op3_nearest": op3_nearest,
    "op4_context_mixing": op4_context_mixing,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_substrings": op6_substrings,
    "op7_bpe": op7_bpe,
    "op8_source_mix": op8_source_mix,
    "op9_pii": op9_pii,
    "op10_id_files": op10_id_files,
    "op11_infill": op11_infill,
    "op12_addresses": op12_addresses,
    "op13_divergence": op13_divergence,
}

#: Queries without an entry are held against brute-force versions in tests/llm.
ORACLES: dict[str, str] = {
    "op3_nearest": OP3_SQL,
    "op11_infill": infill.SQL,
    "op12_addresses": addresses.SQL,
    "op13_divergence": divergence.SQL,
}
