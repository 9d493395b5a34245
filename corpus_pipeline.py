"""Corpus pipeline: each stage takes what its predecessor kept and gives the columns of ``documents``, the last its ids.

1. ``quality``: documents that the classifier scores under 0.3 go.
2. ``near_duplicates``: one document of each group of near copies stays (five-word shingles, similarity 0.8).
3. ``personal_data``: spans of personal data give way to the name of their kind.
4. ``mixing``: documents are repeated or dropped so that the learned domains hold the wanted shares of all tokens.
5. ``token_ids``: doc_id, lang, source, n_tokens and ids of each remaining row.

Rows with null key or text pass as their stages define (see the operators); an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, neardup, pii, quality, sourcemix
from millrace.llm.tables import held_out, materialize, table


#: Wanted shares of all tokens. Quality was settled by the first stage, so the domains differ by the other label.
TARGETS = {"toxic=0": 0.95, "toxic=1": 0.05}


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more; the network learns as op1 does, from the texts at hand."""
    network = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 5, 0))
    return quality.accepted(docs, network, 0.3)


def first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return neardup.first_of_each(docs, n=5, least=80)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind; every document stays."""
    return pii.redact(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; domains over their wanted share lose documents, others repeat them."""
    return sourcemix.mixed(docs, table(spark, sf_dir, "labels"), ["toxic"], TARGETS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each row's whole text."""
    return bpe.encoded(docs, ["doc_id", "lang", "source"])


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", first_of_near_copies),
    ("personal_data", hide_personal_data),
    ("mixing", mix_to_targets),
    ("token_ids", token_ids),
]

#: Trained models, checksums and merges have no SQL form; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
