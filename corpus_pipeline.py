"""The corpus pipeline: from raw documents to sampled pieces.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame; all but the
last return the columns of documents. SQL cannot express the learnt, sketched and sampled stages, so there is no
ORACLE_SQL; the tests compare every stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import decontaminate, jaccard, pieces, secret_scan, toxicity
from starloom.llm.spans import settled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that labelled neighbours call toxic go."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: word 5-grams, Jaccard similarity of 0.8 or more."""
    return jaccard.keep_first(docs, percent=80, n=5)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans that occur in the benchmark are cut out; documents that are mostly benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secret_scan.redact(docs)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two different segmentations of each document, as piece ids."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", cut_benchmark),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding", sample_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = settled(docs, "stage")
    return docs
