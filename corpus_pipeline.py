"""The corpus pipeline: documents in, token ids out, in five stages.

Each stage is a function of (spark, docs, sf_dir) over all rows that the stage before it kept;
its result is written as Parquet, and the next one reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormgrid.llm import bpe, mixing, neardup, secret_ledger, toxicity
from stormgrid.llm.queries import VOCABULARY, importable
from stormgrid.session import scratch

# Nearly all tokens, each at most once: small sources stay whole, the largest gives way.
MIX = mixing.Mix(percent=95, epochs=1)


# Rows that travel to a Python worker at a time. A batch is held several times over, by Spark and
# by the worker, and five stages of workers and compiled plans share an executor here.
BATCH_ROWS = 1000


def workers(spark: SparkSession) -> None:
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    workers(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    workers(spark)
    return neardup.keep_first(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secret_ledger.redact(docs, scratch(spark, "ledger"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the token budgets of their sources select."""
    return mixing.select_documents(docs, MIX)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    workers(spark)
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), VOCABULARY).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

# Learnt scores and automata are beyond SQL; tests/llm/test_pipeline.py holds each stage against
# plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
