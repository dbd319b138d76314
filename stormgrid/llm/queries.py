"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stormgrid.llm import (
    bpe,
    lexical,
    license_scan,
    mixing,
    neardup,
    neighbours,
    oracle,
    periodic,
    quality_mil,
    quality_rules,
    repeats,
    secret_ledger,
    toxicity,
    warc,
)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def importable(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    held = spark.sparkContext.environment
    if root not in held.get("PYTHONPATH", "").split(":"):
        held["PYTHONPATH"] = ":".join(filter(None, [held.get("PYTHONPATH"), root]))


def query(name: str, sql: str | None = None):
    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


@query("op1_mixing", oracle.mixing_sql(mixing.Mix()))
def op1(table) -> DataFrame:
    return mixing.mixed(table("documents"))


@query("op2_minhash_near_dedup")
def op2(table) -> DataFrame:
    return neardup.near_duplicates(table("documents"))


@query("op3_toxicity")
def op3(table) -> DataFrame:
    docs = table("documents")
    return toxicity.score(docs, toxicity.fit(docs, table("labels")))


@query("op4_warc", oracle.WARC_SQL)
def op4(table) -> DataFrame:
    return warc.archive_report(table("pages"))


@query("op5_bpe")
def op5(table) -> DataFrame:
    return bpe.encode(table("documents").select("doc_id", "text"), VOCABULARY, digests=True)


@query("op6_license_scan")
def op6(table) -> DataFrame:
    return license_scan.scan(table("documents"))


@query("op7_nearest_neighbours")
def op7(table) -> DataFrame:
    return neighbours.search_table(table("embeddings"))


@query("op8_quality_rules")
def op8(table) -> DataFrame:
    docs = table("documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table("labels")))


@query("op9_quality_mil")
def op9(table) -> DataFrame:
    docs = table("documents")
    return quality_mil.score(docs, quality_mil.fit(docs, table("labels")))


@query("op10_secret_ledger", oracle.secrets_sql())
def op10(table) -> DataFrame:
    return secret_ledger.report(table("documents"))


@query("op11_suffix_dedup")
def op11(table) -> DataFrame:
    return repeats.repeated_bytes(table("documents"))


@query("op12_periodic_runs")
def op12(table) -> DataFrame:
    return periodic.report(table("documents"), plant=True)


@query("op13_ranked_search", oracle.LEXICAL_SQL)
def op13(table) -> DataFrame:
    return lexical.search(table("documents"), table("benchmark"))
