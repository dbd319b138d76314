"""Each stage of the pipeline against plain Python or SQL over what the stage before it kept."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stormgrid.llm import mixing, neardup, oracle, queries, secret_ledger, toxicity
from stormgrid.session import scratch
from test_llm import documents, groups_by_brute_force


@pytest.fixture(autouse=True)
def importable(spark):
    queries.importable(spark)


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def redacted_by_spans(text, spans):
    """Texts with each stretch of overlapping or touching-on spans as one mark."""
    out, at = "", 0
    for span in filter(None, spans.split(",")):
        start, end = map(int, span.split(":")[1:])
        if start >= at or not at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return out + text[at:]


def test_stages_by_plain_python(spark, sf_dir, folder):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = kept[name] = spark.read.parquet(path)
        if name != "bpe":
            assert docs.columns == before.columns
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            clean = {r["doc_id"] for r in toxicity.score(before, model).where("predicted = 0").collect()}
            assert set(texts_of(docs)) == clean
        elif name == "minhash_near_dedup":
            groups = groups_by_brute_force(texts_of(before).items())
            assert set(texts_of(docs)) == {i for i, (_, _, first) in groups.items() if first}
        elif name == "secret_scan":
            spans = {r["doc_id"]: r["spans"] for r in secret_ledger.report(before, f"{folder}/ledger").collect()}
            texts = texts_of(before)
            assert texts_of(docs) == {i: redacted_by_spans(t, spans[i]) for i, t in texts.items()}
        elif name == "mixing":
            db = duckdb.connect()
            db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/secret_scan/*.parquet')")
            wanted = db.execute(oracle.mixing_sql(corpus_pipeline.MIX)).fetchall()
            assert {r[0] for r in wanted} == set(texts_of(docs))
        else:
            library = Tokenizer.from_file(str(queries.VOCABULARY))
            library.no_truncation()
            library.no_padding()
            texts = texts_of(before)
            got = {r["doc_id"]: r["ids"] for r in docs.collect()}
            assert got == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}


def test_run_on_few_rows(spark, sf_dir, folder):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").where("doc_id < 40").write.parquet(f"{folder}/{table}.parquet")
    rows = corpus_pipeline.run(spark, folder)
    assert 0 < rows.count() <= 40 and "ids" in rows.columns
    empty = f"{folder}/none"
    for table in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").limit(0).write.parquet(f"{empty}/{table}.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_clashing_names(spark, folder):
    docs = documents(spark, [(1, "password=abcdefgh12 tail"), (2, "nothing"), (3, None)])
    named = docs.withColumns({"_blob": F.lit("b"), "_spans": F.lit(7), "_tail": F.lit(8), "_SCORE": F.lit("s"), "_score_": F.lit(1)})
    got = {r["doc_id"]: r for r in secret_ledger.redact(named, f"{folder}/ledger").collect()}
    assert "[secret]" in got[1]["text"] and "abcdefgh12" not in got[1]["text"] and got[1]["text"].endswith(" tail")
    assert (got[2]["text"], got[3]["text"]) == ("nothing", None)
    assert all((r["_blob"], r["_spans"], r["_tail"], r["_SCORE"]) == ("b", 7, 8, "s") for r in got.values())
    labels = spark.createDataFrame([(9, 0, 1)], "doc_id long, quality int, toxic int")
    clean = toxicity.keep_clean(named, toxicity.fit(named, labels))
    assert clean.columns == named.columns and {r["_SCORE"] for r in clean.collect()} <= {"s"}


def test_small_tables_are_few_files(spark, folder):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[: 50 + i % 7], f"token=abcdefgh{i:04d}"]) for i in range(90)]
    texts += [" ".join(f"{w}x{i // 2}" for w in words) for i in range(60)]
    docs = documents(spark, list(enumerate(texts)))
    docs.write.parquet(f"{folder}/documents")
    docs = spark.read.parquet(f"{folder}/documents")
    tables = Path(scratch(spark, "none")).parent
    before = set(tables.iterdir()) if tables.exists() else set()
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        kept = neardup.keep_first(docs)
        kept.write.parquet(f"{folder}/kept")
        secret_ledger.redact(docs, f"{folder}/ledger").write.parquet(f"{folder}/redacted")
        mixing.select_documents(docs, corpus_pipeline.MIX).write.parquet(f"{folder}/mixed")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    groups = groups_by_brute_force(enumerate(texts))
    assert set(texts_of(spark.read.parquet(f"{folder}/kept"))) == {i for i, (_, _, first) in groups.items() if first}
    # each of these tables is a few rows; tables that no shuffle precedes have the parts of their input
    made = [p for p in tables.iterdir() if p not in before and not p.name.startswith(("sketches-", "tokens-"))]
    assert any(p.name.startswith("small-star-") for p in made) and any(p.name.startswith("goals-") for p in made)
    written = [*made, *Path(folder, "ledger").glob("*/*"), Path(folder, "kept"), Path(folder, "redacted")]
    assert {p.name: n for p in written if (n := len(list(p.glob("part-*")))) > 1} == {}
