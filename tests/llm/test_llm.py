"""The training-text operators against SQL, brute force and planted cases."""

import base64
import collections
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from stormgrid.llm import (
    bpe,
    license_scan,
    mixing,
    neardup,
    neighbours,
    quality_mil,
    quality_rules,
    queries,
    secret_ledger,
    shingles,
    toxicity,
    warc,
)
from stormgrid.llm.rules import statistics
from stormgrid.llm.textvec import text_chunks

WORD = re.compile(r"[^\x20\x09-\x0d]+")


@pytest.fixture(autouse=True)
def importable(spark):
    queries.importable(spark)


def documents(spark, rows):
    """Rows of (doc_id, text) as documents, with a column whose name clashes with a result's."""
    full = [(i, t, "en", "src1", len(t or ""), "x") for i, t in rows]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long, score string"
    )


EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (4, "one two"), (None, "one two"), (5, "ä" * 50_000)]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, sf_dir, name):
    got = compare.spark_rows(queries.QUERIES[name](spark, sf_dir))
    assert not compare.differences(got, compare.duck_rows(compare.connect(sf_dir), queries.ORACLE[name]))


def groups_by_brute_force(rows):
    sets = {}
    for i, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_duplicates(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)]
    base = [list(rng.choice(words, n)) for n in (3, 30, 200, 600)]
    rows = [(0, None), (1, ""), (2, "  ")]
    for b in base:
        for copy in range(12):  # copies, near copies around the threshold, and less like ones
            w = list(b)
            for at in rng.choice(len(w), copy % 6 * len(w) // 40, replace=False):
                w[at] = "changed" + str(rng.integers(1000))
            rows.append((len(rows), " ".join(w)))
    got = neardup.near_duplicates(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == groups_by_brute_force(rows)
    assert neardup.near_duplicates(documents(spark, EDGE)).count() == len(EDGE)
    assert neardup.near_duplicates(documents(spark, [])).isEmpty()


def test_bpe_like_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.VOCABULARY)
    rows = [*EDGE, (6, "I'll don't  'tis 12½x\r\n <|endoftext|><|endoftext|> y漢字😀 " + "a" * 99 + " thndesea")]
    got = bpe.encode(documents(spark, rows), queries.VOCABULARY)
    for r in bpe.decode(got, queries.VOCABULARY).collect():
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (want, len(want), r["text"] or "")
    for r in bpe.encode(documents(spark, rows).select("doc_id", "text"), queries.VOCABULARY, digests=True).collect():
        text = next(t for i, t in rows if i == r["doc_id"])
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_secrets(spark, folder):
    rows = [
        (1, 'token=secret= "abcdefgh12 AKIA AKIAABCDEFGHIJKL1 ' + "a" * 40),
        (2, "é漢 password: 'abcdefghi' PassWD=12345678"),
        (3, None),
        (4, ""),
        (5, "plain"),
        (6, "é漢 password: 'abcdefghi' PassWD=12345678"),
    ]
    rules = {r.kind: r for r in secret_ledger.RULES if r.base}
    got = {r["doc_id"]: r for r in secret_ledger.report(documents(spark, rows), folder + "/ledger").collect()}
    for i, text in rows:
        found = sorted(
            (m.start(), k, m.end(), kind)
            for k, (kind, rule) in enumerate(rules.items())
            for m in re.finditer(rule.pattern, text or "", re.ASCII)
            if len(m[rule.group]) >= rule.least
        )
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert got[i]["n_assign"] == sum(f[3] == "assign" for f in found)
    # the next run scans only what is new, and old findings reach new paths
    scanned = spark.read.parquet(folder + "/ledger/scanned").count()
    assert scanned == 4  # distinct texts, null being the empty one
    more = documents(spark, [(7, rows[0][1]), (8, "fresh AKIAABCDEFGHIJKL9")])
    after = {r["doc_id"]: r for r in secret_ledger.report(more, folder + "/ledger").collect()}
    assert after[7]["spans"] == got[1]["spans"] and after[8]["n_access"] == 1
    assert spark.read.parquet(folder + "/ledger/scanned").count() == scanned + 1
    clean = {r["doc_id"]: r for r in secret_ledger.redact(documents(spark, rows), folder + "/second").collect()}
    assert clean[2]["text"] == "é漢 [secret]' [secret]" and clean[2]["n_chars"] == len(clean[2]["text"])
    assert clean[3]["text"] is None and clean[5]["text"] == "plain"


def test_archive(spark, folder):
    rows = [(1, "u", "a"), (2, "u", "a"), (3, "v", None), (4, "v", ""), (5, "a\nb", "x\r\n\r\ny"), (2, "u", "a")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archive(pages, folder + "/warc")
    records = warc.read_archive(spark, folder + "/warc").collect()
    assert spark.read.parquet(folder + "/warc/blobs").count() == 3 and len(records) == len(rows)
    for r in records:
        html = next(h for i, _, h in rows if i == r["page_id"]) or ""
        top = max(i for i, _, h in rows if (h or "") == html)
        assert bytes(r["payload"]).decode() == html
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["page_id"] == top else ("revisit", top))
        body = html.encode() if r["record_type"] == "response" else b""
        assert bytes(r["record"]) == bytes(r["header"]) + body + b"\r\n\r\n"
        assert b"sha1:" + base64.b32encode(hashlib.sha1(html.encode()).digest()) in bytes(r["header"])
    broken = spark.read.parquet(folder + "/warc/blobs").select("blob", F.lit(b"z").alias("payload"))
    spark.read.parquet(folder + "/warc/headers").write.parquet(folder + "/bad/headers")
    broken.write.parquet(folder + "/bad/blobs")
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, folder + "/bad").collect()


def test_archive_report_reads_the_records(spark, folder, monkeypatch):
    rows = [(1, "u/1", "ä b"), (2, "u/2", "ä b"), (3, None, None), (4, "u\r\nWARC-Type: x", "c\r\n\r\nWARC-Type: y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.archive_report(pages, folder + "/r1").collect()}
    assert got == {1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None)}
    header = warc._header
    for i, (good, bad) in enumerate([("Type: revisit", "Type: response"), ("sha1:", "sha1:A"), ("uuid:", "uuid:0")]):
        swap = lambda c: F.replace(header(c).cast("string"), F.lit(good), F.lit(bad)).cast("binary")  # noqa: B023, E731
        monkeypatch.setattr(warc, "_header", swap)
        with pytest.raises(Exception, match="damaged record"):
            warc.archive_report(pages, f"{folder}/bad{i}").collect()


def test_mixing_goes_to_siblings_first(spark):
    rows = [("web", "en", "a", 10), ("web", "en", "b", 100), ("web", "de", "c", 100), ("books", "en", "d", 200)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long")
    leaves = leaves.withColumn("leaf", F.concat("domain", "lang", "source")).withColumn("docs", F.lit(1))
    shares = mixing.allocate(leaves, mixing.Mix(percent=50, epochs=1, weights={}))
    got = {r["source"]: r["share"] for r in shares.collect()}
    assert got == {"a": 10, "b": 41, "c": 51, "d": 103}
    assert mixing.mixed(documents(spark, [])).isEmpty()
    assert {r["doc_id"] for r in mixing.mixed(documents(spark, EDGE), mixing.Mix(100, 1)).collect()} == {None, 1, 2, 3, 4, 5}


def test_mixing_keeps_the_budget_where_ids_repeat(spark):
    docs = documents(spark, [(7, f"{i} b c d e f g h i j") for i in range(20)] + [(7, None)] * 3).repartition(5)
    got = mixing.mixed(docs, mixing.Mix(percent=12, epochs=1)).collect()
    assert sorted(r["taken_tokens"] for r in got if r["taken_tokens"]) == [4, 10, 10]
    assert {r["doc_id"] for r in got} == {7}
    whole = mixing.select_documents(docs, mixing.Mix(percent=12, epochs=1))
    assert whole.columns == docs.columns and whole.where("text IS NOT NULL").count() == 3
    twice = mixing.mixed(docs, mixing.Mix(percent=112, epochs=2)).collect()
    assert sum(r["taken_tokens"] for r in twice) == 224 and {r["epoch"] for r in twice} == {1, 2}


def test_secrets_sql_on_odd_texts(spark):
    """The SQL agrees where matches touch, repeat, fail their length or stand among wide letters."""
    rows = [
        (1, 'token=secret= "abcdefgh12 AKIA AKIAABCDEFGHIJKL1 ' + "a" * 40 + "0" * 32),
        (2, "é漢😀 password: 'abcdefghi' PassWD=12345678 \u017fecret=abcdefgh12"),
        (2, "é漢😀 password: 'abcdefghi' PassWD=12345678 \u017fecret=abcdefgh12"),
        (3, None),
        (4, ""),
        (None, "api_key=ghp_" + "Z" * 40 + "\n-----BEGIN RSA PRIVATE KEY-----eyJ" + "a" * 40 + ".b.c"),
        (5, "token=short token=longenough " * 50),
    ]
    db = compare.duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    got = compare.spark_rows(secret_ledger.report(documents(spark, rows)))
    assert not compare.differences(got, compare.duck_rows(db, queries.ORACLE["op10_secret_ledger"]))


def test_decoder():
    flat = toxicity.Decoder(np.full((28, 28, 28), -np.log(28)))
    for text, want in [("m0r0n", "moron"), ("l o s e r", "loser"), ("@ss", "ass"), ("2024 x", "2024 x"), ("", "")]:
        assert flat.restore(text) == want


def test_decoder_reads_every_disguise():
    flat = toxicity.Decoder(np.full((28, 28, 28), -np.log(28)))
    for word, forms in {
        "scum": ["$ c u m"],
        "trash": ["t r @ s h", "ttrr@@sshh"],
        "ass": ["@ s s"],
        "idiot": ['"i d i o t"', "(i d i o t)", "i  d i   o t", "!diot", "|diot", '"!diot"', "idi0t" + "!" * 200]
        + ["i" * 70 + "diot", "iddiioott"],
        "clown": ["(lown"],
    }.items():
        for form in forms:
            assert word in toxicity.signs(flat.readings(f"words, {form} words")), form
    for text in ["wow!!! (see) 12|13", "committee bookkeeper", "a a a a", "1 2 3 4"]:
        assert flat.restore(text) == text and toxicity.signs(text) <= toxicity.signs(flat.readings(text))


def test_decoder_takes_the_cheapest_path(monkeypatch):
    rng = np.random.default_rng(8)
    logp = rng.normal(-3, 1, (28, 28, 28))
    decoder = toxicity.Decoder(logp)

    def cost(path):
        a = b = total = 0
        for letters, price in path:
            total += price
            for c in letters:
                z = decoder.code(c)
                total, a, b = total - logp[a][b][z], b, z
        return total

    for i in range(300):
        token = "".join(rng.choice(list("abi0134$@!|t .-"), rng.integers(1, 9)))
        steps = decoder.lattice(token, spaced=i % 2 == 0)
        every = {}
        for path in itertools.product(*steps, [("\n", 0.0)]):
            word = "".join(letters for letters, _ in path)[:-1]
            every[word] = min(cost(path), every.get(word, np.inf))
        assert abs(every[decoder.best_path(steps)] - min(every.values())) < 1e-9, token
    long = [decoder.lattice(t * 40) for t in ("1d10t", "a1b|c!", "1|")]
    whole = [decoder.best_path(s) for s in long]
    monkeypatch.setattr(toxicity, "SETTLED", 3)
    assert [decoder.best_path(s) for s in long] == whole


def test_decoder_reads_long_tokens_and_mixed_separators():
    flat = toxicity.Decoder(np.full((28, 28, 28), -np.log(28)))
    for form in ("i.d-i.o.t", "i/d/i/o/t", "i\nd\ni\no\nt", "i, d; i - o _ t", "i*d.i  o\n\nt"):
        assert "idiot" in toxicity.signs(flat.readings(f"some words, {form}. More")), form
    begin = "x".join("abcdefghjk" * 10)
    assert flat.restore(f"{begin}sc0rn") == f"{begin}scorn"  # 204 characters
    assert toxicity.features("w" * 39)[0] == "w" * 39 and len(toxicity.features("w" * 5000)[0]) == 33
    flat.ordinary.clear()
    assert flat.disguised("a1b plain a1b") == ["a1b"] and flat.ordinary == {"plain"}


def test_one_sure_word_is_enough():
    rng = np.random.default_rng(4)
    y = np.r_[np.ones(100), np.zeros(900)]
    chance = np.sort(rng.choice([0.0, 1.1, 1.3], (1000, 3), p=[0.8, 0.1, 0.1]), axis=1)
    sure = np.where((y == 1)[:, None], np.c_[np.zeros((1000, 2)), np.full(1000, 3.8)], 0.0)
    evidence = np.sort(np.maximum(chance, sure), axis=1)
    least, slopes, offset = toxicity.calibrate(evidence, y, 0.1)
    model = toxicity.Model(np.zeros((28, 28, 28)), {"bad": 90}, {}, 100, 900, least, slopes, offset)
    scorer = toxicity.Scorer(model)
    assert scorer.score("such a bad one") > 0.9 and scorer.score("") < 0.1


def test_learnt_scores(spark):
    rng = np.random.default_rng(2)
    plain = [f"word{c}{d}" .replace("0", "o") for c in "abcdefgh" for d in "klmnop"]
    rows, labels = [], []
    for i in range(400):
        w = list(rng.choice(plain, rng.integers(20, 200)))
        bad, junk = i % 5 == 0, i % 7 == 0
        if bad:
            w[3:3] = [["idiot", "1d1ot", "i d i o t", "idiiiot"][i // 5 % 4], "scum"]
        if junk:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, 0 if junk else 1, int(bad)))
    docs = documents(spark, rows)
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    every = documents(spark, [*rows, *[(1000 + (i or 0), t) for i, t in EDGE]])
    toxic = toxicity.score(every, toxicity.fit(docs, labels)).collect()
    mil = quality_mil.score(every, quality_mil.fit(docs, labels)).collect()
    rules = quality_rules.judge(every, quality_rules.fit(docs, labels)).collect()
    assert len(toxic) == len(mil) == len(rules) == len(rows) + len(EDGE)
    right = [r["predicted"] == int(r["doc_id"] % 5 == 0) for r in toxic if r["doc_id"] < 400 and r["held_out"]]
    assert np.mean(right) > 0.95
    right = [r["predicted"] == int(r["doc_id"] % 7 != 0) for r in mil if r["doc_id"] < 400 and r["held_out"]]
    assert np.mean(right) > 0.95
    kept = {r["doc_id"]: r["kept"] for r in rules if r["doc_id"] < 400 and not r["base_failed"]}
    assert np.mean([k == (i % 7 != 0) for i, k in kept.items()]) > 0.95
    none = labels.where("false")
    assert {r["predicted"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0}
    assert quality_mil.fit(docs, none) == 0.5 and quality_rules.fit(docs, none) is None
    assert quality_rules.judge(documents(spark, []), None).isEmpty()


def test_anomalies_of_every_statistic(spark):
    rng = np.random.default_rng(6)
    plain = ["".join(rng.choice(list("abcdefgh"), n)) for n in rng.integers(3, 9, 300)]
    text = lambda n: "".join(w + rng.choice([" ", "\n"], p=[0.9, 0.1]) for w in rng.choice(plain, n))
    rows = [(i, text(rng.integers(80, 300))) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    lines = "".join(text(12).replace("\n", " ") + "\nsame\n" for _ in range(300))
    odd = [lines, " ".join("abcdefgh"[i % 8] + "ab"[i // 8 % 2] for i in rng.integers(0, 16, 100))]
    odd += [" ".join("".join(rng.choice(list("abcdefgh"), 20)) for _ in range(100))]
    odd += [" ".join(w + ("|" if i % 4 == 0 else "") for i, w in enumerate(text(200).split()))]
    odd += [text(200).upper(), text(200).replace(" ", "! ")]
    judged = documents(spark, [*rows, *[(1000 + i, t) for i, t in enumerate(odd)]])
    forest = quality_rules.fit(documents(spark, rows), labels)
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.judge(judged, forest).collect()}
    assert [got[1000 + i] for i in range(len(odd))] == [(False, False)] * len(odd)
    assert np.mean([got[i][1] for i, _ in rows]) > 0.98


def test_samples_take_one_row_of_a_document(spark):
    docs = documents(spark, [(1, f"text {i}") for i in range(50)] + [(2, None), (2, None), (4, "b")])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(9)], "doc_id long, quality int, toxic int")
    assert quality_rules.labelled_sample(docs, labels, 100).count() == 3
    assert toxicity._sample_texts(docs, labels, 100).count() <= 3


def test_rule_statistics():
    rng = np.random.default_rng(3)
    texts = ["", " \n ", "a b\na b\n\nx#|y", "one " * 20]
    texts += [" ".join(rng.choice(["a", "bé", "c\n", "d"], 60)) for _ in range(30)]
    run = next(text_chunks(pa.array(texts)))[1]
    got = statistics(run)
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        marked = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked))
        assert tuple(got[c][i] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(1500, 24)).astype(np.float32)
    v[7] = v[6]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(2000, None), (2100, [0.0] * 24), (2200, [float("nan")] * 24), (2300, [None] * 24), (2400, [])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = neighbours.search_table(table).toPandas()
    assert set(got["query_id"]) == set(range(0, 1500, 100)) and not set(got["vec_id"]) & {i for i, _ in odd}
    hits, wide = 0, v.astype(float)
    for q, found in got.groupby("query_id"):
        d = np.sqrt(((wide - wide[q]) ** 2).sum(1))
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10]) & set(found["vec_id"]))
        assert np.allclose(found.sort_values("rank")["score"], np.sort(d[found["vec_id"]]))
    assert hits / len(got) >= 0.9
    assert neighbours.search_table(table.where("vec_id < 0")).isEmpty()


def test_neighbours_of_repeated_ids(spark):
    v = np.random.default_rng(5).normal(size=(300, 24)).astype(np.float32)
    near = [(i, x.tolist()) for i, x in enumerate(v)]
    one = min(range(1, 300), key=lambda i: float(((v[i] - v[0]) ** 2).sum()))
    far = [(one, (v[one] + 1).tolist())]
    schema = "vec_id long, embedding array<float>"
    once = spark.createDataFrame(near, schema)
    asked = once.where("vec_id = 0")
    want = neighbours.nearest(once, asked).collect()
    many = spark.createDataFrame(near * 2 + [near[one]] * 80 + far * 3, schema)
    assert len(want) == 10 and neighbours.nearest(many, asked).collect() == want


def test_licenses(spark):
    notice = license_scan.TEMPLATES["GPL-3.0"]
    rows = [*EDGE, (9, f"x\n{notice}\ny"), (10, notice.replace("3", "2")), (11, "a license to read"), (12, "z " * 2000 + notice)]
    got = {(r["doc_id"], r["license"]): (r["start"], r["end"]) for r in license_scan.scan(documents(spark, rows)).collect()}
    assert set(got) == {(9, "GPL-3.0"), (10, "GPL-2.0"), (12, "GPL-3.0")}
    a, b = got[9, "GPL-3.0"]
    assert f"x\n{notice}\ny"[a:b] == notice.rstrip(".")


def test_pipeline_stages(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    docs = documents(spark, [(i, f"text number{i} " + "word " * (i % 7) + "password=abcdefgh12") for i in range(40)])
    redacted = corpus_pipeline.redact_secrets(spark, docs, "")
    assert redacted.columns == docs.columns and redacted.where("contains(text, 'abcdefgh12')").isEmpty()
    mixed = corpus_pipeline.mix_sources(spark, redacted, "")
    assert mixed.columns == docs.columns and 30 <= mixed.count() <= 40
    assert set(corpus_pipeline.tokenize(spark, mixed, "").columns) == {"doc_id", "lang", "source", "n_tokens", "ids"}


def test_parity_bitmaps_never_differ_in_more_than_the_sets():
    rng = np.random.default_rng(5)
    pool = rng.integers(-(2**63), 2**63 - 1, 4000)
    for size in (0, 1, 40, 900, 3000):
        a, b = (np.unique(rng.choice(pool, size)) for _ in range(2))
        bits = [np.unpackbits(shingles.parity_bits(s).view(np.uint8)) for s in (a, b)]
        assert int((bits[0] != bits[1]).sum()) <= len(np.setxor1d(a, b))


def test_pairs_between_components_whatever_the_length(spark):
    rng = np.random.default_rng(6)
    texts = []
    for words in (60, 400, 1450, 2500):  # on both sides of the bitmap's reach
        base = [f"w{i}" for i in rng.integers(0, 10**6, words)]
        for changes in (0, 1, words // 60, words // 25, words // 6):
            copy = list(base)
            for at in rng.integers(0, words, changes):
                copy[at] = f"x{rng.integers(0, 10**9)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    whole = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    expected = {
        (a, b)
        for a in range(len(texts))
        for b in range(a + 1, len(texts))
        if 100 * len(whole[a] & whole[b]) >= 75 * len(whole[a] | whole[b])
    }
    prefixes = neardup.rare_postings(
        neardup.classes(neardup.document_sketches(docs)), neardup.SKETCH, neardup.LEAST_OVERLAP
    )
    sets = docs.mapInArrow(shingles.set_batches(5), shingles.SET_SCHEMA).withColumnRenamed("doc_id", "id")
    apart = spark.createDataFrame([], "id long, component long")
    pairs = neardup._verified(neardup._cross_pairs(prefixes, sets, apart, 75), sets, 75)
    assert expected and {tuple(r) for r in pairs.collect()} == expected


def found_licenses(text):
    scanner = license_scan.Scanner(license_scan.TEMPLATES.items())
    assert not text or re.search(license_scan.hint(license_scan.TEMPLATES.values()), text)
    return [(name, text[a:b]) for name, a, b, _, _ in scanner.scan(text)]


def test_licenses_across_lines_and_far_hints():
    bsd = license_scan.TEMPLATES["BSD-3-Clause"].replace("without ", "without\n * ").replace("that ", "that\n * ")
    assert found_licenses(f"some words\n * {bsd}\nmore words") == [("BSD-3-Clause", bsd.rstrip("."))]
    for text, name in [
        ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0", "MPL-2.0"),
        ("Licensed under the Apache License,\nVersion 2.0", "Apache-2.0"),
    ]:
        assert found_licenses(f"# a\n# {text}.\n# b") == [(name, text)]
    gpl = license_scan.TEMPLATES["GPL-3.0"].rstrip(".")
    for gap in range(300, 700, 7):  # a hint before the notice, on one long line
        assert found_licenses("word " * 400 + "license " + "x " * (gap // 2) + gpl + " word" * 400) == [("GPL-3.0", gpl)]


def test_licenses_all_of_a_list():
    every = [(n, t.rstrip(".")) for n, t in license_scan.TEMPLATES.items()]
    for lines in (every, every[::-1], every * 3, every[:1] * 40):
        assert found_licenses("\n".join(t for _, t in lines)) == lines
        assert found_licenses(" and ".join(t for _, t in lines)) == lines


def test_licenses_usual_wordings(spark):
    every = license_scan.wordings()
    scanner, pattern = license_scan.Scanner(every), license_scan.hint(t for _, t in every)
    find = lambda text: [(f[0], f[4]) for f in scanner.scan(text)]
    assert {"MIT", "GPL-3.0", "BSD-2-Clause", "ISC", "Unlicense", "LGPL-2.1", "EPL-2.0"} <= {n for n, _ in every}
    for name, text in every:
        wrapped = re.sub(r"((?:\S+\s+){9})", r"\1\n# ", text)
        assert re.search(pattern, wrapped) and find(f"any words\n# {wrapped}\nother words") == [(name, 0)]
    header = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
    header += " Public License as published by the Free Software Foundation; either version 3, or any later version."
    assert [n for n, _ in find(header)] == ["GPL-3.0"]
    tags = "// SPDX-License-Identifier: (MIT OR Apache-2.0)\n# SPDX-License-Identifier: GPL-2.0+ WITH Classpath-exception-2.0\nx"
    got = [(r["license"], tags[r["start"] : r["end"]]) for r in license_scan.scan(documents(spark, [(1, tags)])).collect()]
    assert got == [("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2.0")]


def damaged(rng, words, lost):
    """The words without some of them, which tell no license from another."""
    plain = [k for k, w in enumerate(words) if not license_scan.TELLING.search(w)]
    gone = set(rng.choice(plain, min(lost, len(plain)), replace=False)) if lost else set()
    return [w for k, w in enumerate(words) if k not in gone]


def short_wordings():
    return [(n, t) for n, t in license_scan.wordings() if len(license_scan.words(t)) <= 512]


def license_texts():
    """Texts that hold one to three notices, whole or with words missing, among other words."""
    rng = np.random.default_rng(12)
    filler = "stone river walks under market seven paper lamp software copyright window house license".split()
    short = short_wordings()
    for i in range(40):
        parts = list(rng.choice(filler, rng.integers(0, 60)))
        for k in rng.choice(len(short), rng.integers(1, 4)):
            words = [w for w, _, _ in license_scan.words(short[k][1])]
            parts += damaged(rng, words, int(0.1 * len(words)) if i % 2 else 0)
            parts += list(rng.choice(filler, rng.integers(3, 60)))
        yield " ".join(parts)


def all_compared(scanner, text):
    """Every template compared with the whole text, the fewest differences first."""
    words = license_scan.words(text)
    coded = np.array([scanner.numbers.get(w, -1) for w, _, _ in words], np.int64)
    block, found = [w for w, _, _ in words], []
    for i, (name, _) in enumerate(scanner.templates):
        found += [(2 * d - same, name, a, b) for same, d, a, b in scanner.compare(block, coded, i)]
    return sorted((a, b, name) for _, name, a, b in license_scan.apart(found))


def test_licenses_like_all_comparisons():
    scanner = license_scan.Scanner(short_wordings())
    for text in license_texts():
        at = {p: k for k, w in enumerate(license_scan.words(text)) for p in w[1:]}
        got = sorted((at[a], at[b] + 1, name) for name, a, b, *_ in scanner.scan(text))
        assert got == all_compared(scanner, text), text


def test_licenses_come_through_compression(monkeypatch):
    scanner = license_scan.Scanner(short_wordings())
    texts = list(license_texts())
    right = [list(scanner.scan(t)) for t in texts]
    assert all(right)
    reductions = license_scan.Scanner.reductions
    rng = np.random.default_rng(1)

    def shuffled(self, block, among):
        ranked = reductions(self, block, among)
        return list(zip([saved for saved, _ in ranked], rng.permutation([i for _, i in ranked]).tolist()))

    for other in (shuffled, lambda self, block, among: [(0, i) for i in among]):
        monkeypatch.setattr(license_scan.Scanner, "reductions", other)
        assert [list(scanner.scan(t)) for t in texts] != right


def test_licenses_of_a_full_text_and_none():
    every = license_scan.wordings()
    scanner = license_scan.Scanner(every)
    name, text = max(every, key=lambda t: len(t[1]))
    (found,) = [f for f in scanner.scan("before it\n" + text + "\nafter it") if f[2] - f[1] > len(text) // 2]
    assert found[0] == name and found[3] > 0.9 and found[4] == 0
    assert list(scanner.scan("")) == list(scanner.scan("a license of no kind " * 500)) == []


def test_rules_are_fitted_on_every_labelled_document(spark):
    """Ranges and threshold are the quantiles of all good documents, and each goes into some tree."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    plain = ["".join(rng.choice(list("abcdefgh"), n)) for n in rng.integers(2, 12, 400)]
    texts = [" ".join(rng.choice(plain, 30)) + "!" * int(rng.integers(0, 9)) for _ in range(6500)]
    rows = [*enumerate(texts), (3, texts[3]), (9000, "short"), (None, texts[0])]
    labels = [(i, int(i % 9 != 0), 0) for i in [*range(6500), 9000, 5]] + [(None, 1, 0), (7, None, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    forest = quality_rules.fit(docs, labels)
    x = quality_rules.features(quality_rules.statistics(pa.array(texts, pa.large_string())))
    good = x[np.arange(len(x)) % 9 != 0]
    ends = np.quantile(good, (quality_rules.OUTER, 0.5, 1 - quality_rules.OUTER), axis=0)
    assert np.allclose([forest.ranges.low, forest.ranges.middle, forest.ranges.high], ends, rtol=1e-12, atol=0)
    scores = forest.scores(forest.ranges.excess(good))
    assert forest.threshold == np.quantile(scores, 1 - quality_rules.GOOD_LOST, method="higher")
    held = quality_rules.labelled_features(docs, labels)
    dealt = quality_rules._deal(held, forest.ranges, 16).toPandas()
    assert held.count() == 6500 and len(dealt) == 16 * 6500 and dealt["tree"].nunique() == quality_rules.TREES
    again = quality_rules.fit(docs.repartition(5), labels)
    assert again.threshold == forest.threshold and np.array_equal(again.cut, forest.cut)


def test_quantiles_by_brute_force(spark):
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 5, 300) / 4, rng.normal(size=301), np.zeros(7), np.array([2.0])]
    values = spark.createDataFrame([(f, float(v)) for f, c in enumerate(columns) for v in c], "f int, v double")
    shares = (0.0, 0.004, 0.3, 0.5, 0.996, 1.0)
    got, higher = quality_rules.quantiles(values, shares), quality_rules.quantiles(values, shares, higher=True)
    for f, c in enumerate(columns):
        assert np.allclose(got[f], np.quantile(c, shares), rtol=1e-12, atol=1e-15)
        assert higher[f] == list(np.quantile(c, shares, method="higher"))
    assert quality_rules.quantiles(values.where("false"), shares) == {}
