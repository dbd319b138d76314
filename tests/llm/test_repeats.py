"""Repeated passages against brute force, planted cases and odd input."""

import collections
import hashlib
import random

import numpy as np
import pytest

from stormgrid.llm import queries, repeats

LENGTH = 50


@pytest.fixture(autouse=True)
def importable(spark):
    queries.importable(spark)


def documents(spark, rows):
    full = [(i, t, 7, "x", "y") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, key int, pos string, digest string")


def by_brute_force(rows):
    holders = collections.defaultdict(set)
    for i, text in rows:
        data = (text or "").encode()
        if i is not None:
            for a in range(len(data) - LENGTH + 1):
                holders[data[a : a + LENGTH]].add(i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        if i is not None:
            for a in range(len(data) - LENGTH + 1):
                if min(holders[data[a : a + LENGTH]]) < i:
                    gone[a : a + LENGTH] = True
        runs = int((gone[1:] < gone[:-1]).sum())
        kept = hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()
        out.append((i, len(data), int(gone.sum()), runs, kept))
    return sorted(out, key=str)


def rows_of(df):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def mixed_texts(seed, n=60):
    """Prose that shares passages of all lengths around the limit, runs of one byte, copies,
    near copies, characters of several bytes and zero bytes."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(40)]
    prose = lambda k: " ".join(rng.choices(words, k=k))
    shared = [prose(rng.randint(5, 40)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [prose(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            cut = rng.randrange(len(passage))
            parts += [passage[cut : cut + rng.randint(30, 120)], prose(rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", "", "\0"]).join(parts)))
    rows += [(n, "z" * 300), (n + 1, "z" * 120 + "y"), (n + 2, "ab" * 90), (n + 3, "ab" * 40 + "c")]
    rows += [(n + 4, rows[3][1]), (n + 5, rows[3][1][: len(rows[3][1]) // 2] + "!" + rows[3][1][20:])]
    rows += [(n + 6, None), (n + 6, ""), (None, rows[3][1]), (n + 7, "ä" * 40), (n + 8, "x" + "ä" * 40)]
    rows += [(2, rows[5][1]), (2, rows[5][1]), (-4, rows[7][1]), (n + 4, rows[3][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_by_brute_force(spark, seed):
    rows = mixed_texts(seed)
    assert rows_of(repeats.repeated_bytes(documents(spark, rows))) == by_brute_force(rows)


def test_full_buckets_and_common_anchors(spark, monkeypatch):
    """The ways around buckets that are too full give the same bytes."""
    rows = mixed_texts(3)
    want = by_brute_force(rows)
    assert rows_of(repeats.repeated_bytes(documents(spark, rows), tree_pieces=1)) == want
    monkeypatch.setattr(repeats, "SAMPLE_EVERY", 1)
    for of_keys, of_windows in ((2, 0), (1, 2)):

        def beyond(marks, column):
            step = of_keys if column == "key" else of_windows
            return sorted({r[0] for r in marks.select(column).collect()})[::step] if step else []

        monkeypatch.setattr(repeats, "_beyond_a_share", beyond)
        assert rows_of(repeats.repeated_bytes(documents(spark, rows))) == want


def test_common_line_in_a_third(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SAMPLE_EVERY", 1)
    rng = random.Random(5)
    line = "this line stands at the end of every third document of them all"
    rows = [(i, "".join(rng.choices("abcdefgh ", k=60)) + (line if i % 3 == 0 else "")) for i in range(300)]
    assert rows_of(repeats.repeated_bytes(documents(spark, rows))) == by_brute_force(rows)


def test_empty_table(spark):
    assert repeats.repeated_bytes(documents(spark, [])).collect() == []
    assert repeats.repeat_groups(documents(spark, [])).collect() == []


def test_long_text(spark):
    rng = random.Random(8)
    text = "".join(rng.choices("abcdefghij klmn", k=3_000_000))
    rows = [(1, text), (2, "start " + text[1_000_000:1_000_500] + " end")]
    got = {r["doc_id"]: r for r in repeats.repeated_bytes(documents(spark, rows)).collect()}
    assert (got[1]["n_removed"], got[2]["n_removed"], got[2]["n_spans"]) == (0, 500, 1)


def test_batches_that_end_within_a_bucket():
    """A bucket that reaches over several batches is judged once, with all its rows."""
    import pyarrow as pa

    names = ["key", "digest", "doc_id", "pos"]
    rows = [(1, 5, 7, 0), (2, 5, 1, 32), (2, 5, 4, 64), (2, 9, 3, 0), (2, 9, 3, 32), (3, 1, 1, 0)]

    def batch(some):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some)], names=names)

    def judged(parts):
        out = pa.Table.from_batches(list(repeats.judge_batches(iter(parts)))).to_pylist()
        return sorted(tuple(map(str, r.values())) for r in out)

    whole = judged([batch(rows)])
    assert whole == judged([batch([r]) for r in rows]) and len(whole) == 3


def test_intervals_by_brute_force():
    """Maximal repeats of some pieces against all pairs of their windows."""
    rng = random.Random(4)
    for _ in range(60):
        pieces = list({bytes(rng.choices(b"ab", k=rng.randint(4, 12))) for _ in range(5)})
        group, piece, offset, size = repeats.maximal_repeats(pieces, 4)
        got = collections.defaultdict(set)
        for g, p, o, s in zip(group, piece, offset, size):
            got[g].add((pieces[p][o : o + s], p, o))
        found = {next(iter(v))[0]: {(p, o) for _, p, o in v} for v in got.values()}
        assert all(len({t for t, _, _ in v}) == 1 for v in got.values())
        strings = {p[a:b] for p in pieces for a in range(len(p)) for b in range(a + 4, len(p) + 1)}
        want = {}
        for s in strings:
            at = {(i, a) for i, p in enumerate(pieces) for a in range(len(p) - len(s) + 1) if p[a : a + len(s)] == s}
            after = {pieces[i][a + len(s) : a + len(s) + 1] or (i, a) for i, a in at}
            before = {pieces[i][a - 1 : a] if a else "border" for i, a in at}
            if len(at) > 1 and len(after) > 1 and (len(before) > 1 or before == {"border"}):
                want[s] = at
        assert found == want


def test_groups_hold_all_occurrences(spark):
    rng = random.Random(6)
    prose = lambda k: "".join(rng.choices("abcdefghijklm ", k=k))
    passage = prose(64)
    rows = [(i, prose(40) + "ABCDE"[i] + passage + "ABCDE"[i] + prose(30)) for i in range(5)] + [(9, prose(200))]
    groups = repeats.repeat_groups(documents(spark, rows)).collect()
    texts = dict(rows)
    named = collections.defaultdict(set)
    for g in groups:
        piece = texts[g["doc_id"]].encode()[g["start"] : g["start"] + g["size"]]
        assert g["size"] >= LENGTH and piece in passage.encode()
        named[g["group_id"]].add((g["doc_id"], piece))
    assert all({i for i, _ in v} == set(range(5)) and len({p for _, p in v}) == 1 for v in named.values())
    covered = set()
    for g in groups:
        if g["doc_id"] == 0:
            covered |= set(range(g["start"], g["start"] + g["size"]))
    assert covered == set(range(41, 105))


def test_trees_hold_a_bounded_part_in_memory(monkeypatch):
    """Many suffixes are sorted part by part, with the repeats of one sort over all of them."""
    import tracemalloc

    rng = random.Random(5)
    stems = [bytes(rng.choices(b"abcdefgh", k=64)) for _ in range(400)]
    pieces = list({rng.choice(stems) + bytes(rng.choices(b"abcdefgh", k=16)) for _ in range(20_000)})

    def repeats_of(length):
        group, piece, offset, size = repeats.maximal_repeats(pieces, length)
        got = collections.defaultdict(set)
        for g, p, o in zip(group.tolist(), piece.tolist(), offset.tolist()):
            got[g].add((p, o))
        return sorted((int(size[i]), sorted(got[g])) for g, i in {g: i for i, g in enumerate(group.tolist())}.items())

    tracemalloc.start()
    for _ in repeats.repeats_by_part(pieces, 50):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80e6  # one sort of all 620,000 suffixes took 157e6
    parted = repeats_of(50)
    monkeypatch.setattr(repeats, "SORT_SUFFIXES", 1 << 40)
    assert parted == repeats_of(50)
