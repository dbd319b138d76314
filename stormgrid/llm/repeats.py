"""Repeated passages through common-prefix interval trees over enhanced suffix arrays.

Texts are cut into super-windows (``superwindows``): runs of 50-byte windows that share an anchor.
Equal windows lie in super-windows of equal anchors, so each anchor is a bucket of its own, with
three kinds of work, from the cheapest:

- a super-window that several documents hold in whole is a repeat of all of them, found from its
  hash while the rows of a bucket pass by in order;
- different super-windows of one bucket may share a part: the bytes of one of each are sorted
  into a suffix array with the lengths of common prefixes, and a stack scan lists the intervals
  of its tree. An interval whose members follow unlike bytes cannot be extended to the left: it
  is a maximal repeat, and its members are all the occurrences;
- a bucket with more different super-windows than one tree should hold is cut into single windows,
  each a bucket of its own. Anchors so common that their rows would outgrow a task's share are
  cut that way before the shuffle, and a window that is as common is folded before it and joined
  back by broadcast. A sample of the documents tells which these are; it decides where work is
  done, never which bytes go.

A repeat ends at the border of its super-window at the latest (80 bytes); longer ones come out as
groups that overlap, which the report joins to spans. Two different super-windows are taken as
equal with a chance of 2**-96 a pair, from 64 bits of hash beside 32 of the anchor. Texts that
share a doc_id are told apart by 27 bits of their hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stormgrid.llm.components import stored
from stormgrid.llm.superwindows import SuperWindows, hashes_of, super_windows, text_runs
from stormgrid.llm.textvec import text_chunks

LENGTH = 50
SAMPLE_EVERY = 64  # documents by a hash of their id; for the placing of common anchors only
TREE_BYTES = 1 << 20  # of super-windows that are sorted together, whole buckets at a time
TREE_PIECES = 50_000  # different super-windows of one bucket; fuller buckets are cut into windows
SORT_SUFFIXES = 1 << 16  # sorted at a time; those that begin alike stay together
HASHED_BYTES = 1 << 18  # of super-windows at a time
OUT_ROWS = 1 << 13  # of a batch of occurrences
DIVERSE = 256  # no byte: what stands to the left differs, or lies in another bucket

MARK_SCHEMA = "key int, digest long, doc_id long, pos long"
FOUND_SCHEMA = "key int, digest long, doc_id long, first boolean, contested boolean, pos array<long>"


# A place is one number: 27 bits that tell texts of one doc_id apart, 31 of start, 5 of windows - 1.
def _pack(variant, start, windows):
    return variant << 36 | start << 5 | (windows - 1)


def _variant_of(pos: Column) -> Column:
    return F.shiftright(pos, 36)


def _start_of(pos: Column) -> Column:
    return F.shiftright(pos, 5).bitwiseAND(F.lit((1 << 31) - 1))


def _windows_of(pos: Column) -> Column:
    return pos.bitwiseAND(F.lit(31)) + 1


def _texts(docs: DataFrame) -> DataFrame:
    variant = F.xxhash64("text").bitwiseAND(F.lit((1 << 27) - 1))
    return docs.select(F.col("doc_id").cast("long"), variant.alias("variant"), "text")


def _mark_batch(ids: np.ndarray, variants: np.ndarray, found: SuperWindows, text, base, split, length: int):
    """Marks of super-windows of texts ``text``, those in ``split`` as single windows; ``base`` is
    each one's place in its text."""
    times = np.where(split, found.windows, 1)
    step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    alone = np.repeat(split, times)
    key, digest = np.repeat(found.key, times), np.repeat(found.digest, times)
    key[alone], digest[alone] = found.single((np.repeat(found.start, times) + step)[alone], length)
    start = np.repeat(base, times) + np.where(alone, step, 0)
    windows = np.where(alone, 1, np.repeat(found.windows, times))
    text = np.repeat(text, times)
    return pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(digest), pa.array(ids[text]), pa.array(_pack(variants[text], start, windows))],
        names=["key", "digest", "doc_id", "pos"],
    )


def mark_batches(length: int, common: list[int]):
    """For mapInArrow over (doc_id, variant, text): the super-windows of each text, those with a
    common anchor as single windows."""
    apart = np.array(sorted(common), np.int32)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            variants = batch.column(1).to_numpy(zero_copy_only=False)
            for at, found in text_runs(batch.column(2), length):
                split = np.isin(found.key, apart)
                yield _mark_batch(ids, variants, found, at + found.text, found.place(), split, length)

    return run


def _marks(texts: DataFrame, length: int, common: list[int]) -> DataFrame:
    return texts.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        mark_batches(length, common), MARK_SCHEMA
    )


def _beyond_a_share(marks: DataFrame, column: str) -> list[int]:
    """Values that hold more than one shuffle partition's share of the rows: fewer than there are
    partitions."""
    share = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(marks.groupBy(column).agg(F.count("*").alias("n")), "shares")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r[0] for r in counts.where(F.col("n") * share > total).collect()]


# --- rows of a bucket in order ------------------------------------------------------------------


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Places at which any of the columns differs from the row before."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _judge(key, digest, doc, pos):
    """Rows of whole buckets in order as one batch: per super-window and document its places,
    whether the document is the smallest, and whether the bucket needs a tree."""
    rows = _changes(key, digest, doc, pos)  # a row of the input may be repeated
    key, digest, doc, pos = key[rows], digest[rows], doc[rows], pos[rows]
    held = _changes(key, digest, doc)
    sets = _changes(key, digest)
    buckets = _changes(key)
    smallest = doc[sets]
    set_of = np.searchsorted(sets, held, side="right") - 1
    first = doc[held] == smallest[set_of]
    set_bucket = np.searchsorted(buckets, sets, side="right") - 1
    starts = np.searchsorted(set_bucket, np.arange(len(buckets)))
    low, high = np.minimum.reduceat(smallest, starts), np.maximum.reduceat(smallest, starts)
    # super-windows of one document only cannot take anything from each other
    contested = (low < high)[set_bucket][set_of] & first
    keep = np.flatnonzero(~first | contested)
    lengths = np.diff(np.append(held, len(pos)))
    wanted = np.zeros(len(held), bool)
    wanted[keep] = True
    places = pos[np.repeat(wanted, lengths)]
    offsets = np.zeros(len(keep) + 1, np.int32)
    np.cumsum(lengths[keep], out=offsets[1:])
    at = held[keep]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key[at]),
            pa.array(digest[at]),
            pa.array(doc[at]),
            pa.array(first[keep]),
            pa.array(contested[keep]),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(places)),
        ],
        names=["key", "digest", "doc_id", "first", "contested", "pos"],
    )


def judge_batches(batches):
    """For mapInArrow over marks in order of key, digest, doc_id and pos. The last bucket of a batch
    waits for the next one; it is at most a task's share."""
    waiting = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if waiting is not None:
            columns = [np.concatenate(pair) for pair in zip(waiting, columns)]
        if not len(columns[0]):
            continue
        cut = int(np.searchsorted(columns[0], columns[0][-1]))
        if cut:
            yield _judge(*[c[:cut] for c in columns])
        waiting = [c[cut:] for c in columns]
    if waiting is not None:
        yield _judge(*waiting)


# --- the interval tree of some buckets ----------------------------------------------------------


def suffix_array(data: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Suffixes ``data[begin[i]:end[i]]`` in order, and the length of each one's common prefix with
    the one before it."""
    width = int((end - begin).max())
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[begin]
    rows[np.arange(width) >= (end - begin)[:, None]] = 0
    # the padding must not tell from zero bytes of the text: of such suffixes the shorter goes first
    by_size = np.argsort(end - begin, kind="stable")
    order = by_size[np.argsort(np.ascontiguousarray(rows[by_size]).view(f"S{width}").ravel(), kind="stable")]
    rows, size = rows[order], (end - begin)[order]
    common = np.zeros(len(order), np.int64)
    if len(order) > 1:
        unlike = rows[1:] != rows[:-1]
        # the padding is no text: a suffix ends where it ends
        same = np.where(unlike.any(1), unlike.argmax(1), width)
        common[1:] = np.minimum(same, np.minimum(size[1:], size[:-1]))
    return order, common


def intervals(common: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Maximal repeats as (length, first, last) in the suffix array, from the tree of its common
    prefixes. ``left`` is the byte before each suffix.

    One pass with a stack of the intervals still open; each gathers the left bytes of what closes
    inside it, and is reported if they differ.
    """
    found = []
    high = common >= least
    opens = np.flatnonzero(high & ~np.r_[False, high[:-1]])
    closes = np.flatnonzero(high & ~np.r_[high[1:], False])
    for one, two in zip(opens.tolist(), closes.tolist()):
        depths, before = common[one : two + 1].tolist() + [0], left[one - 1 : two + 1].tolist()
        stack: list[tuple[int, int, int]] = []  # (length, first, left byte)
        for place, depth in enumerate(depths):
            first, byte = place, before[place]
            while stack and stack[-1][0] > depth:
                size, first, held = stack.pop()
                byte = byte if byte == held else DIVERSE
                if byte == DIVERSE:
                    found.append((size, one - 1 + first, one - 1 + place))
            if depth < least:
                continue
            if stack and stack[-1][0] == depth:
                size, begin, held = stack.pop()
                stack.append((size, begin, byte if byte == held else DIVERSE))
            else:
                stack.append((depth, first, byte))
    return found


def _beginnings(data: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``data[b : b + length]`` for each ascending ``b``, some bytes at a time."""
    out = np.empty(len(begin), np.uint64)
    for at in range(0, len(data) - length + 1, HASHED_BYTES):
        low, high = np.searchsorted(begin, (at, at + HASHED_BYTES))
        (hashed,) = hashes_of(data[at : at + HASHED_BYTES + length - 1], (length,))
        out[low:high] = hashed[begin[low:high] - at]
    return out


def alike(data: np.ndarray, begin: np.ndarray, length: int):
    """Suffixes whose first ``length`` bytes another one begins with too, in parts of about
    ``SORT_SUFFIXES``. Equal beginnings have equal hashes, so they share a part; a chance collision
    only brings in a suffix that the sort sets apart."""
    hashed = _beginnings(data, begin, length)
    order = np.argsort(hashed, kind="stable")
    times = np.diff(np.append(_changes(hashed[order]), len(order)))
    order, times = order[np.repeat(times > 1, times)], times[times > 1]
    ends = np.cumsum(times)
    at = 0
    while at < len(order):
        # at least one beginning with all its suffixes
        after = int(np.searchsorted(ends, at, side="right"))
        upto = int(ends[max(after, np.searchsorted(ends, at + SORT_SUFFIXES, side="right") - 1)])
        yield np.sort(order[at:upto])
        at = upto


def repeats_by_part(pieces: list[bytes], length: int):
    """Maximal repeats of at least ``length`` bytes among different super-windows, as arrays
    (group, piece, offset, size), one row for each occurrence, part by part.

    A repeat lies among suffixes that begin alike, so the parts' trees are the whole one's, less the
    suffixes that repeat nothing. Groups are counted from 0 in each part.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum(sizes)
    windows = sizes - length + 1
    piece = np.repeat(np.arange(len(pieces)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = (ends - sizes)[piece] + offset
    for part in alike(data, begin, length):
        order, common = suffix_array(data, begin[part], ends[piece[part]])
        order = part[order]
        # the byte before a piece's first lies in another bucket, where the repeat goes on as another
        left = np.where(offset[order] > 0, data[begin[order] - 1].astype(np.int16), np.int16(DIVERSE))
        groups = np.array(intervals(common, left, length), np.int64).reshape(-1, 3)
        times = groups[:, 2] - groups[:, 1] + 1
        group = np.repeat(np.arange(len(groups)), times)
        member = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + groups[group, 1]
        suffix = order[member]
        yield group, piece[suffix], offset[suffix], groups[group, 0]


def maximal_repeats(pieces: list[bytes], length: int):
    """All parts of ``repeats_by_part`` as one."""
    none = np.zeros(0, np.int64)
    parts, n = [(none, none, none, none)], 0
    for group, *rest in repeats_by_part(pieces, length):
        parts.append((group + n, *rest))
        n += group.max() + 1 if len(group) else 0
    return tuple(map(np.concatenate, zip(*parts)))


def tree_batches(length: int):
    """For mapInArrow over (key, digest, doc_id, pos, piece) in order of key: every occurrence of
    every maximal repeat, with the smallest document of its group."""

    def answer(rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows).combine_chunks()
        pieces = table["piece"].to_pylist()
        held, docs = table.select(["key", "digest", "doc_id", "pos"]), table["doc_id"].to_numpy()
        for group, piece, offset, size in repeats_by_part(pieces, length):
            least = np.full(group.max() + 1 if len(group) else 0, np.iinfo(np.int64).max)
            np.minimum.at(least, group, docs[piece])
            _, heads = np.unique(group, return_index=True)
            names = [hashlib.blake2b(pieces[piece[h]][offset[h] :][: size[h]], digest_size=16).digest() for h in heads]
            for at in range(0, len(group), OUT_ROWS):
                some = slice(at, at + OUT_ROWS)
                taken = held.take(pa.array(piece[some]))
                found = [
                    pa.array(names, pa.binary()).take(pa.array(group[some])),
                    *map(pa.array, (least[group[some]], offset[some], size[some])),
                ]
                for name, column in zip(["group", "least_doc", "offset", "size"], found):
                    taken = taken.append_column(name, column)
                yield from taken.combine_chunks().to_batches()

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            ends = np.append(_changes(keys)[1:], len(keys)) if len(keys) else []
            begin = 0
            for end in ends:  # a bucket or the part of it in this batch
                if held >= TREE_BYTES and rows[-1].column(0)[-1].as_py() != keys[begin]:
                    yield from answer(rows)
                    rows, held = [], 0
                rows.append(batch.slice(begin, end - begin))
                held += rows[-1].column(4).nbytes
                begin = end
        if rows:
            yield from answer(rows)

    return run


TREE_SCHEMA = "key int, digest long, doc_id long, pos array<long>, group binary, least_doc long, offset long, size long"


def piece_batches(length: int):
    """For mapInArrow over (text, doc_id, wanted): the bytes of the wanted super-windows."""

    def run(batches):
        for batch in batches:
            texts, docs, wanted = (batch.column(i) for i in range(3))
            for i in range(len(batch)):
                data, rows = memoryview(texts[i].as_buffer()), wanted[i].values
                pos = rows.field("pos")
                first = pos.values.to_numpy()[pos.offsets.to_numpy()[:-1]]
                start, end = first >> 5 & (1 << 31) - 1, (first >> 5 & (1 << 31) - 1) + length + (first & 31)
                pieces = [bytes(data[a:b]) for a, b in zip(start.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.field("key"),
                        rows.field("digest"),
                        pa.array(np.full(len(rows), docs[i].as_py(), np.int64)),
                        pos,
                        pa.array(pieces, pa.binary()),
                    ],
                    names=["key", "digest", "doc_id", "pos", "piece"],
                )

    return run


PIECE_SCHEMA = "key int, digest long, doc_id long, pos array<long>, piece binary"


def window_batches(length: int):
    """For mapInArrow over (doc_id, pos, piece): marks of all single windows of each piece."""

    def run(batches):
        for batch in batches:
            ids, places = batch.column(0).to_numpy(), batch.column(1)
            held = batch.column(2).cast(pa.large_binary())
            # bytes cut from within characters: text by name only
            texts = pa.Array.from_buffers(pa.large_string(), len(held), held.buffers(), offset=held.offset)
            for at, part in text_chunks(texts):
                found = super_windows(part, length)
                # once for each place of the piece in its document's texts
                lists = places.slice(at, len(part))
                times = lists.value_lengths().to_numpy()
                offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                pos = lists.flatten().to_numpy()
                copies = times[found.text]
                which = np.repeat(np.arange(len(found.text)), copies)
                nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                place = pos[offsets[found.text[which]] + nth]
                many = found.taken(which)
                base = (place >> 5 & (1 << 31) - 1) + many.place()
                split = np.ones(len(which), bool)
                text = np.arange(len(which))
                yield _mark_batch(ids[at + many.text], place >> 36, many, text, base, split, length)

    return run


# --- all occurrences, and what they remove ------------------------------------------------------


def _judged(marks: DataFrame) -> DataFrame:
    ordered = marks.repartition("key").sortWithinPartitions("key", "digest", "doc_id", "pos")
    return ordered.mapInArrow(judge_batches, FOUND_SCHEMA)


def _found(texts: DataFrame, length: int, tree_pieces: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All marks, those that matter by document (``FOUND_SCHEMA``), and the occurrences that trees
    find (``TREE_SCHEMA``)."""
    sample = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_EVERY)) == 0)
    common = _beyond_a_share(_marks(sample, length, []), "key")
    marks = _marks(texts, length, common)
    hot = _beyond_a_share(_marks(sample, length, common), "digest") if common else []
    if hot:
        listed = F.broadcast(texts.sparkSession.createDataFrame([(h,) for h in hot], "digest long"))
        theirs = stored(marks.join(listed, "digest"), "hot-windows")
        least = F.broadcast(theirs.groupBy("key", "digest").agg(F.min("doc_id").alias("least")))
        folded = theirs.join(least, ["key", "digest"]).select(
            "key",
            "digest",
            "doc_id",
            (F.col("doc_id") == F.col("least")).alias("first"),
            F.lit(False).alias("contested"),
            F.array("pos").alias("pos"),
        )
        rest = marks.join(listed, "digest", "left_anti").select(*marks.columns)
        found = stored(_judged(rest).unionByName(folded), "found")
    else:
        found = stored(_judged(marks), "found")

    wanted = (
        found.where("contested")
        .groupBy("doc_id", _variant_of(F.col("pos")[0]).alias("variant"))
        .agg(F.collect_list(F.struct("key", "digest", "pos")).alias("wanted"))  # parts of one text
    )
    once = texts.dropDuplicates(["doc_id", "variant"])
    pieces = once.join(wanted, ["doc_id", "variant"]).select("text", "doc_id", "wanted")
    pieces = stored(pieces.mapInArrow(piece_batches(length), PIECE_SCHEMA), "pieces")
    full = stored(pieces.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > tree_pieces), "full-buckets")
    if not full.isEmpty():
        windows = pieces.join(full, "key", "left_semi").select("doc_id", "pos", "piece")
        windows = stored(windows.mapInArrow(window_batches(length), MARK_SCHEMA), "windows")
        # folded before the shuffle, and a join, which is split where one window stands for many rows
        least = windows.groupBy("key", "digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        later = windows.join(least.where("least < most"), ["key", "digest"]).where("doc_id > least")
        found = found.unionByName(
            later.select(
                "key",
                "digest",
                "doc_id",
                F.lit(False).alias("first"),
                F.lit(False).alias("contested"),
                F.array("pos").alias("pos"),
            )
        )
        pieces = pieces.join(full, "key", "left_anti").select(*pieces.columns)
    trees = pieces.repartition("key").sortWithinPartitions("key").mapInArrow(tree_batches(length), TREE_SCHEMA)
    return marks, found, stored(trees, "trees")


def repeat_groups(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Maximal repeats with all their occurrences: group_id, doc_id, start, size in bytes.

    A group lies within one super-window, and its id is made from hashes of its bytes. Groups of a
    single document (a passage repeated in one text only) are left out. Rows without a doc_id
    or a text take no part, and repeated rows are one document.
    """
    marks, found, trees = _found(_texts(docs), length, TREE_PIECES)
    shared = found.where("NOT first").select("key", "digest").distinct()
    place = F.col("pos")
    whole = marks.join(shared, ["key", "digest"], "left_semi").select(
        F.concat_ws(":", "key", "digest").alias("group_id"),
        "doc_id",
        _start_of(place).alias("start"),
        (_windows_of(place) + (length - 1)).alias("size"),
    )
    # a piece of a tree stands for all documents that hold its super-window
    members = trees.select("key", "digest", F.hex("group").alias("group_id"), "offset", "size").distinct()
    parts = marks.join(members, ["key", "digest"]).select(
        "group_id", "doc_id", (_start_of(place) + F.col("offset")).alias("start"), "size"
    )
    return whole.unionByName(parts).distinct()


def _removed(found: DataFrame, trees: DataFrame, length: int) -> DataFrame:
    """doc_id, variant and the bytes to remove of each text, as numbers of start << 32 | end."""

    def spans(rows: DataFrame, begin: Column, size: Column) -> DataFrame:
        span = F.shiftleft(begin, 32).bitwiseOR(begin + size)
        return rows.select("doc_id", _variant_of(F.col("place")).alias("variant"), span.alias("span"))

    place = F.col("place")
    whole = found.where("NOT first").select("doc_id", F.explode("pos").alias("place"))
    parts = trees.where("doc_id > least_doc").select("doc_id", F.explode("pos").alias("place"), "offset", "size")
    both = spans(whole, _start_of(place), _windows_of(place) + (length - 1)).unionByName(
        spans(parts, _start_of(place) + F.col("offset"), F.col("size"))
    )
    # a set of each text's own places, however often its row is repeated
    return both.groupBy("doc_id", "variant").agg(F.collect_set("span").alias("spans"))


def cut_batches(batches):
    """For mapInArrow over (doc_id, text, spans): the contract's figures of each text."""
    for batch in batches:
        ids, texts, lists = batch.column(0), batch.column(1), batch.column(2)
        for at, run in text_chunks(texts):
            totals, removed, runs, kept = [], [], [], []
            for i, text in enumerate(run):
                data, packed = text.as_buffer(), lists[at + i].values
                data = memoryview(data) if data is not None else memoryview(b"")
                digest, end, gone, count = hashlib.sha256(), 0, 0, 0
                if packed is not None and len(packed):
                    spans = np.sort(packed.to_numpy(zero_copy_only=False))
                    begins, ends = spans >> 32, np.maximum.accumulate(spans & (1 << 32) - 1)
                    new = np.flatnonzero(np.r_[True, begins[1:] > ends[:-1]])
                    last = np.append(new[1:], len(spans)) - 1
                    for b, e in zip(begins[new].tolist(), ends[last].tolist()):
                        digest.update(data[end:b])
                        gone, count, end = gone + e - b, count + 1, e
                digest.update(data[end:])
                totals.append(len(data))
                removed.append(gone)
                runs.append(count)
                kept.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, len(run)), *[pa.array(c, pa.int64()) for c in (totals, removed, runs)], pa.array(kept)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def repeated_bytes(docs: DataFrame, length: int = LENGTH, tree_pieces: int = TREE_PIECES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of (doc_id, text).

    A byte is removed where a string of ``length`` bytes covers it that also starts in a document
    with a smaller doc_id. A null text is empty. A row without a doc_id is returned whole, and
    nothing is removed on its account. Rows that repeat a doc_id are judged each by itself and
    take nothing from each other, equal or not. Texts of up to 2 GB.
    """
    texts = _texts(docs)
    _, found, trees = _found(texts, length, tree_pieces)
    spans = _removed(found, trees, length)
    joined = texts.join(spans, ["doc_id", "variant"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(cut_batches, schema)
