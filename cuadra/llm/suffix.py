"""Repeated passages by run-length suffix indexes.

Every byte that a LENGTH-byte string covers goes, if that string also starts
anywhere else in the corpus.

Sharding: each window of LENGTH bytes is owned by its minimizer, the KEY-byte
string in it with the least hash (the first of equals).  Equal windows have equal
minimizers at equal places, so it is enough to compare, for each minimizer that
occurs twice, the segments around it: the windows that it owns.  Equal segments
are one row with a count, summed in each slice and again where they meet.

Index: each shard of segments gets a suffix array by prefix doubling, its
run-compressed Burrows-Wheeler transform and suffix samples at the runs' ends.
The longest match of each suffix elsewhere is streamed from the samples: it is
computed where a run starts or ends and falls by one from place to place in
between.  Matches of LENGTH bytes mark the windows.

A minimizer around which more than HOT different segments lie (a short common
line in ever different surroundings) does not fit one shard.  Its windows are
dealt anew, BLOCK by BLOCK, by the bytes that all windows of a block share; what
is still too common is counted window by window by 128-bit hash, exactly and
with partial sums.

Defined results: null and empty texts and texts under LENGTH bytes lose nothing;
texts are read whole, in overlapping parts of a task's slice; repeated rows are
occurrences like any other (rows of one doc_id with different texts are told
apart by a hash of both); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, BYTE_HASH, SLICE_BYTES, mix, slices, span_hashes, staged, table, utf8

LENGTH, KEY = 200, 64
#: Bytes that an index covers, and different segments of one minimizer in it.
SHARD_BYTES, HOT = 1 << 20, 2048
#: Windows that are dealt together by the bytes that they share.
BLOCK = 25
PLACE = np.uint64((1 << 22) - 1)
#: A place is start * WIDEST + windows.
WIDEST = 256


def key_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the KEY bytes at every place, by doubling."""
    now, power, size = BYTE_HASH[raw], BASE, 1
    while size < KEY:
        n = max(0, len(now) - size)
        now, power, size = now[:n] * power + now[size:size + n], power * power, size * 2
    return mix(now)


def owners(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(minimizer hash, first window, windows) of every run of windows with one
    minimizer, for each text in ``raw``."""
    width = LENGTH - KEY + 1
    windows = len(raw) - LENGTH + 1
    empty = np.zeros(0, np.int64)
    if windows <= 0:
        return np.zeros(0, np.uint64), empty, empty
    keys = key_hashes(raw)
    low = (keys & ~PLACE) | np.arange(len(keys), dtype=np.uint64)
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:len(low) - size], low[size:])
        size *= 2
    rest = width - size
    low = (np.minimum(low[:len(low) - rest], low[rest:]) if rest else low) & PLACE
    low = low.astype(np.int64)[:windows]
    inside = np.ones(windows + 1, bool)
    # windows that would leave their text
    for end in offsets[1:-1]:
        inside[max(0, end - LENGTH + 1):min(end, windows)] = False
    inside = inside[:windows]
    start = inside & np.r_[True, (low[1:] != low[:-1]) | ~inside[:-1]]
    first = np.flatnonzero(start)
    stop = np.flatnonzero(inside & np.r_[(low[1:] != low[:-1]) | ~inside[1:], True]) + 1
    return keys[low[first]], first, stop - first


def _parts(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, row, place of the part in its text): the texts of a
    slice, a text beyond SLICE_BYTES in parts that share LENGTH - 1 bytes."""
    raw, offsets = utf8(b.column("text"))
    if b.num_rows > 1 or len(raw) <= SLICE_BYTES:
        yield raw, offsets, np.arange(b.num_rows), np.zeros(b.num_rows, np.int64)
        return
    for at in range(0, len(raw), SLICE_BYTES):
        part = raw[at:at + SLICE_BYTES + LENGTH - 1]
        yield part, np.array([0, len(part)]), np.array([0]), np.array([at])


def _segments(batches: Iterator[pa.RecordBatch], bare: bool) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        for raw, offsets, row, place in _parts(b):
            keys, first, n = owners(raw, offsets)
            if bare:
                found, times = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], ["key", "n"])
                continue
            doc = np.searchsorted(offsets, first, side="right") - 1
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.view(np.int64)), b.column("row").take(pa.array(row[doc])),
                pa.array((first - offsets[doc] + place[doc]) * WIDEST + n)], ["key", "row", "place"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _segments(batches, True)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _segments(batches, False)


def suffix_array(text: np.ndarray, most: int) -> np.ndarray:
    """Suffix array of an int64 array by prefix doubling; suffixes differ within ``most``."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    # the first rounds at once: eight ranks in one key, if they fit
    h = 1
    order = np.argsort(rank, kind="stable")
    while True:
        later = np.zeros(n, np.int64)
        later[:n - h] = rank[h:] + 1
        key = rank * (rank.max() + 2) + later
        order = np.argsort(key, kind="stable")
        new = np.ones(n, np.int64)
        ordered = key[order]
        new[0] = 0
        new[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        h *= 2
        if rank[order[-1]] == n - 1 or h >= most:
            return order


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of segments, with the suffixes
    at the runs' ends, and the longest match of every suffix elsewhere."""

    def __init__(self, segments: list[bytes]):
        lengths = np.array([len(s) for s in segments])
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        inside = np.ones(len(text), bool)
        inside[self.starts + lengths] = False
        # a mark of its own behind each segment, below all bytes
        text[inside] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64) + len(segments)
        text[~inside] = np.arange(len(segments))
        order = suffix_array(text, int(lengths.max()) + 2)
        before = text[order - 1]
        head = np.r_[True, before[1:] != before[:-1]]
        self.heads = np.flatnonzero(head)
        self.symbols = before[self.heads]
        self.first = order[self.heads]
        ends = np.r_[self.heads[1:], len(order)] - 1
        self.last = order[ends]
        # only here are matches compared, in the suffix order's two directions
        up = self._common(text, order, self.heads[1:], -1)
        down = self._common(text, order, ends[:-1], 1)
        self.matches = np.maximum(self._streamed(len(text), self.first[1:], up), self._streamed(len(text), self.last[:-1], down))

    @staticmethod
    def _common(text: np.ndarray, order: np.ndarray, rows: np.ndarray, step: int) -> np.ndarray:
        """Common bytes of the suffix at each of ``rows`` and its neighbour."""
        a, b = order[rows], order[rows + step]
        out = np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        n = len(text)
        while len(live):
            x, y = a[live] + out[live], b[live] + out[live]
            ok = (x < n) & (y < n)
            ok[ok] = text[x[ok]] == text[y[ok]]
            live = live[ok]
            out[live] += 1
        return out

    @staticmethod
    def _streamed(n: int, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Between samples the match shrinks by the byte that was passed."""
        reach = np.zeros(n, np.int64)
        reach[places] = places + values
        return np.maximum(np.maximum.accumulate(reach) - np.arange(n), 0)

    def repeated(self, length: int) -> np.ndarray:
        """Whether the string of ``length`` at each place is also elsewhere."""
        return self.matches >= length


def covered(marked: np.ndarray, first: int = 0) -> list[tuple[int, int]]:
    """Byte runs that the marked windows cover."""
    at = np.flatnonzero(marked)
    if not len(at):
        return []
    gap = np.flatnonzero(np.diff(at) > LENGTH)
    return [(int(a) + first, int(z) + LENGTH + first) for a, z in zip(at[np.r_[0, gap + 1]], at[np.r_[gap, len(at) - 1]], strict=True)]


FOUND = "key long, seg long, spans array<struct<a:int,z:int>>, n long, content binary"
FOUND_ARROW = pa.schema([("key", pa.int64()), ("seg", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int32()), ("z", pa.int32())]))), ("n", pa.int64()), ("content", pa.binary())])


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated byte runs of each segment; rows are sorted by key.  Segments of
    a key with more than HOT of them come back whole, with no runs."""
    shard: list[tuple] = []
    size = 0
    out: list[dict] = []
    group: list[tuple] = []
    hot = False

    def searched(rows: list[tuple]) -> list[dict]:
        index = RunIndex([r[3] for r in rows])
        marked = index.repeated(LENGTH)
        for (key, seg, n, content), start in zip(rows, index.starts, strict=True):
            windows = len(content) - LENGTH + 1
            spans = covered(marked[start:start + windows] if n == 1 else np.ones(windows, bool))
            if spans:
                out.append({"key": key, "seg": seg, "spans": [{"a": a, "z": z} for a, z in spans]})
        return out

    def closed() -> None:
        nonlocal size
        if len(group) == 1 and group[0][2] > 1:  # copies alone need no index
            key, seg, _, content = group[0]
            out.append({"key": key, "seg": seg, "spans": [{"a": 0, "z": len(content)}]})
        elif len(group) > 1:
            shard.extend(group)
            size += sum(len(r[3]) + 1 for r in group)

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("key", "seg", "n", "content")), strict=True):
            if group and group[0][0] != row[0] or hot and key_now != row[0]:
                closed()
                group, hot = [], False
                if size > SHARD_BYTES:
                    searched(shard)
                    shard, size = [], 0
            key_now = row[0]
            group.append(row)
            if hot or len(group) > HOT:
                out += [{"key": k, "seg": g, "n": n, "content": c} for k, g, n, c in group]
                group, hot = [], True
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, FOUND_ARROW)
                out = []
    closed()
    if shard:
        searched(shard)
    yield pa.RecordBatch.from_pylist(out, FOUND_ARROW)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment's windows in blocks by their distance from the minimizer,
    keyed by the bytes that all windows of the block hold."""
    for b in slices(batches, "content", 1 << 19):
        raw, offsets = utf8(b.column("content"))
        keys, own = key_hashes(raw).view(np.int64), b.column("key").to_numpy()
        rows = []
        for i in range(b.num_rows):
            lo, hi = offsets[i], offsets[i + 1]
            windows = hi - lo - LENGTH + 1
            place = int(np.flatnonzero(keys[lo:lo + LENGTH - KEY + 1] == own[i])[0])
            far = place - np.arange(windows)  # falls by one from window to window
            for block in range(int(far[-1]) // BLOCK, int(far[0]) // BLOCK + 1):
                at = np.flatnonzero(far // BLOCK == block)
                rows.append((i, int(at[0]), lo + int(at[0]), lo + int(at[-1]) + LENGTH, lo + place - block * BLOCK, block))
        row, shift, start, end, common, block = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        values = mix(BYTE_HASH[raw])
        key = mix(span_hashes(values, common, common + LENGTH - BLOCK + 1) + (block + 1).astype(np.uint64) * BASE) ^ own[row].view(np.uint64)
        content = raw.tobytes()
        yield pa.RecordBatch.from_arrays([
            *(b.column(c).take(pa.array(row)) for c in ("key", "seg", "n")), pa.array(shift.astype(np.int32)), pa.array(key.view(np.int64)),
            pa.array(span_hashes(values, start, end).view(np.int64)), pa.array([content[x:y] for x, y in zip(start, end, strict=True)], pa.binary())],
            ["key", "seg", "n", "shift", "key2", "seg2", "content"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit hash of every window of hot segments."""
    for b in slices(batches, "content", 1 << 19):
        raw, offsets = utf8(b.column("content"))
        n = np.diff(offsets) - LENGTH + 1
        row = np.repeat(np.arange(b.num_rows), n)
        at = np.arange(len(row)) - (np.cumsum(n) - n)[row]
        start = offsets[:-1][row] + at
        hashes = [span_hashes(values, start, start + LENGTH) for values in (BYTE_HASH[raw], mix(BYTE_HASH[raw]))]
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)) for h in hashes] + [b.column(c).take(pa.array(row)) for c in ("key", "seg", "n")] + [pa.array(at.astype(np.int32))],
                                         ["w1", "w2", "key", "seg", "n", "at"])


def _cut(batches: Iterator[pa.RecordBatch], whole: bool = True) -> Iterator[pa.RecordBatch]:
    """The segments at the listed places of each text, with or without content."""
    for b in slices(batches, "text"):
        raw, offsets = utf8(b.column("text"))
        listed = b.column("places")
        row = np.repeat(np.arange(b.num_rows), np.diff(listed.offsets.to_numpy()))
        key, place = (listed.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(2))
        at, n = place // WIDEST, place % WIDEST
        start = offsets[:-1][row] + at
        end = start + n + LENGTH - 1
        fits = end <= offsets[1:][row]
        key, at, start, end, row = key[fits], at[fits], start[fits], end[fits], row[fits]
        seg = span_hashes(mix(BYTE_HASH[raw]), start, end).view(np.int64)
        if not whole:
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(row)), pa.array(at), pa.array(key), pa.array(seg)], ["row", "at", "key", "seg"])
            continue
        # equal segments of the slice are one row
        order = np.lexsort((seg, key))
        key, seg, start, end = key[order], seg[order], start[order], end[order]
        one = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])]) if len(key) else order
        times = np.diff(np.r_[one, len(key)])
        content = raw.tobytes()
        for lo in range(0, len(one), 8192):
            some = one[lo:lo + 8192]
            yield pa.RecordBatch.from_arrays([
                pa.array(key[some]), pa.array(seg[some]), pa.array(times[lo:lo + 8192]),
                pa.array([content[s:e] for s, e in zip(start[some], end[some], strict=True)], pa.binary())], ["key", "seg", "n", "content"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _cut(batches, False)


RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])
    for b in slices(batches, "text"):
        out = []
        for doc, text, spans in zip(b.column("id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist(), strict=True):
            text, at, parts, runs, end = text or b"", 0, [], 0, -1
            for s in sorted((s["a"], s["z"]) for s in spans or ()):
                if s[0] > end:
                    parts.append(text[at:s[0]])
                    runs += 1
                end = max(end, s[1])
                at = max(at, end)
            kept = b"".join([*parts, text[at:]])
            out.append({"id": doc, "n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": runs, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept})
        yield pa.RecordBatch.from_pylist(out, schema)


def _met(segments: DataFrame, name: str) -> DataFrame:
    """FOUND for (key, seg, n, content): rows of a key meet in one task, equal
    ones are summed there, and the task indexes them shard by shard."""
    one = segments.repartition("key").groupBy("key", "seg").agg(F.sum("n").alias("n"), F.first("content").alias("content"))
    return staged(one.sortWithinPartitions("key", "seg").mapInArrow(_indexed, FOUND), name)


def _spans(segments: DataFrame) -> DataFrame:
    """(key, seg, spans): the repeated byte runs of each segment."""
    found = _met(segments, "spans")
    blocks = staged(found.where("content is not null").select("key", "seg", "n", "content").mapInArrow(
        _blocks, "key long, seg long, n long, shift int, key2 long, seg2 long, content binary"), "blocks")
    finer = _met(blocks.select(F.col("key2").alias("key"), F.col("seg2").alias("seg"), "n", "content"), "finer")
    single = finer.where("content is not null").select("key", "seg", "n", "content").mapInArrow(_windows, "w1 long, w2 long, key long, seg long, n long, at int")
    twice = single.groupBy("w1", "w2").agg(F.sum("n").alias("times")).where("times > 1")
    single = single.join(twice, ["w1", "w2"]).select("key", "seg", F.array(F.struct(F.col("at").alias("a"), (F.col("at") + LENGTH).alias("z"))).alias("spans"))
    finer = finer.where("spans is not null").select("key", "seg", "spans").unionByName(single).select(
        F.col("key").alias("key2"), F.col("seg").alias("seg2"), "spans")
    back = blocks.select("key", "seg", "shift", "key2", "seg2").join(finer, ["key2", "seg2"]).select("key", "seg", F.transform(
        "spans", lambda x: F.struct((F.col("shift") + x["a"]).alias("a"), (F.col("shift") + x["z"]).alias("z"))).alias("spans"))
    return found.where("spans is not null").select("key", "seg", "spans").unionByName(back)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = True) -> DataFrame:
    """RESULT for each row of ``docs``; ``kept`` is what is left of the text.
    Without ``whole``, ``kept`` is null and untouched texts are not carried."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("id", "text"))
    often = rows.select("text").mapInArrow(_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    places = rows.select("row", "text").mapInArrow(_places, "key long, row long, place long").join(often, "key")
    listed = places.groupBy("row").agg(F.collect_list(F.struct("key", "place")).alias("places"))
    joined = rows.join(listed, "row", "left")
    untouched = F.col("places").isNull()
    texts = staged(joined.select(
        "row", "id", "places", F.octet_length("text").cast("long").alias("n_bytes"), F.when(untouched, F.sha2(F.col("text").cast("binary"), 256)).alias("sha"),
        F.when(~untouched | F.lit(whole), F.col("text")).alias("text")), "texts")
    some = texts.where("places is not null").select("row", "text", "places")
    spans = staged(_spans(some.mapInArrow(_cut, "key long, seg long, n long, content binary")), "runs")
    moved = F.transform("spans", lambda s: F.struct((F.col("at") + s["a"]).alias("a"), (F.col("at") + s["z"]).alias("z")))
    found = (some.mapInArrow(_named, "row long, at long, key long, seg long").join(spans, ["key", "seg"])
             .select("row", F.explode(moved).alias("s")).groupBy("row").agg(F.collect_list("s").alias("spans")))
    left = texts.where("places is not null").select("row", "id", "text").join(found, "row", "left").select("id", "text", "spans").mapInArrow(_kept, RESULT)
    zero = F.lit(0).cast("long")
    same = texts.where("places is null").select("id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"),
                                                F.col("text").cast("binary").alias("kept"))
    out = same.unionByName(left)
    return out if whole else out.withColumn("kept", F.lit(None).cast("binary"))


def op5_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), whole=False).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
