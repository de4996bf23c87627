"""Documents packed into training sequences of one length by best-fit decreasing.

Each document becomes its token ids and an end id.  What fills whole windows is cut
off first; the rest of every document, shorter than a window, is dealt by a hash of
its key over shards of about SHARD_PIECES rests, and a shard's rests come sorted by
falling length.  A segment tree over the remaining capacities 0 .. window counts the
open windows of each; it finds the tightest one that a rest fits into, or says that
a new window is needed.  The rests stream through a task, which holds the tree and
the numbers of its open windows, never their content.

The rows returned hold the ids themselves (``ids``: unsigned 32-bit, little-endian),
so joining a sequence's rows by ``offset`` gives the sequence; ``sequences`` does so.

Defined results: null and empty texts hold the end id only; rests of one length are
placed in the order of key, start and ids, so repeated rows and ties give the same
sequences in every run; a text of any length is cut window by window; an empty table
gives no rows; other columns of the table are not read, whatever their names.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, staged, table, utf8
from .tokens import Encoder, _kept

TOKENIZER, END_ID, WINDOW = "byte_bpe_50k.json", 0, 1024
#: Rests that are packed together: enough that few windows stay open at the end.
SHARD_PIECES = 1 << 15

PIECES = "doc_id long, start long, doc_tokens long, length int, ids binary"
PACKED = "doc_id long, start long, doc_tokens long, length int, ids binary, sequence_id long, offset long"


class Capacities:
    """Segment tree over remaining capacities: how many open windows have each."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += n
            node >>= 1

    def tightest(self, need: int) -> int:
        """The least capacity >= ``need`` that an open window has, or -1."""
        count, node = self.count, self.leaves + need
        if count[node]:
            return need
        while node > 1:
            if not node & 1 and count[node + 1]:  # a left child: all to its right is larger
                node += 1
                while node < self.leaves:
                    node = 2 * node if count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return -1


class BestFit:
    """Open windows of one shard; ``place`` takes the rests by falling length."""

    def __init__(self, window: int):
        self.window, self.windows = window, 0
        self.tree, self.open = Capacities(window), [[] for _ in range(window + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """(window, offset in it) for a rest of ``length`` ids."""
        capacity = self.tree.tightest(length)
        if capacity < 0:
            number, capacity = self.windows, self.window
            self.windows += 1
        else:
            number = self.open[capacity].pop()
            self.tree.add(capacity, -1)
        left = capacity - length
        if left:
            self.open[left].append(number)
            self.tree.add(left, 1)
        return number, self.window - capacity


def _binaries(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Adjoining runs of ``ids`` as little-endian binaries (starts[i + 1] == ends[i])."""
    offsets = np.r_[starts, ends[-1:]].astype(np.int64) * 4
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())]).cast(pa.binary())


def pieces(df: DataFrame, tokenizer: str, end: int = END_ID, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's whole windows and its rest (PIECES), in the order of its ids."""
    json = Path(tokenizer).read_text()
    shared = df.sparkSession.sparkContext.broadcast(json)
    name = f"encoder_{zlib.crc32(json.encode()):x}_{end}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(name, lambda: Encoder(shared.value, end))
        for b in slices(batches, "text"):
            ids, lengths = encoder.encode(*utf8(b.column("text")))
            lengths = lengths.astype(np.int64)
            n = -(-lengths // window)
            doc = np.repeat(np.arange(len(lengths)), n)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
            size = np.minimum(lengths[doc] - start, window)
            stop = np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(doc)), pa.array(start), pa.array(lengths[doc]), pa.array(size.astype(np.int32)), _binaries(ids, stop - size, stop)],
                ["doc_id", "start", "doc_tokens", "length", "ids"])

    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, PIECES)


def pack(df: DataFrame, tokenizer: str | None = None, end: int = END_ID, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents with their places in the sequences (PACKED)."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    cut = staged(pieces(df, str(tokenizer), end, window, key, text), "pieces")
    full = cut.where(F.col("length") == window)
    rests = cut.where(F.col("length") < window)
    shards = max(1, -(-rests.count() // SHARD_PIECES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, fit = None, None
        for b in batches:
            at, places = b.column("shard").to_pylist(), np.zeros((b.num_rows, 2), np.int64)
            for i, (own, length) in enumerate(zip(at, b.column("length").to_pylist(), strict=True)):
                if own != shard:
                    shard, fit = own, BestFit(window)
                number, offset = fit.place(length)
                places[i] = own << 33 | number, offset
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "start", "doc_tokens", "length", "ids")], pa.array(places[:, 0]), pa.array(places[:, 1])],
                                             ["doc_id", "start", "doc_tokens", "length", "ids", "sequence_id", "offset"])

    dealt = rests.withColumn("shard", F.pmod(F.xxhash64("doc_id", "ids"), F.lit(shards)))
    packed = (dealt.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("length"), "doc_id", "start", "ids")
              .mapInArrow(run, PACKED))
    # whole windows are sequences of their own; bit 32 keeps their numbers apart from the shards'
    whole = full.withColumn("sequence_id", _numbers()).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(whole)


def _numbers():
    """Unique numbers of the whole windows: partition << 33, bit 32, place in the partition."""
    return F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 32))


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, length, ids (binary, joined by offset), docs
    (doc_id, start and length of each piece); at most a window of rows meet in a group."""
    part = F.struct("offset", "doc_id", "start", "length", "ids")
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return rows.select(
        "sequence_id", F.expr("aggregate(parts, 0, (n, p) -> n + p.length)").alias("length"),
        F.expr("aggregate(parts, cast('' as binary), (all, p) -> concat(all, p.ids))").alias("ids"),
        F.expr("transform(parts, p -> struct(p.doc_id AS doc_id, p.start AS start, p.length AS length))").alias("docs"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
