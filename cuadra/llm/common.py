"""Helpers shared by the operators: shared scratch folder, Arrow text access,
vectorised word hashing and distributed connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task handles at once (working arrays are about 30 times this).
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may do without it; it then gets /tmp/checkpoints.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file:///tmp/checkpoints"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: cuts the
    lineage with files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents_of(df: DataFrame, *columns: str) -> DataFrame:
    """Only the columns that an operator needs, whatever else the table holds."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` text bytes (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if len(lengths) > start:
            yield batch.slice(start)


_RNG = np.random.default_rng(20240229)
BYTE_HASH = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of a uint64 array (order matters)."""
    n = len(values)
    power = np.full(n, BASE)
    if n:
        power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power, out=total[1:])
    inverse = np.full(n + 1, np.uint64(pow(int(BASE), -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * MIX_2)


SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each row, with the end): words are
    maximal runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (edge[1:] | np.r_[~inside[1:], True])) + 1
    return span_hashes(BYTE_HASH[LOWER[raw]], starts, ends), np.searchsorted(starts, offsets)


def shingles_of(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row of each): every ``width``-word shingle; a row with fewer
    words has its whole sequence as one, a row without words has none."""
    count = np.diff(first)
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), n)
    begin = np.cumsum(n) - n
    start = first[:-1][row] + (np.arange(len(row)) - begin[row])
    end = np.minimum(start + width, first[1:][row])
    return span_hashes(words, start, end), row


def distinct_shingles(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles row by row, offsets of the rows)."""
    hashes, row = shingles_of(words, first, width)
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(first)))


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: long) as (id, component):
    each vertex with the smallest id that it reaches.

    Alternates large-star and small-star steps (each vertex hands its
    neighbours to its smallest one), so a path of n edges needs about log n
    rounds.  A hot vertex is summed in partial aggregates; its neighbours are
    never gathered.  Every round is staged in the shared folder.  No edges: no
    rows.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("v"), F.col("b").alias("u"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("v"), F.col("a").alias("u")))
        else:  # towards smaller ids only
            both = e.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        low = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m")).select(F.col("v").alias("w"), "m")
        joined = both.join(low, both.v == low.w)
        linked = joined.where((F.col("u") > F.col("v")) if large else F.lit(True)).select(F.col("u").alias("a"), F.col("m").alias("b"))
        if not large:
            linked = linked.unionByName(low.select(F.col("w").alias("a"), F.col("m").alias("b")))
        return linked.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        now = staged(star(star(now, True), False), "edges")
        said = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if tuple(said) == mark:
            break
        mark = tuple(said)
    else:
        raise RuntimeError("components did not settle")
    low = now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    return low.unionByName(low.select(F.col("component").alias("id"), "component").distinct())


def crc32_of(column: str) -> Column:
    """crc32 of an integer column's decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))

