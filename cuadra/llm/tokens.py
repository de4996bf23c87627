"""Token ids of documents as wavelet matrices, one compressed file per shard.

Documents are range-partitioned by id; each task encodes its part in order and
writes files of about SHARD tokens into a folder that all executors share.  A
file holds the ids and lengths of its documents and, for each SEGMENT of the
token stream, a wavelet matrix: one bit-plane per bit of the vocabulary with a
rank directory.  Token access, counting and occurrence lookup read the planes;
reading a whole shard back undoes the planes' stable partitions.

A file is written under a name of its own attempt and then renamed; its content
depends on the rows alone, so a repeated task leaves the same files.

Defined results: null and empty texts hold the end id only; rows are ordered by
id (null first) and text, so repeated rows stand side by side; a text longer
than a shard makes a longer shard; an empty table leaves no files and no rows;
other columns are not read.
"""

from __future__ import annotations

import json as _json
import os
import struct
import sys
import types
import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuadra.session import qualified

from .common import shared_dir, slices, staged, table, utf8

MAGIC = b"WAVEMTX1"
#: Tokens of a file, and of a wavelet matrix in it (small enough for a CPU cache).
SHARD, SEGMENT = 1 << 22, 1 << 18
#: Bytes of a plane between two entries of its rank directory.
STRIDE = 64
#: Pieces whose ids a worker keeps, and new ones that the library gets at once.
CACHE, TOGETHER = 300_000, 1 << 14


class WaveletMatrix:
    """Planes from the highest bit down; each plane's rows are those of the
    plane above, zeros first, both in order."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray] | None = None):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.ranks = ranks or [self._directory(p) for p in planes]

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(np.concatenate([plane, np.zeros(-len(plane) % STRIDE, np.uint8)])).reshape(-1, STRIDE)
        return np.concatenate([[0], np.cumsum(ones.sum(1, dtype=np.int64))]).astype(np.uint32)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        now, planes, zeros = ids, [], []
        for bit in range(bits - 1, -1, -1):
            one = (now & now.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(one, bitorder="little"))
            low, high = np.flatnonzero(~one), np.flatnonzero(one)
            zeros.append(len(low))
            after = np.empty_like(now)
            np.take(now, low, out=after[:len(low)])
            np.take(now, high, out=after[len(low):])
            now = after
        return cls(len(ids), planes, zeros)

    def tokens(self) -> np.ndarray:
        """All ids: the partitions undone from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for bit, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1], strict=True)):
            one = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            before = np.empty_like(now)
            before[np.flatnonzero(~one)] = now[:zeros]
            before[np.flatnonzero(one)] = now[zeros:] | kind(1 << bit)
            now = before
        return now

    def rank1(self, plane: int, i: int) -> int:
        """Ones among the first i bits."""
        block = i // (8 * STRIDE)
        part = self.planes[plane][block * STRIDE:i // 8]
        out = int(self.ranks[plane][block]) + int(np.bitwise_count(part).sum())
        return out + (int(self.planes[plane][i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else out

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero."""
        ranks = self.ranks[plane].astype(np.int64)
        counts = ranks if bit else np.arange(len(ranks)) * 8 * STRIDE - ranks
        block = int(np.searchsorted(counts, k, side="right")) - 1
        bits = np.unpackbits(self.planes[plane][block * STRIDE:(block + 1) * STRIDE], bitorder="little")
        return block * 8 * STRIDE + int(np.flatnonzero(bits == bit)[k - int(counts[block])])

    def access(self, i: int) -> int:
        out = 0
        for k in range(len(self.planes)):
            one = int(self.planes[k][i // 8]) >> i % 8 & 1
            ones = self.rank1(k, i)
            i = self.zeros[k] + ones if one else i - ones
            out = out << 1 | one
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for k in range(len(self.planes)):
            a, b = self.rank1(k, lo), self.rank1(k, hi)
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if token >> (len(self.planes) - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences in [lo, hi)."""
        if token >> len(self.planes):
            return 0
        lo, hi = self._range(token, lo, self.n if hi is None else hi)
        return hi - lo

    def occurrence(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence; -1 if there are fewer."""
        if token >> len(self.planes) or k >= self.count(token):
            return -1
        at = self._range(token, 0, self.n)[0] + k
        for plane in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - plane) & 1
            at = self._select(plane, one, at - self.zeros[plane] if one else at)
        return at


def shard_bytes(ids: np.ndarray, doc_ids: list, lengths: np.ndarray, bits: int) -> bytes:
    """One file: header, documents, then each segment's planes and directories."""
    pack = zstandard.ZstdCompressor(level=1).compress
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [pack(known.tobytes()), pack(np.array([d or 0 for d in doc_ids], "<i8").tobytes()), pack(lengths.astype("<i8").tobytes())]
    for at in range(0, len(ids), SEGMENT):
        m = WaveletMatrix.build(ids[at:at + SEGMENT], bits)
        parts.append(pack(b"".join([np.array(m.zeros, "<u4").tobytes(), *[p.tobytes() for p in m.planes], *[r.astype("<u4").tobytes() for r in m.ranks]])))
    head = struct.pack("<8sQQII", MAGIC, len(ids), len(doc_ids), bits, len(parts))
    return b"".join([head, np.array([len(p) for p in parts], "<u8").tobytes(), *parts])


class Shard:
    """Reads one file; planes are unpacked segment by segment."""

    def __init__(self, content: bytes):
        magic, self.n, docs, self.bits, parts = struct.unpack_from("<8sQQII", content)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        sizes = np.frombuffer(content, "<u8", parts, 32).astype(int)
        ends = 32 + 8 * parts + np.cumsum(sizes)
        self._part = lambda k: zstandard.ZstdDecompressor().decompress(content[ends[k] - sizes[k]:ends[k]])
        known = np.frombuffer(self._part(0), np.uint8)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(self._part(1), "<i8"), known, strict=True)]
        self.lengths = np.frombuffer(self._part(2), "<i8")
        self.segments = parts - 3

    def segment(self, k: int) -> WaveletMatrix:
        n = min(SEGMENT, self.n - k * SEGMENT)
        raw = np.frombuffer(self._part(3 + k), np.uint8)
        zeros, raw = raw[:4 * self.bits].view("<u4").tolist(), raw[4 * self.bits:]
        size = -(-n // 8)
        planes = [raw[i * size:(i + 1) * size] for i in range(self.bits)]
        ranks = raw[self.bits * size:].tobytes()
        return WaveletMatrix(n, planes, zeros, list(np.frombuffer(ranks, "<u4").reshape(self.bits, -1)))

    def tokens(self) -> Iterator[np.ndarray]:
        for k in range(self.segments):
            yield self.segment(k).tokens()

    def access(self, i: int) -> int:
        return self.segment(i // SEGMENT).access(i % SEGMENT)

    def count(self, token: int) -> int:
        return sum(self.segment(k).count(token) for k in range(self.segments))

    def occurrences(self, token: int) -> Iterator[int]:
        for k in range(self.segments):
            m = self.segment(k)
            for j in range(m.count(token)):
                yield k * SEGMENT + m.occurrence(token, j)


def _kept(name: str, make: Callable[[], object]) -> object:
    """An object that a worker process keeps between its tasks."""
    held = sys.modules.setdefault("_corpus_worker", types.ModuleType("_corpus_worker"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


#: The byte alphabet of byte-level models: a printable character for each byte.
ALPHABET = np.arange(256, dtype=np.uint32)
_HIDDEN = np.r_[0:33, 127:161, 173]
ALPHABET[_HIDDEN] = 256 + np.arange(len(_HIDDEN))


class Encoder:
    """The library's encoding with its byte-level pre-tokenisation done in numpy.

    Pieces of equal text have equal ids, so each distinct piece is given to the
    library once, many of them in one call: written in the model's byte alphabet, which
    has no line end, and split at line ends.  The lengths of the tokens tell the pieces apart.
    Texts that hold one of the tokenizer's added tokens or a
    code point that this Python does not know go to the library whole.
    """

    def __init__(self, json: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(json)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.kinds = np.full(0x110000, 255, np.uint8)
        self.flat, self.at, self.known, self.end = np.array([end], np.uint32), np.array([0, 1], np.int64), pa.array([], pa.binary()), end
        self.model, self.sizes = self._model(json)

    @staticmethod
    def _model(json: str) -> tuple[object, np.ndarray | None]:
        """(tokenizer of pieces that are written in the byte alphabet and split at line ends, bytes
        of each token), or None if the tokenizer does more than the byte-level steps."""
        from tokenizers import Tokenizer
        parts = _json.loads(json)
        model, level = parts["model"], parts.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or parts.get("normalizer") or level.get("type") != "ByteLevel" or level.get("add_prefix_space")
                or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))):
            return None, None
        sizes = np.zeros(max(model["vocab"].values(), default=0) + 1, np.int64)
        for token, i in model["vocab"].items():
            sizes[i] = len(token)
        own = {**parts, "added_tokens": [], "post_processor": None, "truncation": None, "padding": None, "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": "\n"}}
        return Tokenizer.from_str(_json.dumps(own)), sizes

    def _kinds(self, points: np.ndarray) -> np.ndarray:
        """1 letter, 2 number, 3 space, 0 other, 4 unassigned."""
        kinds = self.kinds[points]
        if (kinds == 255).any():
            for p in np.unique(points[kinds == 255]).tolist():
                name = unicodedata.category(chr(p))
                space = p in (9, 10, 11, 12, 13, 0x85) or name in ("Zs", "Zl", "Zp")
                self.kinds[p] = 3 if space else 4 if name == "Cn" else {"L": 1, "N": 2}.get(name[0], 0)
            kinds = self.kinds[points]
        return kinds

    def _ids_of(self, pieces: pa.Array) -> np.ndarray:
        """Place in ``at`` of each distinct piece."""
        if len(self.known) > CACHE:
            self.flat, self.at, self.known = self.flat[:1], self.at[:2], self.known[:0]
        where = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy().astype(np.int64) + 1
        new = np.flatnonzero(where == 0)
        if len(new):
            fresh = pieces.take(pa.array(new))
            got = [self._encoded(fresh.slice(i, TOGETHER)) for i in range(0, len(fresh), TOGETHER)]
            where[new] = len(self.known) + 1 + np.arange(len(new))
            self.flat = np.concatenate([self.flat, *[ids for ids, _ in got]])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.concatenate([n for _, n in got]))])
            self.known = pa.concat_arrays([self.known, fresh])
        return where

    def _encoded(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, how many each has) from the library."""
        if self.model is not None:
            raw, offsets = utf8(pieces)
            line = np.insert(ALPHABET[raw], offsets[1:-1], 10).astype("<u4").tobytes().decode("utf-32-le")
            ids = np.array(self.model.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(self.sizes[ids])
            last = np.searchsorted(ends, offsets[1:])
            if len(ends) and ends[-1] == offsets[-1] and (ends[last] == offsets[1:]).all():
                return ids, np.diff(last, prepend=-1)
        # a tokenizer of another kind, or bytes that its model leaves out: piece by piece
        got = [e.ids for e in self.library.encode_batch_fast([v.decode() for v in pieces.to_pylist()], add_special_tokens=False)]
        return np.fromiter((x for ids in got for x in ids), np.uint32), np.array([len(ids) for ids in got], np.int64)

    def _fast(self, raw: np.ndarray, offsets: np.ndarray, points: np.ndarray, kinds: np.ndarray, char_at: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(points)
        edge = np.zeros(n + 1, bool)
        edge[chars] = True
        first = edge[:-1].copy()
        first[1:] |= kinds[1:] != kinds[:-1]
        last = np.r_[first[1:], True] if n else first
        last |= edge[1:]
        space, blank = kinds == 3, points == 32
        after_blank = np.r_[False, blank[:-1]] & ~edge[:-1] if n else edge[:0]
        begins = np.where(space, first | (last & ~edge[1:]), first & ~after_blank)
        # 's 't 'm 'd 're 've 'll at the start of a piece end there
        quote = np.flatnonzero(begins & (points == 39) & last & ~edge[1:])
        if len(quote):
            inner = lambda k: np.where((quote + k < n) & ~edge[np.minimum(quote + k, n)], points[np.minimum(quote + k, n - 1)], 0)
            a = inner(1)
            b = np.where(a > 0, inner(2), 0)
            one, two = np.isin(a, [115, 116, 109, 100]), ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)
            begins[quote[one | two] + 1] = False
            follow = np.r_[quote[one] + 2, quote[two] + 3]
            follow = follow[follow < n]
            begins[follow] |= kinds[follow] == 1
        starts = np.flatnonzero(begins)
        cut = np.r_[char_at[starts], len(raw)].astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(raw.tobytes())]).dictionary_encode()
        where = self._ids_of(pieces.dictionary)[pieces.indices.to_numpy()]
        stop = np.searchsorted(starts, chars[1:])
        where = np.insert(where, stop, 0)
        size = self.at[where + 1] - self.at[where]
        out = np.repeat(self.at[where] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        stop = stop + np.arange(1, len(stop) + 1)
        return self.flat[out], np.diff(np.r_[0, np.cumsum(size)[stop - 1]])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; lengths)."""
        content = raw.tobytes()
        points = np.frombuffer(content.decode().encode("utf-32-le"), np.uint32)
        char_at = np.flatnonzero((raw & 0xC0) != 0x80)
        chars = np.searchsorted(char_at, offsets)
        kinds = self._kinds(points)
        slow = np.zeros(len(offsets) - 1, bool)
        slow[np.searchsorted(chars, np.flatnonzero(kinds == 4), side="right") - 1] = True
        for token in self.added:
            if token in content:
                slow |= [token in content[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        if not slow.any():
            return self._fast(raw, offsets, points, kinds, char_at, chars)
        ids, lengths = [], []
        for a, b, hard in zip(offsets[:-1], offsets[1:], slow, strict=True):
            if hard:
                own = np.array([*self.library.encode(content[a:b].decode(), add_special_tokens=False).ids, self.end], np.uint32)
                ids, lengths = [*ids, own], [*lengths, [len(own)]]
            else:
                own, n = self.encode(raw[a:b], np.array([0, b - a]))
                ids, lengths = [*ids, own], [*lengths, n]
        return np.concatenate(ids), np.concatenate(lengths)


MANIFEST = "part int, shard int, path string, n_docs long, n_tokens long, n_bytes long"


def write(df: DataFrame, folder: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shards of ``df`` into ``folder`` (a URI) and returns their MANIFEST."""
    json = Path(tokenizer).read_text()
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(json)
    name = f"encoder_{zlib.crc32(json.encode()):x}_{end}"
    # a folder without a scheme lies on the session's default file system, as for Spark's own writers
    folder = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(name, lambda: Encoder(shared.value, end))
        bits = max(16, int(encoder.library.get_vocab_size()).bit_length())
        kind = np.uint16 if bits <= 16 else np.uint32
        part, number = TaskContext.get().partitionId(), 0
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        ids, docs, lengths, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            content = shard_bytes(np.concatenate(ids), docs, np.concatenate(lengths), bits)
            path = f"{root}/part-{part:06d}-{number:06d}.wm"
            own = f"{root}/_{uuid.uuid4().hex}.tmp"
            with store.open_output_stream(own) as f:
                f.write(content)
            store.move(own, path)
            return pa.RecordBatch.from_pylist([{"part": part, "shard": number, "path": path, "n_docs": len(docs), "n_tokens": held, "n_bytes": len(content)}],
                                              pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))

        for b in slices(batches, "text"):
            own, n = encoder.encode(*utf8(b.column("text")))
            ids.append(own.astype(kind))
            lengths.append(n)
            docs += b.column("id").to_pylist()
            held += len(own)
            if held >= SHARD:
                yield flush()
                ids, docs, lengths, held, number = [], [], [], 0, number + 1
        if docs:
            yield flush()

    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return staged(rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(run, MANIFEST), "manifest")


def shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(folder).select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "content")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("file"), b.column("content"), strict=True):
                shard = Shard(content.as_py())
                ends = np.cumsum(shard.lengths)
                sums, doc, crc, at = [], 0, 0, 0
                for ids in shard.tokens():
                    raw, begin = ids.astype("<u4").tobytes(), at
                    while at < begin + len(ids):
                        stop = min(int(ends[doc]), begin + len(ids))
                        crc = zlib.crc32(raw[4 * (at - begin):4 * (stop - begin)], crc)
                        at = stop
                        if at == ends[doc]:
                            sums.append(crc)
                            doc, crc = doc + 1, 0
                n = len(sums)
                yield pa.RecordBatch.from_arrays([pa.array([file.as_py()] * n), pa.array(shard.doc_ids, pa.int64()), pa.array(ends - shard.lengths), pa.array(shard.lengths.astype(np.int64)), pa.array(sums, pa.int64())], ["file", "doc_id", "within", "n_tokens", "ids_crc32"])

    spark = manifest.sparkSession
    # starts: over the parts, then over the shards of a part
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    base = manifest.withColumn("within_part", within).join(parts, "part").select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), (F.col("before") + F.col("within_part")).alias("base"))
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    rows = shards(spark, folder).mapInArrow(run, "file string, doc_id long, within long, n_tokens long, ids_crc32 long")
    return rows.join(base, "file").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(file, place) of every occurrence of ``token``, by rank and select in the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("file"), b.column("content"), strict=True):
                at = list(Shard(content.as_py()).occurrences(token))
                yield pa.RecordBatch.from_arrays([pa.array([file.as_py()] * len(at), pa.string()), pa.array(at, pa.int64())], ["file", "place"])

    return shards(spark, folder).mapInArrow(run, "file string, place long")


TOKENIZER, END_ID = "byte_bpe_50k.json", 2


def tokenize(df: DataFrame, tokenizer: str | None = None, end: int = END_ID) -> DataFrame:
    """Writes the shards into the shared folder and reads them back."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path(TOKENIZER)
    folder = f"{shared_dir(df.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read(write(df, folder, str(tokenizer), end), folder)


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"))
