"""Collocations of each language by SON partitioning.

Words and pieces: texts are lower-cased (A-Z) and cut at ``. , ; : ! ?`` and line ends
into pieces, and those at blanks and tabs into words.  A phrase of 2 to LONGEST words
counts wherever it stands within a piece, overlaps included, language by language.

1. Words are counted exactly; they give each language's total n.
2. SON: the files of the corpus are dealt over SHARDS shards.  With a share p of a language's
   words a shard is mined for every phrase of frequent words that occurs at least
   ceil(support * p) times in it.  The shares add up to one, so a phrase below its local
   support in every shard is below the support in all.  A shard may be larger than any
   task: tasks count their part block by block, and the counts are added up by phrase and
   shard: those of two words, those of three whose pairs are frequent, and the longer ones
   whose threes are.  The more words, the more pairs reach a fixed support and the more threes
   consist of them, few of which are frequent: so threes, and then the longer ones, are first
   counted by hash bucket (PCY), and only those of buckets that reach the support are counted
   one by one.  From three words on a task adds up its blocks before it hands on rows.
   SHARDS is fixed, so the local support does not fall as the corpus grows.
3. The union of the locally frequent phrases are the candidates.  Their counts in all shards
   lie beside each other then, as a shard's counts are dealt by phrase, and give the exact
   global counts; candidates below the support go.
4. With each phrase comes a place that holds it, a document or, for two words, a shard; a last
   pass writes the phrases out from there.

What tasks look up (frequent words, frequent pairs, places of phrases) are Bloom filters
of 16 bits or more an entry and at most MOST_BITS (128 MB), the only things that are
broadcast.  What one lets through by mistake costs rows, never results.  Until their words
are written out phrases are told apart by hashes, of 64 bits for two words (among 10^9
different pairs two share one with a chance of 3 %) and of 88 bits for more.

Each cut of a phrase after its first k words has a score floor(1000 a n / (l r)) with a, l
and r the counts of the phrase and of its two parts; decimals of 38 digits hold the
products.  The lowest cut counts.  A phrase is dropped if a longer frequent phrase holds
it at ``share`` percent of its count or more; counts only fall with length, so one word
more on either side is all that need be compared.

A table that is read from files has the same shards in every pass, whatever its splits;
rows that come from no file are one shard.

Defined results: null and empty texts have no words; a null language is ``und``; repeated
rows count as often as they occur; equal scores are ordered by falling count, then by the
phrase's bytes; words are bytes but for A-Z, so any text is whole whatever its length; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BYTE_HASH, LOWER, mix, slices, span_hashes, staged, table, utf8

LONGEST, SUPPORT, SHARE, TOP = 5, 100, 100, 2000
#: Shards; words that a task counts at once (40 to 70 bytes each), bytes of text that it holds
#: at most, text bytes cut into words at once, and places handled at once.
SHARDS, BLOCK_WORDS, MOST_BYTES, SLICE, PLACES = 8, 1_000_000, 1 << 26, 1 << 20, 1 << 18
#: Rows of phrases that a task holds to add up its blocks (36 bytes each, four times that while they are added up).
HELD = 1 << 20
#: Bits of the broadcast filters: at least, a phrase, at most (128 MB).
LEAST_BITS, BITS_EACH, MOST_BITS = 1 << 20, 16, 1 << 30

# What ends a piece, and what stands between words.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
GAPS = np.zeros(256, bool)
GAPS[[0x20, 9]] = True
LEVEL, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Block:
    """Words of some texts of one shard in order: code (place in ``keys``, the block's distinct hashes of
    language and word), lang (place in ``langs``), linked (the next word follows in the same
    piece) and, if phrases are to be written out, the words' bytes."""

    def __init__(self, parts: list[tuple], langs: list[str], shard: int):
        def take(i: int, kind: type) -> np.ndarray:
            out = np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, kind)
            for k, p in enumerate(parts):  # each column is dropped as soon as it is joined
                parts[k] = (*p[:i], None, *p[i + 1:])
            return out

        self.langs, self.shard = langs, shard
        code, self.keys = pd.factorize(take(0, np.uint64))
        self.code = code.astype(np.int32)
        self.lang, self.linked = take(1, np.int16), take(2, bool)
        self.starts, self.ends, raw = take(3, np.int32), take(4, np.int32), take(5, np.uint8)
        self.content = raw.tobytes()
        self.doc, self.docs = take(6, np.int32), take(7, np.int64)

    def totals(self) -> dict[str, int]:
        return {v: int(c) for v, c in zip(self.langs, np.bincount(self.lang, minlength=len(self.langs)), strict=True)}

    def hashes(self, first: np.ndarray, length: int, by: np.uint64 = LEVEL) -> np.ndarray:
        """Hash of the phrases of ``length`` words that begin at these words."""
        out = self.keys[self.code[first]]
        for k in range(1, length):
            out = mix(out * by + self.keys[self.code[first + k]])
        return out

    def more(self, first: np.ndarray, length: int) -> np.ndarray:
        """24 further bits."""
        return (self.hashes(first, length, OTHER) & np.uint64(0xFFFFFF)).astype(np.int32)

    def phrases(self, first: np.ndarray, length: int) -> list[str]:
        """Those phrases with single spaces."""
        content, a, b = self.content, self.starts[first], self.ends[first + length - 1]
        made = [content[i:j].decode() for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        return [t if t.count(" ") == length - 1 and "\t" not in t else " ".join(filter(None, t.replace("\t", " ").split(" "))) for t in made] if length > 1 else made


def _words(raw: np.ndarray, offsets: np.ndarray, langs: list[str], docs: np.ndarray, place: dict[str, int], base: int, before: int, texts: bool) -> tuple:
    """The columns of ``Block`` for one slice of texts; ``place`` numbers the languages,
    ``base`` and ``before`` are the bytes and documents of the block so far."""
    raw = LOWER[raw]
    codes = np.array([place.setdefault(v, len(place)) for v in langs], np.int16)
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int16), np.zeros(0, bool), *[np.zeros(0, np.int32)] * 2, raw, np.zeros(0, np.int32), docs
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    inside = ~(ENDS | GAPS)[raw]
    starts = np.flatnonzero(inside & (edge[:-1] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (edge[1:] | np.r_[~inside[1:], True])) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.cumsum(ENDS[raw], dtype=np.int32)[starts]
    linked = np.zeros(len(starts), bool)
    linked[:-1] = (doc[1:] == doc[:-1]) & (breaks[1:] == breaks[:-1])
    lang = codes[doc]
    key = mix(span_hashes(BYTE_HASH[raw], starts, ends) + span_hashes(*_names(list(place)))[lang])
    own = (doc + before).astype(np.int32)
    if not texts:
        return key, lang, linked, *[np.zeros(0, np.int32)] * 2, raw[:0], own, docs
    return key, lang, linked, (starts + base).astype(np.int32), (ends + base).astype(np.int32), raw, own, docs


def _names(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arguments of ``span_hashes`` for short strings."""
    coded = [v.encode() + b"\x00" for v in values]
    ends = np.cumsum([len(c) for c in coded])
    return BYTE_HASH[np.frombuffer(b"".join(coded), np.uint8)], np.r_[0, ends[:-1]], ends


def blocks(batches: Iterator[pa.RecordBatch], limit: int, texts: bool = False) -> Iterator[Block]:
    """A task's texts in blocks of one shard and about ``limit`` words."""
    parts, words, sizes, rows, place, shard = [], 0, 0, 0, {}, None
    for b in slices(batches, "text", SLICE):
        own = b.column("shard").to_numpy()
        cuts = np.flatnonzero(np.diff(own)) + 1
        for begin, end in zip(np.r_[0, cuts], np.r_[cuts, len(own)]):
            if parts and (own[begin] != shard or words >= limit or sizes >= MOST_BYTES):
                yield Block(parts, list(place), shard)
                parts, words, sizes, rows, place = [], 0, 0, 0, {}
            shard, run = int(own[begin]), b.slice(int(begin), int(end - begin))
            parts.append(_words(*utf8(run.column("text")), run.column("lang").to_pylist(), run.column("doc").to_numpy(), place, sizes, rows, texts))
            words, sizes, rows = words + len(parts[-1][0]), sizes + len(parts[-1][5]), rows + run.num_rows
    if words:
        yield Block(parts, list(place), shard)


class Filter:
    """Bloom filter with two places for each 64-bit hash."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> np.ndarray:
        mask = np.uint64(bits - 1)
        return np.concatenate([hashes & mask, (hashes >> np.uint64(32)) & mask])

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        first, second = hashes & self.mask, (hashes >> np.uint64(32)) & self.mask
        out = np.ones(len(hashes), bool)
        for place in (first, second):
            out &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


#: Bits that one row of a filter's table holds.
CHUNK = 1 << 17


def _hash_column(b: pa.RecordBatch) -> np.ndarray:
    return b.column("h").to_numpy().view(np.uint64)


def bloom(rows: DataFrame, n: int, hashed: Callable[[pa.RecordBatch], np.ndarray] = _hash_column) -> np.ndarray:
    """Bytes of the filter of n rows' hashes: tasks set the bits of its chunks, and at most
    MOST_BITS reach the driver.  Rows are hashed where their bits are placed: a task of two
    Python steps would hold two workers."""
    bits = LEAST_BITS
    while bits < min(n * BITS_EACH, MOST_BITS):
        bits *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(Filter.places(hashed(b), bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // CHUNK), pa.array((at % CHUNK).astype(np.int32))], ["chunk", "bit"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            chunk, bit = b.column("chunk").to_numpy(), b.column("bit").to_numpy()
            for c in np.unique(chunk).tolist():
                held.setdefault(c, np.zeros(CHUNK, bool))[bit[chunk == c]] = True
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(v, bitorder="little").tobytes() for v in held.values()], pa.binary())], ["chunk", "content"])

    made = rows.mapInArrow(places, "chunk long, bit int").repartition("chunk").mapInArrow(chunks, "chunk long, content binary")
    out = np.zeros(bits // 8, np.uint8)
    for r in made.collect():
        out[r.chunk * CHUNK // 8:(r.chunk + 1) * CHUNK // 8] |= np.frombuffer(r.content, np.uint8)
    return out


#: Buckets that one row of bucket counts is of; a bucket holds a twelfth of the support on average, or less.
BUCKETS, FULL = 1 << 16, 12


def in_bucket(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def heavy_buckets(rows: DataFrame, counted: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]], n: int, support: int) -> np.ndarray:
    """One bit a bucket of hashes: whether the counts in it reach ``support`` together, as they
    do wherever one hash's do.  ``counted`` gives a task's (hashes, counts); n: their sum, at
    most.  A row holds the buckets of one chunk that occur, and at most MOST_BITS bits reach
    the driver."""
    most = BUCKETS
    while most < min(n * FULL // support, MOST_BITS):
        most *= 2

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, count in counted(batches):
            code, bucket = pd.factorize((hashes & np.uint64(most - 1)).view(np.int64), sort=True)
            total = np.bincount(code, weights=count, minlength=len(bucket)).astype(np.int64)
            chunk = bucket // BUCKETS
            cuts = np.r_[0, np.flatnonzero(np.diff(chunk)) + 1, len(chunk)] if len(chunk) else np.zeros(1, np.int64)
            parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[cuts[:-1]] if parts else [], pa.int64()), pa.array([(bucket[i:j] % BUCKETS).astype(np.uint16).tobytes() for i, j in parts], pa.binary()),
                 pa.array([total[i:j].astype(np.uint32).tobytes() for i, j in parts], pa.binary())], ["chunk", "bucket", "n"])

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, at, own in zip(*(b.column(c).to_pylist() for c in ("chunk", "bucket", "n")), strict=True):
                held.setdefault(chunk, np.zeros(BUCKETS, np.int64))[np.frombuffer(at, np.uint16)] += np.frombuffer(own, np.uint32)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([np.packbits(v >= support, bitorder="little").tobytes() for v in held.values()], pa.binary())], ["chunk", "content"])

    made = rows.mapInArrow(sums, "chunk long, bucket binary, n binary").repartition("chunk").mapInArrow(reached, "chunk long, content binary")
    out = np.zeros(most // 8, np.uint8)
    for r in made.collect():
        out[r.chunk * BUCKETS // 8:(r.chunk + 1) * BUCKETS // 8] = np.frombuffer(r.content, np.uint8)
    return out


def levels(block: Block, words: Filter, longest: int, passes: Callable[[np.ndarray, int], np.ndarray | None]) -> Iterator[tuple]:
    """(length, first place of each distinct phrase, its hash, its count) from two words up.

    A phrase's number is that of its first and its last words' phrase, which are one
    shorter, so equal numbers are equal phrases.  ``passes`` tells which phrases (hashes,
    length) count and may be part of longer ones; None: all."""
    number = np.where(words.holds(block.keys)[block.code], block.code, np.int32(-1))
    at = np.flatnonzero(number >= 0).astype(np.int32)
    for length in range(2, longest + 1):
        at = at[at < len(number) - 1]
        # beyond two words the two shorter phrases already lie in one piece
        at = at[(number[at + 1] >= 0) & (block.linked[at] if length == 2 else True)]
        may = [passes(block.hashes(at[i:i + PLACES], length), length) for i in range(0, len(at), PLACES)]
        if may and may[0] is not None:
            at = at[np.concatenate(may)]
        if not len(at):
            return
        pair = number[at].astype(np.int64)
        pair *= np.int64(number.max()) + 1
        pair += number[at + 1]
        code, distinct = pd.factorize(pair)
        del pair
        first = np.empty(len(distinct), np.int32)
        first[code[::-1]] = at[::-1]
        yield length, first, block.hashes(first, length), np.bincount(code, minlength=len(distinct))
        number[:] = -1
        number[at] = code


def added_up(rows: Iterator[list[np.ndarray]], held: int) -> Iterator[list[np.ndarray]]:
    """Rows (shard, h, n, least, x, place) with one of each shard and phrase: n added, the
    smallest place; about ``held`` rows are added up at a time."""
    parts: list[list[np.ndarray]] = []
    size = 0

    def merged() -> list[np.ndarray]:
        shard, h, n, least, x, place = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((place, x, h, shard))
        shard, h, x = shard[order], h[order], x[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (x[1:] != x[:-1]) | (shard[1:] != shard[:-1])])
        return [shard[first], h[first], np.add.reduceat(n[order], first), np.maximum.reduceat(least[order], first), x[first], place[order[first]]]

    for columns in rows:
        parts.append(columns)
        size += len(columns[0])
        if size >= held:
            parts = [merged()]
            size = len(parts[0][0])
            if 2 * size >= held:  # few recur
                yield parts[0]
                parts, size = [], 0
    if size:
        yield merged()


def salted(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hash of a phrase in one document or shard."""
    return mix(hashes + places.view(np.uint64) * LEVEL)


def key_of(langs: list[str], words: list[str]) -> np.ndarray:
    """The shards' key of each (language, word)."""
    place = {v: i for i, v in enumerate(dict.fromkeys(langs))}
    salts = span_hashes(*_names(list(place)))
    coded = [w.encode() for w in words]
    ends = np.cumsum([len(c) for c in coded])
    hashes = span_hashes(BYTE_HASH[np.frombuffer(b"".join(coded), np.uint8)], np.r_[0, ends[:-1]], ends)
    return mix(hashes + salts[np.array([place[v] for v in langs], np.int64)])


COUNTS = "lang string, length int, phrase string, n long"


def _rows(block: Block, found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """COUNTS rows of (length, first places, hashes, counts)."""
    names = np.array(block.langs, dtype=object)
    for length, first, _, count in found:
        for i in range(0, len(first), 1 << 16):
            at = first[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[block.lang[at]], pa.string()), pa.array(np.full(len(at), length, np.int32)), pa.array(block.phrases(at, length), pa.string()),
                 pa.array(count[i:i + (1 << 16)].astype(np.int64))], ["lang", "length", "phrase", "n"])


def frequent(df: DataFrame, longest: int = LONGEST, support: int = SUPPORT, shards: int = SHARDS, block_words: int = BLOCK_WORDS,
             text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, length, phrase, n) of every phrase of 1 to ``longest`` words that occurs
    ``support`` times in a language, and (lang, n) with all words of each language."""
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                      F.pmod(F.xxhash64(F.input_file_name()), F.lit(shards)).cast("int").alias("shard"), F.xxhash64(F.col(f"`{text}`"), F.col(f"`{lang}`")).alias("doc"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, block_words, True):
            first = np.empty(len(block.keys), np.int32)
            first[block.code[::-1]] = np.arange(len(block.code), dtype=np.int32)[::-1]
            yield from _rows(block, iter([(1, first, block.keys, np.bincount(block.code, minlength=len(first)))]))
            own = block.totals()  # length 0: the words of a language in a shard
            yield pa.RecordBatch.from_arrays([pa.array(list(own)), pa.array([0] * len(own), pa.int32()), pa.array([str(block.shard)] * len(own)), pa.array(list(own.values()), pa.int64())],
                                             ["lang", "length", "phrase", "n"])

    words = staged(texts.mapInArrow(count_words, COUNTS).groupBy("lang", "length", "phrase").agg(F.sum("n").alias("n")), "words")
    totals = staged(words.where("length = 0").groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "totals")
    often = words.where((F.col("length") == 1) & (F.col("n") >= support))
    # one row a language and shard
    n = {r.lang: r.n for r in totals.collect()}
    least = {(r.lang, int(r.phrase)): -(-support * r.n // n[r.lang]) for r in words.where("length = 0 AND n > 0").collect()}

    def hash_words(b: pa.RecordBatch) -> np.ndarray:
        return key_of(b.column("lang").to_pylist(), b.column("phrase").to_pylist()) if b.num_rows else np.zeros(0, np.uint64)

    def hash_places(b: pa.RecordBatch) -> np.ndarray:
        return salted(_hash_column(b), b.column("place").to_numpy())

    known = spark.sparkContext.broadcast(bloom(often.select("lang", "phrase"), often.count(), hash_words))

    def mined(name: str, shortest: int, last: int, passes: Callable[[np.ndarray, int], np.ndarray | None]) -> DataFrame:
        """(x, h, n, place) of the frequent phrases of ``shortest`` to ``last`` words: in some
        shard as often as its share asks, and ``support`` times in all.  place is where it can
        be read: one of its shards for pairs (their 64-bit hash tells them apart), else one of
        its documents (with 24 more bits, x)."""
        pairs = shortest == 2
        names = ["shard", "h", "n", "least", *([] if pairs else ["x", "place"])]

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
            for block in blocks(batches, block_words):
                asked = np.array([least.get((v, block.shard), 1) for v in block.langs], np.int32)
                for length, first, hashes, count in levels(block, Filter(known.value), last, passes):
                    for i in range(0, len(first) if length >= shortest else 0, 1 << 16):
                        part = slice(i, i + (1 << 16))
                        at = first[part]
                        columns = [np.full(len(at), block.shard, np.int32), hashes[part].view(np.int64), count[part].astype(np.int64), asked[block.lang[at]]]
                        if not pairs:
                            columns += [block.more(at, length), block.docs[block.doc[at]]]
                        yield columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = counted(batches)
            for columns in rows if pairs else added_up(rows, HELD):
                for i in range(0, len(columns[0]), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i:i + (1 << 16)]) for c in columns], names)

        rows = texts.mapInArrow(run, "shard int, h long, n long, least int" + ("" if pairs else ", x int, place long"))
        rows = rows.withColumn("x", F.lit(0)).withColumn("place", F.col("shard").cast("long")) if pairs else rows
        # a task's rows hold a phrase of a shard once or little more, so they are dealt as they are, all shards of a phrase together
        key = ["h"] if pairs else ["x", "h"]
        by_shard = rows.repartition(*key).groupBy(*key, "shard").agg(
            F.sum("n").alias("n"), F.max("least").alias("least"), F.min("x").alias("_x"), F.min("place").alias("place"))
        found = by_shard.groupBy(*key).agg(F.sum("n").alias("n"), F.bool_or(F.col("n") >= F.col("least")).alias("candidate"),
                                           F.min("_x").alias("_x"), F.min("place").alias("place"))
        return staged(found.where("candidate").where(F.col("n") >= support).select(F.col("_x").alias("x"), "h", "n", "place"), name)

    def heavy(shortest: int, last: int, passes: Callable[[np.ndarray, int], np.ndarray | None]) -> Broadcast:
        """``heavy_buckets`` of the phrases of ``shortest`` to ``last`` words."""
        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for block in blocks(batches, block_words):
                for length, _, hashes, count in levels(block, Filter(known.value), last, passes):
                    if length >= shortest:
                        yield hashes, count

        return spark.sparkContext.broadcast(heavy_buckets(texts, counted, (last - shortest + 1) * sum(n.values()), support))

    found = pairs = mined("pairs", 2, 2, lambda h, k: None)
    near = spark.sparkContext.broadcast(bloom(pairs.select("h"), pairs.count()))
    if longest > 2:  # phrases of three words from frequent pairs, longer ones from those
        pruned = lambda h, k: Filter(near.value).holds(h) if k == 2 else None
        threes = heavy(3, 3, pruned)
        triples = mined("triples", 3, 3, lambda h, k: pruned(h, k) if k == 2 else in_bucket(threes.value, h))
        found = pairs.unionByName(triples)
    if longest > 3:
        close = spark.sparkContext.broadcast(bloom(triples.select("h"), triples.count()))
        tests = {2: near, 3: close}
        shorter = lambda h, k: Filter(tests[k].value).holds(h) if k in tests else None
        more = heavy(4, longest, shorter)
        found = found.unionByName(mined("longer", 4, longest, lambda h, k: shorter(h, k) if k in tests else in_bucket(more.value, h)))
    where = spark.sparkContext.broadcast(bloom(found.select("h", "place"), found.count(), hash_places))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_known, pairs_known, places_known = Filter(known.value), Filter(near.value), Filter(where.value)
        for block in blocks(batches, block_words, True):
            names = np.array(block.langs, dtype=object)
            ok = words_known.holds(block.keys)[block.code]
            pair = np.flatnonzero(ok[:-1] & ok[1:] & block.linked[:-1]).astype(np.int32)
            pair = pair[np.concatenate([pairs_known.holds(block.hashes(pair[i:i + PLACES], 2)) for i in range(0, len(pair), PLACES)])] if len(pair) else pair
            begins = np.zeros(len(ok), bool)
            begins[pair] = True
            at = pair
            for length in range(2, longest + 1):
                if length > 2:  # the last two words are a frequent pair as well
                    at = at[at + length - 2 < len(begins)]
                    at = at[begins[at + length - 2]]
                for i in range(0, len(at), PLACES):
                    part = at[i:i + PLACES]
                    hashes = block.hashes(part, length)
                    places = block.docs[block.doc[part]] if length > 2 else np.full(len(part), block.shard, np.int64)
                    own = np.flatnonzero(places_known.holds(salted(hashes, places)))
                    if length == 2:  # of the pairs that stand in the shard, each once
                        own = own[np.unique(hashes[own], return_index=True)[1]]
                    part, hashes = part[own], hashes[own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[block.lang[part]], pa.string()), pa.array(np.full(len(part), length, np.int32)), pa.array(block.phrases(part, length), pa.string()),
                         pa.array(block.more(part, length) if length > 2 else np.zeros(len(part), np.int32)), pa.array(hashes.view(np.int64))], ["lang", "length", "phrase", "x", "h"])

    written = texts.mapInArrow(write, "lang string, length int, phrase string, x int, h long").distinct()
    named = written.join(found.select("x", "h", "n"), ["x", "h"]).select("lang", "length", "phrase", "n")
    return staged(often.unionByName(named), "phrases"), totals


def collocations(df: DataFrame, longest: int = LONGEST, support: int = SUPPORT, share: int = SHARE, top: int = TOP,
                 shards: int = SHARDS, block_words: int = BLOCK_WORDS, text: str = "text", lang: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    known, totals = frequent(df, longest, support, shards, block_words, text, lang)
    return scored(known, totals, share, top)


def scored(known: DataFrame, totals: DataFrame, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The ranking of ``collocations`` from counted phrases (lang, length, phrase, n) and
    the languages' totals (lang, n)."""
    found = known.where("length > 1").select("lang", "length", "phrase", F.col("n").alias("a"))
    shorter = F.explode(F.array(F.expr("substring_index(phrase, ' ', length - 1)"), F.expr("substring_index(phrase, ' ', 1 - length)")))
    longer = (found.where("length > 2").select("lang", shorter.alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("within")))
    kept = found.join(longer, ["lang", "phrase"], "left").where(
        F.col("within").isNull() | (F.col("within") * 100 < F.col("a") * share)).drop("within")
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("length") - 1))).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("left_part"), F.expr("substring_index(phrase, ' ', cut - length)").alias("right_part"))
    part = lambda name, out: known.select("lang", F.col("phrase").alias(name), F.col("n").alias(out))
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"({wide('1000 * a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
    rows = (cuts.join(part("left_part", "l"), ["lang", "left_part"]).join(part("right_part", "r"), ["lang", "right_part"])
            .join(totals, "lang").withColumn("score", score))
    lowest = rows.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (lowest.select("lang", "phrase", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), "n", F.col("low.score").alias("score"))
              .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """All phrases counted and compared in one statement, without shards."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS length, array_to_string(ws[i:i + {k - 1}], ' ') AS phrase FROM (SELECT lang, ws, unnest(generate_series(1, len(ws) - {k - 1})) AS i FROM pieces WHERE len(ws) >= {k})"
        for k in range(1, LONGEST + 1))
    cuts = "SELECT c.*, unnest(generate_series(1, length - 1)) AS cut FROM kept c"
    return f"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
           FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
known AS (SELECT lang, length, phrase, count(*) AS n FROM ({grams}) GROUP BY lang, length, phrase HAVING count(*) >= {SUPPORT}),
found AS (SELECT lang, length, phrase, n AS a, string_split(phrase, ' ') AS ws FROM known WHERE length > 1),
kept AS (SELECT * FROM found s WHERE NOT EXISTS (
    SELECT 1 FROM found q WHERE q.lang = s.lang AND q.length > s.length AND contains(' ' || q.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * q.a >= {SHARE} * s.a)),
cuts AS (SELECT lang, phrase, a, cut, array_to_string(ws[:cut], ' ') AS p1, array_to_string(ws[cut + 1:], ' ') AS p2 FROM ({cuts})),
scores AS (SELECT c.lang, c.phrase, c.a, c.cut, x.n AS l, y.n AS r, t.n,
                  ((1000::HUGEINT * c.a * t.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
           FROM cuts c JOIN known x ON x.lang = c.lang AND x.phrase = c.p1 JOIN known y ON y.lang = c.lang AND y.phrase = c.p2 JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM lowest)
SELECT * FROM ranked WHERE rank <= {TOP}"""
