"""Near duplicates by a signature-coordinate inverted join.

Every distinct shingle set gets a MinHash signature of COORDINATES values and is
posted under its (coordinate, value) pairs.  Two sets of similarity 0.75 agree
in 48 of 64 pairs on average; MATCHES of them are asked for (missed once in
some 10^6 pairs that lie exactly on the limit, far more rarely above).  Pairs
are met by prefix and skip merging: each document orders its postings from the
rarest, and as two documents with MATCHES common postings share one among their
COORDINATES - MATCHES + 1 rarest, the longest lists of each are skipped.  Pairs
that reach MATCHES are confirmed on the full shingle sets.

Equal sets are one vertex, so copies are never paired.  In each posting list
the documents meet the list's smallest first.  Lists that still hold several
components then meet one of HUBS members picked by hash, which joins a large
group of copies that are not all copies of each other.  A last pass compares the
signatures of what is left apart in a list, block by block (the members of a long list's
largest component meet its other members, not each other), and passes on only
pairs that reach MATCHES and also agree in FINE_MATCHES of FINE further coordinates, of one
byte each, which only the documents of that pass get: a pair on the limit agrees in 577 of
them on average with a deviation of 12, and 517 are asked for (missed three times in 10^7),
which leaves out nearly all pairs below 65 %.  No list is gathered in one task, no pair inside a
component is ever formed, and none that could join two components is skipped
(sets whose sizes rule the similarity out are no such pair).

Defined results: null or empty text, or text without words, has no shingles and
is linked with nothing; fewer than five words are one shingle; texts are read
whole; an id that is repeated is one vertex; a null id takes part in no link and
has a null component; an empty table gives no rows; other columns pass through
``deduplicated`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, distinct_shingles, list_array, mix, slices, staged, table, utf8, words_of

WIDTH, SIMILARITY = 5, 75
COORDINATES, MATCHES = 64, 32
#: Different members that a list may be met with in the second pass.
HUBS = 6
#: Documents of a block in the last pass, and pairs that are compared at once.
BLOCK, PAIRS = 512, 50_000

#: One-byte coordinates of the documents that the last pass compares, and how many must agree.
FINE, FINE_MATCHES = 768, 517

_RNG = np.random.default_rng(11)
XOR = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TIMES = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) | np.uint64(1)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        sets, at = distinct_shingles(*words_of(*utf8(b.column("text"))), WIDTH)
        size = np.diff(at)
        full = np.flatnonzero(size)
        low = np.zeros((len(full), COORDINATES), np.uint64)
        key = np.zeros((b.num_rows, 2), np.uint64)
        if len(full):
            begin = at[:-1][full]
            for j in range(COORDINATES):
                low[:, j] = np.minimum.reduceat((sets ^ XOR[j]) * TIMES[j], begin)
            low = mix(low + np.arange(COORDINATES, dtype=np.uint64) * TIMES[0])  # the posting's key
            key[full, 0] = np.add.reduceat(mix(sets), begin)
            key[full, 1] = np.add.reduceat(mix(sets ^ XOR[0]), begin)
        offsets = np.zeros(b.num_rows + 1, np.int64)
        offsets[1:] = np.cumsum(size > 0) * COORDINATES
        yield pa.RecordBatch.from_arrays([
            b.column("id"), pa.array(size.astype(np.int64)), pa.array(key[:, 0].copy().view(np.int64)),
            pa.array(key[:, 1].copy().view(np.int64)), list_array(low.reshape(-1).view(np.int64), offsets, pa.int64())], ["id", "n", "k1", "k2", "postings"])


_FINE = np.random.default_rng(12).integers(0, 2**63, (FINE, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sign_finely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, fine): FINE coordinates of each text with words, one byte each."""
    for b in slices(batches, "text", 1 << 18):
        sets, at = distinct_shingles(*words_of(*utf8(b.column("text"))), WIDTH)
        full = np.flatnonzero(np.diff(at))
        fine = np.zeros((len(full), FINE), np.uint8)
        for j in range(FINE if len(full) else 0):
            low = np.minimum.reduceat((sets ^ _FINE[j, 0]) * _FINE[j, 1], at[:-1][full])
            fine[:, j] = (mix(low) >> np.uint64(56)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(full)), pa.array([r.tobytes() for r in fine], pa.binary())], ["id", "fine"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose texts' shingle sets reach the similarity."""
    for whole in batches:
        for b in slices(slices(iter([whole]), "text_a", 1 << 20), "text_b", 1 << 20):
            n = b.num_rows
            x, at = distinct_shingles(*words_of(*utf8(b.column("text_a"))), WIDTH)
            y, bt = distinct_shingles(*words_of(*utf8(b.column("text_b"))), WIDTH)
            row = np.r_[np.repeat(np.arange(n), np.diff(at)), np.repeat(np.arange(n), np.diff(bt))]
            both = np.r_[x, y]
            order = np.lexsort((both, row))
            both, row = both[order], row[order]
            same = np.bincount(row[1:][(both[1:] == both[:-1]) & (row[1:] == row[:-1])], minlength=n)
            union = np.diff(at) + np.diff(bt) - same
            keep = pa.array((100 * same >= SIMILARITY * union) & (same > 0))
            yield b.select(["a", "b"]).filter(keep)


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_similar, "a long, b long")


def _matched_in(b: pa.RecordBatch) -> pa.RecordBatch:
    """Pairs of different components within the groups (posting, low, high) of
    ``b`` that agree in MATCHES coordinates; rows of a group stand together."""
    posting, low, high, block, ids, comp, size = (b.column(c).to_numpy() for c in ("posting", "low", "high", "block", "id", "component", "n"))
    own, prefix = b.column("j").to_numpy(), b.column("prefix").to_numpy()
    sign = b.column("postings").flatten().to_numpy().reshape(-1, COORDINATES)
    fine = np.frombuffer(b"".join(b.column("fine").to_pylist()), np.uint8).reshape(-1, FINE)
    n = len(ids)
    new = np.r_[True, (posting[1:] != posting[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])]
    stop = np.r_[np.flatnonzero(new)[1:], n][np.cumsum(new) - 1]
    # each row with the later rows of its group, some rows at a time
    later = stop - np.arange(n) - 1
    found, at = [np.zeros((0, 2), np.int64)], 0
    total = np.cumsum(later)
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS)))
        i = np.repeat(np.arange(at, to), later[at:to])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later[at:to]) - later[at:to], later[at:to])
        some = (comp[i] != comp[j]) & ((low[i] == high[i]) | (block[i] != block[j]))
        some &= 100 * np.minimum(size[i], size[j]) >= SIMILARITY * np.maximum(size[i], size[j])
        i, j = i[some], j[some]
        same = sign[i] == sign[j]
        some = same.sum(1) >= MATCHES
        i, j, same = i[some], j[some], same[some]
        some = np.concatenate([(fine[i[a:a + 4096]] == fine[j[a:a + 4096]]).sum(1) >= FINE_MATCHES for a in range(0, len(i), 4096)] or [np.zeros(0, bool)])
        i, j, same = i[some], j[some], same[some]
        # a pair counts in the first list that both have in their prefixes
        shared = same & ((prefix[i] & prefix[j])[:, None] >> np.arange(COORDINATES) & 1).astype(bool)
        some = shared.argmax(1) == own[i]
        found.append(np.column_stack([np.minimum(ids[i[some]], ids[j[some]]), np.maximum(ids[i[some]], ids[j[some]])]))
        at = to
    out = np.concatenate(found)
    return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])


def _blocks_matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_matched_in`` over a sorted partition; a group that goes on in the next
    batch waits for it."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        last = [b.column(c).to_numpy() for c in ("posting", "low", "high")]
        own = np.flatnonzero(np.any([c != c[-1] for c in last], axis=0))
        cut = int(own[-1]) + 1 if len(own) else 0
        if held and (cut or any(held[-1].column(c)[-1].as_py() != b.column(c)[0].as_py() for c in ("posting", "low", "high"))):
            yield _matched_in(pa.concat_batches([*held, b.slice(0, cut)]))
            held = []
        elif cut:
            yield _matched_in(b.slice(0, cut))
        held.append(b.slice(cut))
    if held:
        yield _matched_in(pa.concat_batches(held))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component) of each row of ``docs``."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    signed = staged(rows.mapInArrow(_sign, "id long, n long, k1 long, k2 long, postings array<long>"), "signatures")
    real = signed.where("id is not null and n > 0")
    same = real.groupBy("k1", "k2", "n").agg(F.min("id").alias("vertex"))

    # postings that occur twice, of one document for each distinct set
    vertices = signed.join(same.select(F.col("vertex").alias("id")).distinct(), "id", "left_semi").where("n > 0").dropDuplicates(["id"])
    posted = vertices.select("id", F.posexplode("postings").alias("j", "posting"))
    often = posted.groupBy("posting").agg(F.count("*").alias("length")).where("length > 1")
    kept = posted.join(often, "posting").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("length", "posting", "j"))).alias("p"))
    # postings of one document alone are the rarest: they fill the prefix first
    prefix = COORDINATES - MATCHES + 1
    lists = staged(kept.withColumn("p", F.expr(f"slice(p, 1, greatest(0, size(p) - {COORDINATES - prefix}))")).where("size(p) > 0")
                   .select("id", F.expr("aggregate(p, 0L, (a, x) -> a | shiftleft(1L, x.j))").alias("prefix"), F.inline("p"))
                   .select("id", "prefix", "j", "posting"), "lists")

    sign = vertices.select("id", "n", "postings")
    texts = staged(rows.join(lists.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        return staged(_confirmed(pairs, texts), "links")

    def joined(parts: DataFrame, links: DataFrame) -> DataFrame:
        """Edges that connect as the classes so far and the new links do."""
        return parts.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(links)

    def apart(parts: DataFrame) -> DataFrame:
        """(posting, id, j, prefix, component, length, largest: rows and component of the largest one)
        of the lists that hold several components."""
        own = lists.join(parts, "id", "left").select("posting", "id", "j", "prefix", F.coalesce("component", "id").alias("component"))
        sizes = own.groupBy("posting", "component").agg(F.count("*").alias("n"))
        mixed = sizes.groupBy("posting").agg(F.sum("n").alias("length"), F.max(F.struct("n", "component")).alias("largest")).where("length > largest.n")
        return staged(own.join(mixed, "posting"), "apart")

    # each document with the smallest of its lists
    hubs = lists.groupBy("posting").agg(F.min("id").alias("a"))
    first = staged(_matched(lists.join(hubs, "posting").where("id <> a").select("a", F.col("id").alias("b")).distinct(), sign), "met")
    links = confirmed(first)

    # lists with several components: with a member picked by one of HUBS hashes
    parts = staged(components(links), "parts")
    rest = apart(parts)
    order = F.xxhash64("id", F.pmod("posting", F.lit(HUBS)))
    hubs = rest.groupBy("posting").agg(F.min_by(F.struct("id", "component"), order).alias("hub"))
    pairs = rest.join(hubs, "posting").where("component <> hub.component").select(
        F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
    second = staged(_matched(pairs.join(first, ["a", "b"], "left_anti"), sign), "met")
    parts = staged(components(joined(parts, confirmed(second))), "parts")

    # what is still apart, all pairs of a list by blocks
    rest = apart(parts)
    fine = staged(texts.join(rest.select("id").distinct(), "id", "left_semi").select("id", "text").mapInArrow(_sign_finely, "id long, fine binary"), "fine")
    compared = staged(sign.join(fine, "id"), "compared")
    third = (dealt(rest, BLOCK).join(compared, "id").repartition("posting", "low", "high").sortWithinPartitions("posting", "low", "high")
             .mapInArrow(_blocks_matched, "a long, b long")
             .join(first.unionByName(second), ["a", "b"], "left_anti"))
    parts = components(joined(parts, confirmed(staged(third, "met"))))

    vertex = same.join(parts.withColumnRenamed("id", "vertex"), "vertex", "left").select(
        F.col("k1").alias("c1"), F.col("k2").alias("c2"), F.col("n").alias("m"), F.coalesce("component", "vertex").alias("component"))
    found = signed.join(vertex, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n") == F.col("m")), "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("id"))).alias("component"))
    return staged(found, "classes")


def dealt(rest: DataFrame, block: int) -> DataFrame:
    """The rows of ``rest`` (posting, id, j, prefix, component, length, largest) in the pairs
    (low, high) of blocks that are compared.  In a list of several blocks the members of its largest
    component have blocks of their own, which meet those of the other members but not each other."""
    several = F.col("length") > block
    n = F.when(several, F.col("largest.n")).otherwise(F.lit(0))
    rows = (rest.withColumn("inside", several & (F.col("component") == F.col("largest.component")))
            .withColumn("own", F.ceil(n / block).cast("int")).withColumn("others", F.ceil((F.col("length") - n) / block).cast("int")))
    place = F.when(F.col("inside"), F.pmod(F.xxhash64("id"), "own")).otherwise(F.col("own") + F.pmod(F.xxhash64("id"), "others"))
    met = F.sequence(F.when(F.col("inside"), F.col("own")).otherwise(F.lit(0)), F.col("own") + F.col("others") - 1)
    return (rows.withColumn("block", place.cast("int")).withColumn("other", F.explode(met))
            .select("posting", "id", "j", "prefix", "component", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))


def _matched(pairs: DataFrame, sign: DataFrame) -> DataFrame:
    """Pairs that agree in MATCHES coordinates and whose sizes allow the similarity."""
    a = sign.select(F.col("id").alias("a"), F.col("n").alias("m"), F.col("postings").alias("s"))
    b = sign.select(F.col("id").alias("b"), "n", F.col("postings").alias("t"))
    sized = F.expr(f"100 * least(m, n) >= {SIMILARITY} * greatest(m, n)")
    return (pairs.join(b, "b").join(a, "a").where(sized)
            .where(F.size(F.array_intersect("s", "t")) >= MATCHES).select("a", "b"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class, the smallest id; rows with a null id stay."""
    leaders = classes(docs, key, text).where("id = component").select(F.col("id").alias("__leader")).distinct()
    one = docs.where(F.col(f"`{key}`").isNotNull()).join(leaders, F.col(f"`{key}`") == F.col("__leader"), "left_semi").dropDuplicates([key])
    return one.unionByName(docs.where(F.col(f"`{key}`").isNull()))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs).select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                                F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
