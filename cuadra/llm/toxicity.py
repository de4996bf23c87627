"""Toxicity by nearest labelled examples.

The classifier is fitted on a bounded sample of labelled rows: about EXAMPLES
rows by hash without near copies (rows of one MinHash value and label are one
example).  All their words are terms, weighted by TF-IDF and by how well they
tell the labels apart: the root of 1 + chi-square, one being what chance gives.
Each document's K nearest examples by exact cosine over these weights come from
a block-max inverted index: blocks of examples are visited by falling upper
bound until no block can hold a better one.  Terms of many examples are held as
dense rows, block by block, the others as postings.  The neighbours' votes, weighted
by distance and shrunk to the share of label 1 where all are far, are calibrated on the
examples, each scored without itself by the tasks that hold it; the driver sees one vote
an example.  The sample goes to the tasks as plain arrays, from which each worker builds
its index once.

Defined results: null and empty texts, and texts without a word of any example,
get the share of label 1 among the examples without words; without labelled rows
the score is 0; ties between examples go to the smaller id; texts are read
whole; repeated rows are scored one by one; a null label is no label; several
labels of one id count as several examples; other columns pass through untouched, but
``out`` must be a new name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_HASH, LOWER, crc32_of, list_array, shingles_of, slices, span_hashes, staged, table, utf8, words_of
from .tokens import _kept

#: Bound of the fitted sample.
EXAMPLES = 4000
#: Neighbours that vote; examples in a block of the index, blocks visited at once; terms of
#: one example in COMMON or more are held as dense rows; texts searched together.
K, BLOCK, GROUP, COMMON, TOGETHER = 15, 64, 8, 16, 64
THRESHOLD = 0.7

#: Bytes of words: ASCII letters and digits, and all of other scripts.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def terms_of(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of every text."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.r_[True, ~inside[:-1]]))
    ends = np.flatnonzero(inside & (edge[1:] | np.r_[~inside[1:], True])) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    return span_hashes(BYTE_HASH[LOWER[raw]], starts, ends), row


def counted(words: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words row by row, their counts, offsets of the rows)."""
    order = np.lexsort((words, row))
    words, row = words[order], row[order]
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return words[at], np.diff(np.r_[at, len(words)]), np.searchsorted(row[at], np.arange(rows + 1))


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each range in turn."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


class Index:
    """Block-max inverted index over unit vectors of the examples: of each term
    the cells (blocks that hold it, with its largest weight there), of each cell
    the postings."""

    def __init__(self, ids: list, labels: list, terms: list, counts: list, vocabulary: np.ndarray):
        order = sorted(range(len(ids)), key=lambda i: (len(terms[i]) == 0, ids[i], labels[i]))
        self.vocabulary = np.sort(vocabulary)
        full = [i for i in order if len(terms[i])]
        self.ids = np.array([ids[i] for i in full], np.int64)
        self.labels = np.array([labels[i] for i in full], np.float64)
        bare = [labels[i] for i in order if not len(terms[i])]
        self.every = float(np.mean(labels)) if labels else 0.0
        self.bare = (sum(bare) + self.every) / (len(bare) + 1)
        n, v = len(full), len(self.vocabulary)
        t = np.concatenate([np.searchsorted(self.vocabulary, terms[i]) for i in full]) if full else np.zeros(0, np.int64)
        d = np.repeat(np.arange(n), [len(terms[i]) for i in full])
        c = np.concatenate([counts[i] for i in full]) if full else np.zeros(0)
        self.df = np.bincount(t, minlength=v)
        with_1, ones = np.bincount(t, self.labels[d] if full else None, v), float(sum(labels))
        apart = with_1 * (len(ids) - ones) - (self.df - with_1) * ones
        chi2 = len(ids) * apart ** 2 / np.maximum(ones * (len(ids) - ones) * self.df * (len(ids) - self.df), 1)
        self.idf = (np.log((1 + len(ids)) / (1 + self.df)) + 1) * np.sqrt(1 + chi2)
        w = (1 + np.log(np.maximum(c, 1))) * self.idf[t] if full else np.zeros(0)
        w = w / np.sqrt(np.bincount(d, w * w, n))[d] if full else w
        self.blocks = -(-n // BLOCK)
        # terms of many examples: their weights in each block, and the largest of each block
        common = np.flatnonzero(self.df * COMMON > n)
        self.slot = np.full(v, -1, np.int32)
        self.slot[common] = np.arange(len(common))
        self.dense = np.zeros((self.blocks, len(common), BLOCK))
        own = self.slot[t]
        many = own >= 0
        self.dense[d[many] // BLOCK, own[many], d[many] % BLOCK] = w[many]
        self.dense_top = np.ascontiguousarray(self.dense.max(2).T) if n else np.zeros((len(common), 0))
        t, d, w = t[~many], d[~many], w[~many]
        order = np.lexsort((d, t))
        t, self.doc, self.weight = t[order], d[order].astype(np.int32), w[order]
        cell = t * self.blocks + self.doc // BLOCK
        at = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
        self.begin = np.r_[at, len(cell)].astype(np.int64)
        self.block = (self.doc[at] // BLOCK).astype(np.int32)
        self.top = np.maximum.reduceat(self.weight, at) if len(at) else np.zeros(0)
        self.ptr = np.searchsorted(t[at], np.arange(v + 1))
        self.levels = self.values = None

    def nearest(self, t: np.ndarray, c: np.ndarray, offsets: np.ndarray, without: np.ndarray | None = None, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of each query, nearest first, ties to the smaller id; -1 and 0
        where there are fewer.  Queries lie side by side (terms, counts, offsets); ``without``
        has an id for each that is left out."""
        n, rows = len(self.ids), len(offsets) - 1
        row = np.repeat(np.arange(rows), np.diff(offsets))
        q = (1 + np.log(c)) * self.idf[t]
        q = q / np.sqrt(np.bincount(row, q * q, rows))[row]
        many = self.slot[t] >= 0
        whole = np.zeros((rows, self.dense.shape[1]))
        whole[row[many], self.slot[t[many]]] = q[many]
        t, q, row = t[~many], q[~many], row[~many]
        size = self.ptr[t + 1] - self.ptr[t]
        cells, q, row = ranges(self.ptr[t], size), np.repeat(q, size), np.repeat(row, size)
        block = self.block[cells]
        bound = np.bincount(row * self.blocks + block, q * self.top[cells], rows * self.blocks).reshape(rows, self.blocks) + whole @ self.dense_top
        # blocks by falling bound, some at a time; each group's cells stand together
        order = np.argsort(-bound.mean(0), kind="stable")
        place = np.empty(self.blocks, np.int16 if self.blocks < 1 << 15 else np.int64)  # short keys sort by radix
        place[order] = np.arange(self.blocks)
        by = np.argsort(place[block], kind="stable")
        cells, q, row, at = cells[by], q[by], row[by], place[block[by]]
        best, score = np.full((rows, k), -1, np.int64), np.zeros((rows, k))
        for first in range(0, self.blocks, GROUP):
            group = order[first:first + GROUP]
            need = ((bound[:, group] > 0) & (bound[:, group] >= score[:, -1:] - 1e-12)).any(1)
            some = np.flatnonzero(need)
            if not len(some):
                continue
            width = len(group) * BLOCK
            part = slice(*np.searchsorted(at, [first, first + len(group)]))
            own = need[row[part]]
            cell, weight, line, column = cells[part][own], q[part][own], (np.cumsum(need) - 1)[row[part][own]], at[part][own] - first
            size = self.begin[cell + 1] - self.begin[cell]
            post = ranges(self.begin[cell], size)
            target = np.repeat(line * width + column.astype(np.int64) * BLOCK, size) + self.doc[post] % BLOCK
            sums = (np.bincount(target, np.repeat(weight, size) * self.weight[post], len(some) * width) + 0.0).reshape(len(some), width)
            queries = whole[some]
            for j, b in enumerate(group.tolist()):
                sums[:, j * BLOCK:(j + 1) * BLOCK] += queries @ self.dense[b]
            examples = (group[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            ids = self.ids[np.minimum(examples, n - 1)]
            sums = np.round(sums, 12)
            if without is not None:
                sums[ids[None, :] == without[some][:, None]] = 0
            found = np.concatenate([score[some], sums], 1)
            who = np.concatenate([best[some], np.broadcast_to(examples, sums.shape)], 1)
            # the k best and what ties with the last of them
            last = np.maximum(np.partition(found, found.shape[1] - k, axis=1)[:, found.shape[1] - k], 1e-300)
            top = min(found.shape[1], max(k, int((found >= last[:, None]).sum(1).max())))
            keep = np.argpartition(-found, top - 1, axis=1)[:, :top]
            found, who = np.take_along_axis(found, keep, 1), np.take_along_axis(who, keep, 1)
            keep = np.lexsort((self.ids[np.minimum(who, n - 1)], -found))[:, :k]  # places beyond the last example score 0
            found, who = np.take_along_axis(found, keep, 1), np.take_along_axis(who, keep, 1)
            score[some], best[some] = found, np.where(found > 0, who, -1)
        return best, score

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """Distance-weighted share of label 1 among each query's neighbours."""
        w = np.where(best >= 0, 1 / (0.05 + np.maximum(0, 1 - cosine)) - 1 / 1.05, 0)
        return ((w * self.labels[best]).sum(1) + self.every) / (w.sum(1) + 1)

    def left_out(self, t: np.ndarray, c: np.ndarray, offsets: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Votes on examples without themselves and without the words that no other has; nan
        where no word is left."""
        known = self.df[t] > 1
        row = np.repeat(np.arange(len(own)), np.diff(offsets))[known]
        full, votes = np.unique(row), np.full(len(own), np.nan)
        if len(full):
            votes[full] = self.vote(*self.nearest(t[known], c[known], np.r_[0, np.cumsum(np.bincount(row, minlength=len(own))[full])], own[full]))
        return votes

    def calibrate(self, got: list[tuple[float, int]]) -> None:
        """Isotonic fit of the labels on the votes of the examples left out in turn; votes
        above all of these, as a copy of an example gets, rise to one."""
        got = sorted(got)
        pools: list[list[float]] = []  # vote, label sum, rows
        for vote, y in got:
            pools.append([vote, y, 1])
            while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
                v, s, n = pools.pop()
                u = pools[-1]
                pools[-1] = [(u[0] * u[2] + v * n) / (u[2] + n), u[1] + s, u[2] + n]
        self.levels = np.array([p[0] for p in pools])
        self.values = np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])
        if len(pools) and self.levels[-1] < 1:
            self.levels, self.values = np.r_[self.levels, 1.0], np.r_[self.values, 1.0]

    def score(self, t: np.ndarray, c: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(calibrated scores, nearest examples, cosines) of some texts."""
        n = len(offsets) - 1
        scores, best, cosine = np.full(n, self.bare), np.full((n, K), -1, np.int64), np.zeros((n, K))
        full = np.flatnonzero(np.diff(offsets)) if len(self.ids) else np.zeros(0, np.int64)
        if len(full):
            best[full], cosine[full] = self.nearest(t, c, np.r_[0, offsets[1:][full]])
            votes = self.vote(best[full], cosine[full])
            scores[full] = votes if self.levels is None or not len(self.levels) else np.interp(votes, self.levels, self.values)
        return scores, best, cosine


@dataclass
class Model:
    """The fitted sample as plain arrays, and the calibration of the votes."""

    ids: list
    labels: list
    terms: np.ndarray
    counts: np.ndarray
    offsets: np.ndarray
    votes: list

    def arrays(self) -> tuple:
        return self.ids, self.labels, self.terms, self.counts, self.offsets, self.votes


def index_of(ids: list, labels: list, terms: np.ndarray, counts: np.ndarray, offsets: np.ndarray, votes: list) -> Index:
    rows = [slice(a, b) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    index = Index(ids, labels, [terms[r] for r in rows], [counts[r].astype(np.float64) for r in rows], np.unique(terms))
    if votes:
        index.calibrate(votes)
    return index


def _worker_index(stamp: str, arrays: tuple) -> Index:
    """The index of a model, built once in a worker; a worker keeps the latest only."""
    held = _kept("toxicity", dict)
    if stamp not in held:
        held.clear()
        held[stamp] = index_of(*arrays)
    return held[stamp]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", examples: int = EXAMPLES) -> Model:
    """Model of about ``examples`` labelled rows, chosen by the hash of their id."""
    marked = labels.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where("id is not null and y is not null")
    n = marked.count()
    part = min(1.0, examples / n) if n else 0.0
    chosen = marked.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(part * 1_000_000) if part < 1 else F.lit(True))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            raw, offsets = utf8(b.column("text"))
            words, count, at = counted(*terms_of(raw, offsets), b.num_rows)
            shingles, row = shingles_of(*words_of(raw, offsets))
            sketch = np.zeros(b.num_rows, np.uint64)
            full = np.unique(row)
            if len(full):
                sketch[full] = np.minimum.reduceat(shingles, np.searchsorted(row, full))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(sketch.view(np.int64)), list_array(words.view(np.int64), at, pa.int64()), list_array(count, at, pa.int32())], ["id", "y", "sketch", "terms", "counts"])

    # the sample has a fixed bound, so the documents need not move to it
    own = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sample = staged(own.join(F.broadcast(chosen), "id").select("id", "y", "text").mapInArrow(features, "id long, y int, sketch long, terms array<long>, counts array<int>"), "features")
    first = sample.groupBy("sketch", "y").agg(F.min("id").alias("id"))
    sample = staged(sample.join(first, ["sketch", "y", "id"]).dropDuplicates(["sketch", "y"]), "examples")
    rows = sample.select("id", "y", "terms", "counts").toArrow().combine_chunks()
    flat = lambda c, kind: (pa.chunked_array([x.flatten() for x in rows[c].chunks], kind).to_numpy() if rows.num_rows else np.zeros(0))
    sizes = pc.list_value_length(rows["terms"]).to_numpy() if rows.num_rows else np.zeros(0, np.int64)
    model = Model(rows["id"].to_pylist(), rows["y"].to_pylist(), flat("terms", pa.int64()).astype(np.int64).view(np.uint64), flat("counts", pa.int32()).astype(np.int32),
                  np.r_[0, np.cumsum(sizes)].astype(np.int64), [])
    shared, stamp = docs.sparkSession.sparkContext.broadcast(model.arrays()), uuid.uuid4().hex

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _worker_index(stamp, shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                b = whole.slice(at, TOGETHER)
                offsets = np.r_[0, np.cumsum(pc.list_value_length(b.column("terms")).to_numpy())]
                t = np.searchsorted(index.vocabulary, b.column("terms").flatten().to_numpy().view(np.uint64))
                votes = index.left_out(t, b.column("counts").flatten().to_numpy().astype(np.float64), offsets, b.column("id").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(votes), b.column("y")], ["vote", "y"])

    votes = sample.select("id", "y", "terms", "counts").mapInArrow(left_out, "vote double, y int").where("not isnan(vote)").toArrow()
    model.votes = list(zip(votes["vote"].to_pylist(), votes["y"].to_pylist(), strict=True))
    return model


def score(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with ``out``: struct (score, evidence), evidence being the three
    nearest examples as id:label:cosine."""
    shared, stamp = df.sparkSession.sparkContext.broadcast(model.arrays()), uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = _worker_index(stamp, shared.value)
        for texts in batches:
            scores, evidence = [], []
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], ["text"])
            for b in slices(iter([batch]), "text"):
                words, row = terms_of(*utf8(b.column("text")))
                at = np.minimum(np.searchsorted(own.vocabulary, words), max(0, len(own.vocabulary) - 1))
                known = own.vocabulary[at] == words if len(own.vocabulary) else np.zeros(len(words), bool)
                t, c, offsets = counted(at[known], row[known], b.num_rows)
                for i in range(0, b.num_rows, TOGETHER):
                    some = offsets[i:i + TOGETHER + 1]
                    own_scores, best, cosine = own.score(t[some[0]:some[-1]], c[some[0]:some[-1]], some - some[0])
                    scores += own_scores.tolist()
                    evidence += [[f"{own.ids[j]}:{own.labels[j]:.0f}:{x:.4f}" for j, x in zip(js[:3], xs[:3], strict=True) if j >= 0] for js, xs in zip(best, cosine, strict=True)]
            yield pd.DataFrame({"score": scores, "evidence": evidence})

    return df.withColumn(out, F.pandas_udf(run, "score double, evidence array<string>")(F.col(f"`{text}`")))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels outside the held-out fold."""
    return labels.where(crc32_of("doc_id") % 3 != 1)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = fit(docs, training_labels(table(spark, sf_dir, "labels")))
    return score(docs, index).select(
        "doc_id", (F.coalesce(crc32_of("doc_id"), F.lit(0)) % 3 == 1).alias("held_out"), "toxicity.score",
        (F.col("toxicity.score") >= THRESHOLD).cast("int").alias("predicted"), F.array_join("toxicity.evidence", " ").alias("evidence"))
