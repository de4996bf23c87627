"""Nearest neighbours by largest inner product: vantage-point trees per shard.

Vectors get one more component, sqrt(M^2 - |x|^2) for the largest norm M, which
makes the Euclidean distance to a query fall as the inner product rises, so the
triangle inequality holds.  Each shard holds a tree; blocks of queries descend
it together, nearer side first, and skip a side when the vantage point's
distance shows that it cannot hold a better one.  The bound is relaxed by
``factor``: 1 is exact, less prunes more.  Trees and query blocks have fixed
sizes; every query block meets every shard, whose tree is built once, and each pair
hands on only its own best.

Defined results: vectors that are null, zero, empty or hold a null or non-finite
component take no part; a repeated vec_id counts once, with its smallest vector;
vectors of another length than the query's are no candidates; ties go to the
smaller vec_id; with fewer candidates than asked for, all are returned; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table

#: Vectors of a tree, queries of a block, vectors of a leaf, and pairs that are scored at once.
SHARD, BLOCK, LEAF, PAIRS = 4096, 512, 512, 1 << 14
NEAREST, EVERY = 20, 20
#: Share of the bound that pruning respects.
FACTOR = 0.7


class Tree:
    """Arrays of a vantage-point tree; rows of a node are contiguous."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: float):
        self.ids, self.vectors, self.top = ids, vectors, top
        extra = np.sqrt(np.maximum(0.0, top * top - (vectors * vectors).sum(1)))
        self.points = np.column_stack([vectors, extra])
        self.nodes: list[tuple] = []
        self._build(0, len(ids))

    def _build(self, lo: int, hi: int) -> int:
        """Node over rows [lo, hi): (lo, hi, split, radius, inner, outer); its
        vantage point is row lo, a leaf has no split."""
        me = len(self.nodes)
        self.nodes.append((lo, hi, -1, 0.0, -1, -1))
        if hi - lo <= LEAF:
            return me
        some = self.points[lo:hi]
        # the row farthest from the first row spreads distances best
        far = lo + int(np.argmax(((some - some[0]) ** 2).sum(1)))
        self._move(lo, hi, np.r_[far - lo, [k for k in range(hi - lo) if k != far - lo]])
        d = np.sqrt(((self.points[lo + 1:hi] - self.points[lo]) ** 2).sum(1))
        order = np.argsort(d, kind="stable")
        radius = float(d[order[len(d) // 2]])
        inside = int((d < radius).sum())
        if inside == 0 or inside == len(d):
            return me
        self._move(lo + 1, hi, order)
        split = lo + 1 + inside
        self.nodes[me] = (lo, hi, split, radius, self._build(lo + 1, split), self._build(split, hi))
        return me

    def _move(self, lo: int, hi: int, order: np.ndarray) -> None:
        for a in (self.ids, self.vectors, self.points):
            a[lo:hi] = a[lo:hi][order]

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, inner products) of the k best of each query; -1 and -inf where there are fewer."""
        self.best = np.full((len(queries), k), -1, np.int64)
        self.score = np.full((len(queries), k), -np.inf)
        self.query, self.own, self.factor = queries, ids, factor
        self.size = (queries * queries).sum(1) + self.top * self.top
        self.slack = 1e-9 * self.top * np.sqrt((queries * queries).sum(1))
        self._visit(0, np.arange(len(queries)))
        return self.best, self.score

    def _take(self, q: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Puts rows [lo, hi) into the lists of queries q; their inner products but for rounding.

        A matrix product leaves out the pairs that are no better by more than its rounding; the
        others get their score, in one order of summation, so equal vectors tie exactly."""
        k, product = self.best.shape[1], self.query[q] @ self.vectors[lo:hi].T
        least = self.score[q, -1].copy()
        open_ = np.flatnonzero(np.isneginf(least))
        if len(open_) and hi - lo > k + 1:  # one of the k + 1 best may be the query itself
            least[open_] = np.partition(product[open_], hi - lo - k - 1, axis=1)[:, hi - lo - k - 1]
        i, j = np.nonzero((product >= (least - self.slack[q])[:, None]) & (self.ids[lo:hi] != self.own[q][:, None]))
        if len(i):
            score = np.concatenate([np.einsum("nd,nd->n", self.query[q[i[a:a + PAIRS]]], self.vectors[lo + j[a:a + PAIRS]]) for a in range(0, len(i), PAIRS)])
            rows, at, n = np.unique(i, return_index=True, return_counts=True)
            own, place = q[rows], (np.repeat(np.arange(len(rows)), n), k + np.arange(len(i)) - np.repeat(at, n))
            s, d = np.full((len(rows), k + n.max()), -np.inf), np.full((len(rows), k + n.max()), -1, np.int64)
            s[:, :k], d[:, :k] = self.score[own], self.best[own]
            s[place], d[place] = score, self.ids[lo + j]
            order = np.lexsort((d, -s))[:, :k]
            self.score[own], self.best[own] = np.take_along_axis(s, order, 1), np.take_along_axis(d, order, 1)
        return product

    def _visit(self, node: int, q: np.ndarray) -> None:
        lo, hi, split, radius, inner, outer = self.nodes[node]
        if not len(q) or lo == hi:
            return
        if split < 0:
            self._take(q, lo, hi)
            return
        product = self._take(q, lo, lo + 1)[:, 0]
        d = np.sqrt(np.maximum(0.0, self.size[q] - 2 * product))
        near = d < radius
        for first, second, some, dist in ((inner, outer, q[near], d[near]), (outer, inner, q[~near], d[~near])):
            self._visit(first, some)
            worst = self.score[some, -1]
            reach = np.sqrt(np.maximum(0.0, self.size[some] - 2 * np.where(np.isneginf(worst), 0, worst))) + 1e-9
            reach = np.where(np.isneginf(worst), np.inf, self.factor * reach)
            self._visit(second, some[np.abs(dist - radius) <= reach])


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, vector of doubles) of the rows that take part, one for each id."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("vector")).where(
        "id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) <> double('infinity')) and exists(vector, x -> x <> 0)")
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def search(rows: DataFrame, queries: DataFrame, k: int = NEAREST, factor: float = FACTOR) -> DataFrame:
    """(query_id, rank, vec_id, score): ``rows`` and ``queries`` are (id, vector)."""
    size = rows.agg(F.count("*").alias("n"), F.max(F.expr("sqrt(aggregate(vector, 0D, (a, x) -> a + x * x))")).alias("top")).first()
    if not size.n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    top = float(size.top) * (1 + 1e-12)
    n_shards, n_blocks = -(-size.n // SHARD), -(-max(1, queries.count()) // BLOCK)

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        """One row: the group's ids and vectors as bytes."""
        pdf = pdf.sort_values("id")
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "dim": [pdf["dim"].iloc[0]], "ids": [pdf["id"].to_numpy("<i8").tobytes()],
                             "vectors": [np.array(pdf["vector"].tolist(), "<f8").tobytes()]})

    def dealt(df: DataFrame, parts: int) -> DataFrame:
        own = df.select("id", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"))
        return own.groupBy("part", "dim").applyInPandas(packed, "part int, dim int, ids binary, vectors binary")

    # a task reads a shard, builds its tree once, then searches it for one query block after the other
    named = lambda df, shard, block: df.select(shard.alias("shard"), "dim", block.cast("int").alias("block"), "ids", "vectors")
    trees = named(dealt(rows, n_shards), F.col("part"), F.lit(-1))
    blocks = named(dealt(queries, n_blocks), F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))), F.col("part"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, of = None, None
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids, vectors = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.vectors, "<f8")
                if r.block < 0:
                    tree, of = Tree(ids.copy(), vectors.reshape(len(ids), -1).copy(), top), (r.shard, r.dim)
                elif of == (r.shard, r.dim):  # else no vector of this length lies in the shard
                    best, score = tree.search(ids, vectors.reshape(len(ids), -1), k, factor)
                    some = (best >= 0) & ~np.isneginf(score)
                    yield pd.DataFrame({"query_id": np.repeat(ids, some.sum(1)), "vec_id": best[some], "score": score[some]})

    both = trees.unionByName(blocks).repartition(n_shards, "shard").sortWithinPartitions("shard", "dim", "block")
    found = both.mapInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(usable(table(spark, sf_dir, "embeddings")), "vectors")
    return search(rows, rows.where(F.col("id") % EVERY == 0))
