"""Mixing domains to target weights with soft membership.

A classifier learned from the labelled rows gives every document a posterior
over the domains.  Projected-gradient least squares then fits one nonnegative
rate per document such that the expected tokens of each domain, the sum of
rate * tokens * posterior, match the targets; the rates stay as near to one as
that allows.  A step needs only the domains' totals, so each iteration is one
aggregate over (tokens, posterior), and a document's rate follows from the
steps so far: nothing of the size of the corpus is kept or moved in between.

Without a given total no rate falls below one, so no document goes, unless a
domain has target zero; the total grows until it holds what that needs.

With nonnegative rates not every target can be met (posteriors that never pass
one half cannot make a domain the whole).  ``fit`` stops when the totals are
within TOLERANCE or no longer improve, and reports what is reached.

Defined results: null and empty texts have no tokens, an even posterior and the
rate that follows from it; without labelled rows there are no domains and every
rate is one; a domain without a target has target zero, a target without
labelled rows is left out; repeated rows get equal rates; texts are read whole;
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table
from .langid import Model, posteriors, train

#: Share of each domain's tokens after mixing.
TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}
ROUNDS, TOLERANCE = 60, 1e-6


@dataclass
class Fit:
    names: list[str]
    targets: np.ndarray
    steps: np.ndarray
    totals: np.ndarray
    least: float = 0.0

    def rates(self, posterior: np.ndarray) -> np.ndarray:
        """Rate of each document: every step taken in turn, cut off at ``least``."""
        rate = np.ones(len(posterior))
        for step in self.steps:
            rate = np.maximum(self.least, rate - posterior @ step)
        return rate


def features(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with __tokens (words of the text) and __posterior (by domain)."""
    words = F.expr(f"if({text} is null or trim({text}) = '', 0, size(split(trim({text}), '\\\\s+')))").cast("double")
    return posteriors(df, model, text, "__posterior").withColumn("__tokens", words)


def fit(rows: DataFrame, names: list[str], targets: dict[str, float], total: float | None = None, rounds: int = ROUNDS) -> Fit:
    """Rates for ``rows`` (__tokens, __posterior): domain shares as in
    ``targets`` of ``total`` tokens.  Without ``total``, so many tokens that no
    domain has to shrink and, if all have a target, no document either."""
    k = len(names)
    if not k:
        return Fit(names, np.zeros(0), np.zeros((0, 0)), np.zeros(0))

    def sums(steps: np.ndarray) -> np.ndarray:
        """Expected tokens of each domain at the rates so far."""
        now = Fit(names, np.zeros(k), steps, np.zeros(k), least)

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(k)
            for pdf in batches:
                if len(pdf):
                    p, n = np.array(pdf["__posterior"].tolist()), pdf["__tokens"].to_numpy()
                    total += (now.rates(p) * n) @ p
            yield pd.DataFrame({"i": np.arange(k), "x": total})

        got = rows.select("__tokens", "__posterior").mapInPandas(part, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toPandas()
        return np.bincount(got.i, got.x, k)

    share = np.array([max(0.0, targets.get(n, 0.0)) for n in names])
    share = share / share.sum() if share.sum() else np.full(k, 1 / k)
    least = 1.0 if total is None and (share > 0).all() else 0.0
    steps = np.zeros((0, k))
    first = sums(steps)
    totals = first
    if total is None:
        total = max([t / s for t, s in zip(totals, share, strict=True) if s > 0 and t > 0], default=0.0)
    goal = share * total
    # squared gaps weighted by 1 / (tokens of the domain at the start): in the
    # metric of the documents' tokens no curvature exceeds one, so a full step is safe
    weight = np.where(first > 0, 1 / np.maximum(first, 1e-300), 0.0)
    best, best_at, still = np.inf, 0, 0
    for _ in range(rounds):
        # what leaks into a domain whose documents are at the least rate raises the total
        if least and (totals / share).max() > goal.sum() * (1 + TOLERANCE / 4):
            goal, best, still = share * (totals / share).max(), np.inf, 0
        gap = totals - goal
        loss = float((gap * gap * weight).sum())
        still = still + 1 if loss > best * (1 - 1e-6) else 0
        if loss < best:
            best, best_at, reached = loss, len(steps), totals
        if np.abs(gap).sum() <= TOLERANCE * max(goal.sum(), 1.0) or still >= 3:
            break
        steps = np.vstack([steps, gap * weight])
        totals = sums(steps)
    else:
        gap = totals - goal
        if float((gap * gap * weight).sum()) < best:
            best_at, reached = len(steps), totals
    return Fit(names, goal, steps[:best_at], reached, least)


def rated(rows: DataFrame, found: Fit, out: str = "rate") -> DataFrame:
    """``rows`` with ``out``, the rate of each document."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in batches:
            yield pd.Series(found.rates(np.array(p.tolist()).reshape(len(p), -1)))

    if not found.names:
        return rows.withColumn(out, F.lit(1.0))
    return rows.withColumn(out, F.pandas_udf(run, "double")(F.col("__posterior")))


def mix(docs: DataFrame, label: str = "lang", key: str = "doc_id", text: str = "text", targets: dict[str, float] = TARGETS, out: str = "mixing",
        keep_text: bool = True) -> tuple[DataFrame, Fit]:
    """(docs with ``out``, a struct of domain, n_words, rate and copies; the fit).
    ``copies`` is the rate rounded up or down by a hash of the key, so that it is
    the rate on average."""
    model = train(docs, text, label)
    rows = features(docs, model, text) if model.names else docs.withColumns({"__posterior": F.lit(None).cast("array<double>"), "__tokens": F.lit(0.0)})
    rows = staged(rows if keep_text else rows.drop(text), "posteriors")
    found = fit(rows, model.names, targets)
    names = F.array(*[F.lit(n) for n in model.names]).cast("array<string>")
    domain = F.get(names, F.expr("cast(array_position(__posterior, array_max(__posterior)) as int) - 1"))
    chance = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit("mixing")), F.lit(1_000_000)) / 1_000_000
    copies = F.floor("__rate") + (chance < F.col("__rate") - F.floor("__rate")).cast("long")
    mixed = rated(rows, found, "__rate").withColumn(out, F.struct(
        domain.alias("domain"), F.col("__tokens").cast("long").alias("n_words"), F.round("__rate", 9).alias("rate"), copies.cast("int").alias("copies")))
    return mixed.drop("__posterior", "__tokens", "__rate"), found


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows, _ = mix(docs, keep_text=False)
    return rows.select("doc_id", "mixing.*")
