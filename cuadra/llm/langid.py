"""Language identification with error-correcting output codes.

Each language has a codeword; one binary n-gram classifier (naive Bayes over
hashed 2- to 4-byte n-grams) predicts each bit, and decoding picks the codeword
with the least weighted logistic loss.  A small lead over the second codeword
flags the row as ambiguous.  The counts behind the classifiers come from every
labelled training row: each task sums its own, and a table of languages times
BUCKETS is all that is gathered.

Defined results: null text, empty text and text without a letter are ``und``
with score 0; without any labelled row every row is ``und``; with one language
all other rows get it; texts are read whole; repeated rows are scored one by
one; a null id counts as empty text in the fold; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, crc32_of, slices, table, utf8

#: Hash buckets of each n-gram size.
BUCKETS = 1 << 13
SIZES = (2, 3, 4)
#: Each classifier's mean log-odds count as so many independent n-grams at most.
EVIDENCE = 40.0
#: A lead in probability below this flags a row.
LEAD = 0.2

#: Bytes as the n-grams see them: lower case, everything ASCII but letters as one blank.
FOLDED = LOWER.copy()
FOLDED[:128] = np.where((FOLDED[:128] >= 97) & (FOLDED[:128] <= 122), FOLDED[:128], 32)


def grams(raw: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each size, the bucket of the n-gram at every byte; BUCKETS * 3 where
    it would leave its text.  Sizes have buckets of their own."""
    x = FOLDED[raw].astype(np.uint32)
    for k, size in enumerate(SIZES):
        h = np.zeros(len(x), np.uint32)
        for j in range(size):
            part = x[j:]
            h[:len(part)] = h[:len(part)] * np.uint32(0x01000193) + (part + np.uint32(1)) * np.uint32(0x9E3779B1)
        bucket = ((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - 13)).astype(np.int32) + k * BUCKETS
        for j in range(1, size):
            late = offsets[1:] - j
            bucket[late[late >= 0]] = BUCKETS * len(SIZES)
        yield bucket


def _counts(df: DataFrame, text: str, label: str) -> dict[str, np.ndarray]:
    """Occurrences of each bucket by label, summed on the executors."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in slices(batches, "text", 1 << 20):
            names, codes = np.unique(np.array(b.column("label").to_pylist(), dtype=object).astype(str), return_inverse=True)
            raw, offsets = utf8(b.column("text"))
            row = np.repeat(codes, np.diff(offsets)).astype(np.int64) * (BUCKETS * len(SIZES) + 1)
            sums = np.zeros(len(names) * (BUCKETS * len(SIZES) + 1), np.int64)
            for bucket in grams(raw, offsets):
                sums += np.bincount(row + bucket, minlength=len(sums))
            for name, s in zip(names, sums.reshape(len(names), -1), strict=True):
                total[name] = total.get(name, 0) + s
        for name, s in total.items():
            hit = np.flatnonzero(s)
            for at in range(0, len(hit), 8192):
                some = hit[at:at + 8192]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some.astype(np.int32)), pa.array(s[some])], ["label", "bucket", "n"])

    rows = (df.select(F.col(f"`{label}`").cast("string").alias("label"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
            .where("label is not null").mapInArrow(part, "label string, bucket int, n long")
            .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas())
    out = {}
    for name, own in rows.groupby("label"):
        out[str(name)] = np.bincount(own.bucket, weights=own.n, minlength=BUCKETS * len(SIZES) + 1)
    return out


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """(k, bits) of +1 and -1: every split of up to 5 classes, else the best of
    some random codes by least distance between rows."""
    if k <= 5:
        bits = [[1 if not i or (c >> (i - 1)) & 1 else -1 for i in range(k)] for c in range((1 << (k - 1)) - 1)] if k > 1 else [[1]]
        return np.array(bits).T
    rng = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(200):
        code = rng.choice([-1, 1], (k, max(15, int(10 * np.log2(k)))))
        code = code[:, np.abs(code.sum(0)) < k]
        apart = (code.shape[1] - code @ code.T + np.eye(k) * 1e9).min()
        if apart > far:
            best, far = code, apart
    return best


class Model:
    """names, code, weight of each n-gram for each bit, weight of each bit."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.names = sorted(counts)
        self.code = codewords(len(self.names)) if self.names else np.zeros((0, 0))
        if len(self.names) < 2:
            return
        n = np.array([counts[x][:-1] for x in self.names]).reshape(len(self.names), len(SIZES), BUCKETS)
        p = (n + 0.5) / (n + 0.5).sum(2, keepdims=True)
        p = p.reshape(len(self.names), -1)
        table = []
        for bit in self.code.T:
            # mean over the languages of a side: a language's share of rows is no evidence
            table.append(np.log(p[bit > 0].mean(0)) - np.log(p[bit < 0].mean(0)))
        w = np.array(table).T
        typical = p @ w / len(SIZES)
        sure = (typical * self.code).min(0)
        self.bits = np.maximum(sure, 0.05 * np.abs(sure).max()) / np.abs(sure).max()
        self.bits = np.maximum(self.bits, 0.05)
        self.table = np.vstack([w, np.zeros((1, w.shape[1]))]).astype(np.float32)

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, probability, lead over the second) for each text."""
        p = self.posterior(raw, offsets)
        if len(self.names) < 2:
            return np.zeros(len(p), int), np.ones(len(p)), np.ones(len(p))
        top = p.max(1)
        return p.argmax(1), top, top - np.sort(p, 1)[:, -2]

    def posterior(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of each language for each text; even where there is no text."""
        rows = len(offsets) - 1
        if len(self.names) < 2:
            return np.ones((rows, len(self.names)))
        margin = np.zeros((rows, self.table.shape[1]))
        length = np.diff(offsets)
        full = np.flatnonzero(length)
        for bucket in grams(raw, offsets):
            if len(full):
                margin[full] += np.add.reduceat(self.table[bucket], offsets[:-1][full], axis=0)
        mean = margin / np.maximum(length * len(SIZES), 1)[:, None]
        z = mean * np.minimum(length, EVIDENCE)[:, None]
        loss = (np.logaddexp(0, -z[:, None, :] * self.code[None]) * self.bits).sum(2)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        return p / p.sum(1, keepdims=True)


def train(df: DataFrame, text: str = "text", label: str = "lang") -> Model:
    return Model(_counts(df, text, label))


def predict(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` with ``out``: struct (lang, score, ambiguous)."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, letters in batches:
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], ["text"])
            parts = [model.predict(*utf8(b.column("text"))) for b in slices(iter([batch]), "text", 1 << 20)]
            best, score, lead = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(3))
            known = letters.to_numpy(dtype=bool) & bool(model.names)
            names = np.array([*model.names, "und"], dtype=object)
            yield pd.DataFrame({"lang": names[np.where(known, best, len(model.names)).astype(int)], "score": np.where(known, score, 0.0), "ambiguous": known & (lead < LEAD)})

    column = F.col(f"`{text}`")
    letters = F.coalesce(column.rlike(r"\p{L}"), F.lit(False))
    return df.withColumn(out, F.pandas_udf(run, "lang string, score double, ambiguous boolean")(column, letters))


def posteriors(df: DataFrame, model: Model, text: str = "text", out: str = "posterior") -> DataFrame:
    """``df`` with ``out``: probability of each of ``model.names``."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string(), from_pandas=True)], ["text"])
            yield pd.Series([p for b in slices(iter([batch]), "text", 1 << 20) for p in model.posterior(*utf8(b.column("text")))], dtype=object)

    return df.withColumn(out, F.pandas_udf(run, "array<double>")(F.col(f"`{text}`")))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (F.coalesce(crc32_of("doc_id"), F.lit(0)) % 4 == 2).alias("held_out"))
    model = train(docs.where("not held_out"))
    return predict(docs.drop("lang"), model).select(
        "doc_id", "held_out", F.col("language.lang").alias("lang_pred"), "language.score", "language.ambiguous")
