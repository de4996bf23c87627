"""The corpus pipeline: documents through five stages of ``cuadra.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.  Toxic documents,
near copies and benchmark leaks go, mixing repeats documents of the domains that
need more tokens (its targets let no domain shrink, so it drops none), and the
last stage writes the token shards and returns what reading them back gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm import decontaminate, minhash, mixing, tokens, toxicity
from cuadra.llm.common import staged, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    index = toxicity.fit(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, index, out="__toxicity")
    return scored.where(F.col("__toxicity.score") < toxicity.THRESHOLD).drop("__toxicity")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicated(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mix(docs, out="__mixing")
    return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__mixing.copies")))).drop("__mixing", "__copy")


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.tokenize(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_leaks),
    ("mixing", mixed),
    ("tokens", tokenized),
]

#: The nearest-neighbour votes, MinHash and byte-pair encoding have no SQL form;
#: tests/llm compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
