"""Fact tables laid out by their key with Spark's bucketing.

A table bucketed and sorted by a part of its key is read back with that partitioning, so
aggregations and checks whose keys contain it need no exchange of the table: comparing
months, repeated keys, keys of a composite foreign key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def save_bucketed(df: DataFrame, keys: Sequence[str], path: str, buckets: int, name: str | None = None) -> str:
    """Write ``df`` as an external table with ``buckets`` buckets by ``keys``; returns the
    table's name.  Rows are dealt by the same hash first, so each bucket is one file; choose
    the number so that a bucket fits a task (100 TB in 128 MB files: 800,000 buckets a
    table, or fewer with partitions by period), and keys that no single value dominates."""
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite")
     .option("path", path).saveAsTable(name))
    return name


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
