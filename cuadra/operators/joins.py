"""Joins to dimensions and key sets.

The physical join is the planner's choice: a side is broadcast when its
statistics, or the size that adaptive execution measures after its shuffle, are
under the session's ``autoBroadcastJoinThreshold``; beyond that both sides
shuffle on the key, with skewed partitions split.  No job runs while a query is
built, but for the count of ``key_side``.

Both sizes are of compressed bytes.  Of keys, what the driver would hold of a broadcast
is many times that, so the monthly jobs deal sides that grow with the tables (``dealt``,
``key_side``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dealt(side: DataFrame) -> DataFrame:
    """A side of an equi-join that is shuffled by the key, never broadcast."""
    return side.hint("merge")


#: Rows of a key table that the planner may broadcast.
BROADCAST_KEYS = 100_000


def key_side(keys: DataFrame) -> DataFrame:
    """A stored key table as a side of joins: dealt if it has many rows.  A small one is left
    to the planner, as a large side would be dealt by a few keys."""
    return dealt(keys) if keys.count() > BROADCAST_KEYS else keys


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join a large table to a keyed dimension."""
    return fact.join(dim, on=on, how=how)


def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str],
              anti: bool = False) -> DataFrame:
    """``left_semi`` (or ``left_anti``) against a key set."""
    return df.join(keys, on=on, how="left_anti" if anti else "left_semi")
