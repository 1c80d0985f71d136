"""Pre-aggregated join sides that leave AQE free to split a hot key.

AQE splits a skewed partition of a sort-merge join only if a shuffle is right
below the join's sort on both sides.  A side grouped by exactly the join keys
reuses its own shuffle, so an aggregate sits in between and a hot key on the
other side stays in one task.  Here the keys are grouped as one struct: the same
groups, but a partitioning of its own.  The result, narrow and unique, is shuffled
once more for the join, and the other side can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "_key"


def packed(keys: Sequence[str]) -> Column:
    """The keys as one struct column."""
    return F.struct(*keys).alias(KEY)


def join_side(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per key with its aggregates, to be joined on ``keys``."""
    out = df.groupBy(packed(keys)).agg(*aggregates)
    return out.select(f"{KEY}.*", *[c for c in out.columns if c != KEY])


def key_set(df: DataFrame, keys: Sequence[str], nulls: bool = False) -> DataFrame:
    """Distinct keys, by default without NULLs (which never match)."""
    narrow = df.select(*keys)
    narrow = narrow if nulls else narrow.dropna()
    return narrow.select(packed(keys)).distinct().select(f"{KEY}.*")
