"""Comparing large tables without shuffling what is equal.

Rows are dealt into buckets by their hash, and each bucket of a side is summed up as a
count and order-free sums of row hashes.  Only the sums are shuffled; rows only where a
bucket is not the same on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.schema import conform, merged_types

BUCKETS = 1 << 16
LEFT, RIGHT = "left_rows", "right_rows"


def _hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row; the hash function skips NULLs, so which are NULL is hashed too."""
    nulls = [F.col(f"`{c}`").isNull() for c in columns]
    values = [F.col(f"`{c}`") for c in columns]
    return tuple(F.xxhash64(F.lit(seed), *nulls, *values) for seed in (1, 2))


def bucket_sums(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, sums): rows per bucket and sums of both halves of two hashes of them.

    At most ``buckets`` rows leave a task.  Two 64-bit sums differ by chance once in 2^128.
    """
    first, second = _hashes(df.columns)
    hashed = df.select(first.alias("_a"), second.alias("_b"))
    halves = [F.sum(F.shiftrightunsigned(c, 32)) for c in ("_a", "_b")] + [F.sum(F.col(c).bitwiseAND(0xFFFFFFFF)) for c in ("_a", "_b")]
    bucket = F.pmod("_a", F.lit(buckets)).alias("bucket")
    return hashed.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.array(*halves).alias("sums"))


def unequal_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Buckets whose rows are not the same on both sides; both have the same columns."""
    ours, theirs = (bucket_sums(d, buckets).withColumn("side", F.lit(i)) for i, d in enumerate((left, right)))
    both = ours.unionByName(theirs).groupBy("bucket")
    same = (F.count(F.lit(1)) == 2) & (F.min(F.struct("n", "sums")) == F.max(F.struct("n", "sums")))
    return both.agg(same.alias("same")).filter(~F.col("same")).select("bucket")


def table_diff(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows that the sides do not hold equally often, with ``left_rows`` and ``right_rows``.

    Columns are merged as in a union: one that a side lacks is NULL there.  NULLs are
    equal.  Both sides are scanned twice; the second time only rows of unequal buckets,
    of which at most ``buckets`` numbers are broadcast, go any further.
    """
    types = merged_types([left, right])
    taken = {c.lower() for c in types} & {LEFT, RIGHT}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are names of the result")
    ours, theirs = conform(left, types), conform(right, types)
    wanted = F.broadcast(unequal_buckets(ours, theirs, buckets))
    columns = list(types)

    def rows(df: DataFrame, side: str, other: str) -> DataFrame:
        bucket = F.pmod(_hashes(columns)[0], F.lit(buckets)).alias("_bucket")
        found = df.select("*", bucket).join(wanted, F.col("_bucket") == F.col("bucket"), "left_semi")
        return found.drop("_bucket").withColumns({side: F.lit(1), other: F.lit(0)})

    both = rows(ours, LEFT, RIGHT).unionByName(rows(theirs, RIGHT, LEFT))
    counted = both.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum(LEFT).alias(LEFT), F.sum(RIGHT).alias(RIGHT))
    return counted.filter(F.col(LEFT) != F.col(RIGHT))


def diff_counts(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """kind, n: rows only left, rows only right, and rows of different multiplicity."""
    kind = F.when(F.col(RIGHT) == 0, "left_only").when(F.col(LEFT) == 0, "right_only").otherwise("multiplicity")
    return table_diff(left, right, buckets).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
