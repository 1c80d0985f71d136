"""Facts and the versions that are valid at their dates, for keys with many versions.

An interval join tests every fact against every version of its key.  Here facts and the
bounds of the versions are sorted into one stream per key.  With versions numbered by
their start, a fact at t can only meet the numbers in (j, r]: r is the last version that
has started, j the last one up to which all have ended before t.  Both are running maxima
over the stream, version j + 1 is always valid, and later ones only where versions
overlap, so the fact is joined to its numbers by equality.  Without overlaps that is one
version, however many the key has.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.operators.skew import join_side

# facts of a key that one stream takes; hot keys are dealt into several streams
STREAM_ROWS = 1_000_000


def ranked_versions(versions: DataFrame, keys: list[str], valid: tuple[str, str]) -> DataFrame:
    """Versions with ``_rank`` by start within the key, and ``_until``, the latest end up to there.

    Versions without a key or bound, or that end before they start, are never valid and
    left out.  Ties are ordered by all columns, so the numbers are the same each time.
    """
    start, end = valid
    usable = versions.dropna(subset=[*keys, start, end]).filter(F.col(start) <= F.col(end))
    others = [c for c in versions.columns if c not in (*keys, start, end)]
    order = Window.partitionBy(*keys).orderBy(start, end, *others)
    return usable.withColumns(
        {"_rank": F.row_number().over(order), "_until": F.max(end).over(order.rowsBetween(Window.unboundedPreceding, 0))}
    )


def overlapping_versions(versions: DataFrame, keys: list[str], valid: tuple[str, str] = ("add_date", "delete_date")) -> DataFrame:
    """Versions that start before an earlier one of their key has ended."""
    ranked = ranked_versions(versions, keys, valid)
    others = [c for c in versions.columns if c not in (*keys, *valid)]
    before = F.lag("_until").over(Window.partitionBy(*keys).orderBy(*valid, *others))
    return ranked.withColumn("_before", before).filter(F.col(valid[0]) <= F.col("_before")).select(*versions.columns)


def asof_sweep(
    facts: DataFrame,
    versions: DataFrame,
    on: Mapping[str, str],
    at: str = "add_date",
    valid: tuple[str, str] = ("add_date", "delete_date"),
    outputs: Mapping[str, str] | None = None,
    how: str = "left",
    stream_rows: int = STREAM_ROWS,
) -> DataFrame:
    """All versions that are valid at the fact's date (closed interval), as
    :func:`strataload.operators.lookup.validity_join` gives them.

    Facts of a hot key are dealt into several streams, each with the bounds of all its
    versions; a stream is sorted with spilling, its rows are not held.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unknown join {how!r}")
    named = dict(outputs or {c: c for c in versions.columns if c not in on.values() and c not in facts.columns})
    keys = [f"_k{i}" for i in range(len(on))]
    payload = F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact")
    rows = facts.select(*[F.col(a).alias(k) for k, a in zip(keys, on)], F.col(at).alias("_t"), payload)
    usable = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, "_t")])

    side = versions.select(
        *[F.col(b).alias(k) for k, b in zip(keys, on.values())],
        F.col(valid[0]).alias("_from"),
        F.col(valid[1]).alias("_to"),
        *[F.col(c).alias(f"_out{i}") for i, c in enumerate(named)],
    )
    ranked = ranked_versions(side, keys, ("_from", "_to"))

    # facts of a hot key go to several streams
    streams = F.ceil(F.col("_n") / stream_rows)
    hot = join_side(rows.filter(usable), keys, F.count(F.lit(1)).alias("_n")).withColumn("_streams", streams.cast("int")).filter("_streams > 1").drop("_n")
    known = rows.filter(usable).join(hot, keys, "left")
    known = known.withColumn("_stream", F.pmod(F.xxhash64("_fact"), F.coalesce("_streams", F.lit(1))).cast("int"))
    none = F.lit(None).cast("int")
    marks = F.array(  # at the same date: starts, facts, ends
        F.struct(F.col("_from").alias("_t"), F.lit(0).alias("_kind"), F.col("_rank").alias("_r"), none.alias("_j")),
        F.struct(F.col("_until").alias("_t"), F.lit(2).alias("_kind"), none.alias("_r"), F.col("_rank").alias("_j")),
    )
    bounds = ranked.select(*keys, "_rank", F.explode(marks).alias("_m")).select(*keys, "_m.*").join(hot, keys, "left")
    all_streams = F.sequence(F.lit(0), F.coalesce("_streams", F.lit(1)) - 1)
    bounds = bounds.select(*keys, F.explode(all_streams).alias("_stream"), "_t", "_kind", "_r", "_j")
    empty = F.lit(None).cast(rows.schema["_fact"].dataType)
    stream = known.select(*keys, "_stream", "_t", F.lit(1).alias("_kind"), none.alias("_r"), none.alias("_j"), "_fact")
    stream = stream.unionByName(bounds.withColumn("_fact", empty))

    so_far = Window.partitionBy(*keys, "_stream").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = stream.withColumns({"_r": F.max("_r").over(so_far), "_j": F.coalesce(F.max("_j").over(so_far), F.lit(0))})
    numbers = F.when(F.col("_j") < F.col("_r"), F.sequence(F.col("_j") + 1, F.col("_r")))
    placed = placed.filter("_kind = 1").select(*keys, "_t", "_fact", F.explode_outer(numbers).alias("_rank"))
    # version j + 1 is valid, so every fact with numbers keeps a row
    met = placed.join(ranked.drop("_until", "_from"), [*keys, "_rank"], how).filter(F.col("_rank").isNull() | (F.col("_to") >= F.col("_t")))
    found = met.select("_fact.*", *[F.col(f"_out{i}").alias(name) for i, name in enumerate(named.values())])
    if how == "inner":
        return found
    types = {name: found.schema[name].dataType for name in named.values()}
    lost = rows.filter(~usable).select("_fact.*", *[F.lit(None).cast(types[name]).alias(name) for name in named.values()])
    return found.unionByName(lost)
