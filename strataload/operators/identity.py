"""Surrogate ids and id maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.operators.skew import join_side, key_set
from strataload.schema import union_bag
from strataload.session import durable

# monotonically_increasing_id keeps the partition in the bits above these.
_POSITION_BITS = 33


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def number_keys(keys_df: DataFrame, order: Sequence[str], seed: int, out: str, partitions: int | None = None) -> DataFrame:
    """Number distinct keys 1, 2, ... in sort order (NULL first) after ``seed``.

    A global window would put every key into one task.  Here the keys are
    range-partitioned and sorted, cut once by a reliable checkpoint, and each
    partition starts at the number of keys before it.  Only those numbers, one
    per partition, pass through the driver.
    """
    sorting = [F.col(c).asc_nulls_first() for c in order]
    ranged = (
        keys_df.repartitionByRange(partitions, *sorting) if partitions else keys_df.repartitionByRange(*sorting)
    )
    fixed = durable(ranged.sortWithinPartitions(*sorting))
    placed = fixed.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_at", _POSITION_BITS)
    )
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).orderBy("_part").collect()
    before = accumulate((r["_n"] for r in counts), initial=0)
    starts = keys_df.sparkSession.createDataFrame(
        [(r["_part"], start) for r, start in zip(counts, before)], "_part long, _start long"
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # one row per partition of the range shuffle, so the broadcast is bounded
    joined = placed.join(F.broadcast(starts), "_part")
    return joined.select(*keys_df.columns, (F.lit(seed) + F.col("_start") + position + 1).cast("long").alias(out))


def dense_ids(df: DataFrame, keys: Sequence[str], seed: int, out: str) -> DataFrame:
    """``seed`` + dense rank over ``keys`` for every row, without a global window."""
    ids = number_keys(df.select(*keys).distinct(), keys, seed, out)
    return df.alias("d").join(ids.alias("i"), _same("d", "i", keys), "left").select("d.*", F.col(f"i.{out}"))


def shuffled_ids(df: DataFrame, keys: Sequence[str], seed: int, out: str, salt: str) -> DataFrame:
    """As :func:`dense_ids`, but in an order that does not show the keys.

    The order is a salted hash of the whole key, then the key itself: the same
    on every run, and two keys never share an id.
    """
    mixed = df.select(*keys).distinct().withColumn("_mix", F.xxhash64(F.lit(salt), *keys))
    ids = number_keys(mixed, ["_mix", *keys], seed, out).drop("_mix")
    return df.alias("d").join(ids.alias("i"), _same("d", "i", keys), "left").select("d.*", F.col(f"i.{out}"))


def max_id(df: DataFrame, column: str, default: int = 0) -> int:
    """The highest id; a max over partial maxima, one number on the driver."""
    found = df.agg(F.max(column)).first()[0]
    return default if found is None else int(found)


def new_rows(incoming: DataFrame, existing: DataFrame | None, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Incoming rows whose key the existing table does not have."""
    if existing is None:
        return incoming
    known = key_set(existing, keys, nulls=null_safe)
    if null_safe:
        return incoming.alias("n").join(known.alias("k"), _same("n", "k", keys), "left_anti")
    return incoming.join(known, list(keys), "left_anti")


def append_ids(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], id_col: str, seed: int | None = None
) -> DataFrame:
    """An append-only dictionary: unseen keys get the ids after the highest one.

    Keys are compared null-safe (NULL is a key); known rows never change.
    """
    fresh = new_rows(incoming, existing, keys, null_safe=True)
    start = seed if seed is not None else (0 if existing is None else max_id(existing, id_col))
    numbered = number_keys(fresh, keys, start, id_col)
    return numbered if existing is None else union_bag([existing, numbered])


def new_keys(incoming: DataFrame, existing: DataFrame, keys: Sequence[str], where: str | None = None) -> DataFrame:
    """Rows of ``incoming`` (filtered) that do not exist in the table yet."""
    rows = incoming if where is None else incoming.filter(where)
    return new_rows(rows, existing, keys)


def backfill_ids(df: DataFrame, keys: Sequence[str], id_col: str, seed: int = 0) -> DataFrame:
    """Give ids to rows without one, going on from the current highest id (``seed`` without any)."""
    missing, present = df.filter(F.col(id_col).isNull()), df.filter(F.col(id_col).isNotNull())
    filled = dense_ids(missing.drop(id_col), keys, max_id(present, id_col, seed), id_col)
    return filled.select(*df.columns).unionByName(present)


def all_ids(frames: Sequence[DataFrame], insert_ts: Column | None = None) -> DataFrame:
    """Distinct ids of several mapped sources, stamped."""
    out = reduce(DataFrame.unionByName, frames).distinct()
    return out if insert_ts is None else out.withColumn("insert_ts", insert_ts)


def id_map_insert(
    id_map: DataFrame | None, ids: DataFrame, keys: Sequence[str], id_col: str, stamped: Column, seed: int = 0
) -> DataFrame:
    """Add unseen ids to the id map; existing entries keep their number."""
    fresh = new_rows(ids.select(*keys).distinct(), id_map, keys, null_safe=True)
    start = seed if id_map is None else max_id(id_map, id_col, seed)
    numbered = number_keys(fresh, keys, start, id_col).withColumns({"insert_ts": stamped, "update_ts": stamped})
    return numbered if id_map is None else union_bag([id_map, numbered])


def unique_rows(view: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "view") -> DataFrame:
    """One row per key; fails while running if a key has two different rows.

    This guards the row count of the join that follows inside the same job,
    instead of counting before and after it.
    """
    checks = []
    for c in columns:
        checks.append(F.min(c).eqNullSafe(F.max(c)) & F.count(c).isin(F.lit(0), F.count(F.lit(1))))
    ok = reduce(Column.__and__, checks) if checks else F.lit(True)
    failed = F.raise_error(F.lit(f"{name}: several different rows for one key, the join would multiply rows"))
    values = [F.when(ok, F.min(c)).otherwise(failed).alias(c) for c in columns]
    return join_side(view.dropna(subset=list(keys)), keys, *values)


def coalesce_update(base: DataFrame, views: Mapping[str, DataFrame], keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each column from the first view that has a value, else the old value."""
    out = base.alias("b")
    names = {}
    for i, (name, view) in enumerate(views.items()):
        mine = [c for c in columns if c in view.columns]
        side = unique_rows(view, keys, mine, name)
        side = side.select(
            *[F.col(k).alias(f"_v{i}_{k}") for k in keys], *[F.col(c).alias(f"_u{i}_{c}") for c in mine]
        )
        test = reduce(Column.__and__, [F.col(f"b.{k}") == F.col(f"_v{i}_{k}") for k in keys])
        out = out.join(side, test, "left")
        for c in mine:
            names.setdefault(c, []).append(f"_u{i}_{c}")
    return out.select(
        *[F.coalesce(*[F.col(n) for n in names[c]], F.col(f"b.{c}")).alias(c) if c in names else F.col(f"b.{c}")
          for c in base.columns]
    )


def id_map_update(
    id_map: DataFrame, views: Mapping[str, DataFrame], keys: Sequence[str], columns: Sequence[str], updated: Column
) -> DataFrame:
    """Apply ordered rule views to the id map, re-stamped.

    The number of entries must not change: entries that become equal fail the job while
    it runs, in the shuffle that would otherwise have removed them.
    """
    new = coalesce_update(id_map, views, keys, columns)
    entry = [c for c in new.columns if c != "update_ts"]
    counted = new.groupBy(F.struct(*entry).alias("_entry")).agg(F.count(F.lit(1)).alias("_n"))
    one = F.assert_true(F.col("_n") == 1, F.lit("id map update: entries became equal, the row count would change"))
    checked = counted.withColumn("_ok", one).filter(F.col("_ok").isNull())
    return checked.select("_entry.*").withColumn("update_ts", updated)
