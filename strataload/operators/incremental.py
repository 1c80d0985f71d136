"""Incremental load strategies.

Every strategy is a pure function ``(source, target) -> Buckets``.  The target
is read in one pass: each active row is marked closed or kept by a join with a
pre-aggregated, narrow key set of the source, and inactive history bypasses the
shuffle.  The source is read once more by an anti join with the narrow key set
of the target.  No bucket is written or counted on its own.

Matching is by existence, so repeated keys never multiply rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.audit import AuditSpec
from strataload.operators.prune import split
from strataload.operators.skew import KEY, join_side, key_set, packed
from strataload.schema import align_to_source, union_bag
from strataload.sources.metrics import Metrics

MARK = "_closed"


@dataclass(frozen=True)
class Buckets:
    """Result of a load.  ``history`` holds target rows with the closed mark."""

    inserted: DataFrame
    history: DataFrame | None
    audit: AuditSpec
    closed_flag: int | None = None  # is_incremental of closed rows, None = unchanged
    kept_flag: int | None = None  # is_incremental of kept rows, None = unchanged

    def _settled(self) -> DataFrame:
        closed = F.col(MARK)
        new = {
            "delete_date": F.lit(self.audit.closing_date),
            "last_modified_date": self.audit.now(),
            "is_active": F.lit(0),
        }
        types = {f.name: f.dataType for f in self.history.schema.fields}
        changes = {c: F.when(closed, v.cast(types[c])).otherwise(F.col(c)) for c, v in new.items() if c in types}
        if "is_incremental" in types:
            same = F.col("is_incremental")
            as_is = types["is_incremental"]
            changes["is_incremental"] = F.when(
                closed, same if self.closed_flag is None else F.lit(self.closed_flag).cast(as_is)
            ).otherwise(same if self.kept_flag is None else F.lit(self.kept_flag).cast(as_is))
        return self.history.withColumns(changes)

    @property
    def closed(self) -> DataFrame:
        return self._settled().filter(MARK).drop(MARK)

    @property
    def kept(self) -> DataFrame:
        return self._settled().filter(~F.col(MARK)).drop(MARK)

    def to_df(self) -> DataFrame:
        """The complete new target as one plan."""
        if self.history is None:
            return self.inserted
        return self.inserted.unionByName(self._settled().drop(MARK).select(*self.inserted.columns))


def _active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_active") == 1)


def _inactive(df: DataFrame) -> DataFrame:
    """Everything that is not active, so that no history row can get lost."""
    return df.filter(~F.col("is_active").eqNullSafe(1))


def _matched(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` plus ``_hit``: its key is in ``known`` (unique, so no fan-out)."""
    found = df.join(known.withColumn("_hit", F.lit(True)), list(keys), "left")
    return found.withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def _pruned(active: DataFrame, src: DataFrame, key_sets: Sequence[Sequence[str]], prune: bool):
    """(active rows to compare, rows that no source key can meet, or None).

    For small feeds into large tables: a bitmap of the source's keys takes the other rows
    past the shuffle, at the price of scanning the active rows twice.  These rows are not
    made distinct, so the active target must be a set, as every load leaves it.
    """
    return split(active, src, key_sets) if prune else (active, None)


def _history(
    marked_active: DataFrame, inactive: DataFrame, as_set: bool, distinct_active: bool = True, aside: DataFrame | None = None
) -> DataFrame:
    """Marked active rows and untouched inactive rows.

    Strategies with set semantics make the active rows distinct, which after a join on
    the key needs no exchange; what they close is therefore distinct, so history stays a
    set from load to load and is not shuffled.  ``as_set`` repairs a history that holds
    repeats from elsewhere, at the price of a shuffle of all of it.
    """
    old = inactive.withColumn(MARK, F.lit(False))
    marked = marked_active.select(*old.columns)
    if distinct_active:
        marked = marked.distinct()
    if aside is not None:
        marked = marked.unionByName(aside.withColumn(MARK, F.lit(False)).select(*old.columns))
    return marked.unionByName(old.distinct() if as_set else old)


def _target(src: DataFrame, tgt: DataFrame, on_dropped: str) -> DataFrame:
    return align_to_source(tgt, src.schema, on_dropped)


def load_overwrite(src: DataFrame, tgt: DataFrame | None = None, *, audit: AuditSpec) -> Buckets:
    """The source replaces the target."""
    return Buckets(src, None, audit)


def load_append(src: DataFrame, tgt: DataFrame | None, *, audit: AuditSpec, on_dropped: str = "error") -> Buckets:
    """All source rows are added, the target stays as it is."""
    if tgt is None:
        return Buckets(src, None, audit)
    return Buckets(src, _target(src, tgt, on_dropped).withColumn(MARK, F.lit(False)), audit)


def load_append_new_keys(
    src: DataFrame, tgt: DataFrame | None, *, keys: Sequence[str], audit: AuditSpec, on_dropped: str = "error"
) -> Buckets:
    """Source rows with a key no active target row has are added."""
    if tgt is None:
        return Buckets(src, None, audit)
    tgt = _target(src, tgt, on_dropped)
    fresh = src.join(key_set(_active(tgt), keys), list(keys), "left_anti")
    return Buckets(fresh.select(*src.columns), tgt.withColumn(MARK, F.lit(False)), audit)


def load_conditional(
    src: DataFrame, tgt: DataFrame | None, *, condition: str | Column, audit: AuditSpec, on_dropped: str = "error"
) -> Buckets:
    """Active target rows that meet a condition are closed, all source rows added.

    The condition is taken as a whole (an OR in it cannot reach inactive rows)
    and a row for which it is NULL is kept.
    """
    if tgt is None:
        return Buckets(src, None, audit)
    tgt = _target(src, tgt, on_dropped)
    holds = F.expr(condition) if isinstance(condition, str) else condition
    closed = (F.col("is_active") == 1) & holds
    return Buckets(src, tgt.withColumn(MARK, F.coalesce(closed, F.lit(False))), audit, closed_flag=0, kept_flag=0)


def _load_by_presence(
    src: DataFrame, tgt: DataFrame, on: Sequence[str], audit: AuditSpec, on_dropped: str, **flags: int | None
) -> Buckets:
    """Active target rows whose ``on`` is not in the source are closed; source
    rows whose ``on`` is not in the active target are added."""
    tgt = _target(src, tgt, on_dropped)
    active = _active(tgt)
    marked = _matched(active, key_set(src, on), on).withColumn(MARK, ~F.col("_hit")).drop("_hit")
    fresh = src.join(key_set(active, on), list(on), "left_anti").select(*src.columns)
    return Buckets(fresh, _history(marked, _inactive(tgt), as_set=False, distinct_active=False), audit, **flags)


def load_checksum_all(src: DataFrame, tgt: DataFrame | None, *, audit: AuditSpec, on_dropped: str = "error") -> Buckets:
    """Compare by row hash only."""
    if tgt is None:
        return Buckets(src, None, audit)
    return _load_by_presence(src, tgt, ["hashkey"], audit, on_dropped, closed_flag=1, kept_flag=0)


def load_scd2_checksum(
    src: DataFrame, tgt: DataFrame | None, *, keys: Sequence[str], audit: AuditSpec, on_dropped: str = "error"
) -> Buckets:
    """Slowly changing dimension, type 2: compare the row hash per key.

    A row is unchanged when key and hash both match; flags of kept and closed
    rows stay.  A NULL hash counts as changed, so no row falls between buckets.
    """
    if tgt is None:
        return Buckets(src, None, audit)
    return _load_by_presence(src, tgt, [*keys, "hashkey"], audit, on_dropped)


def load_by_key(
    src: DataFrame,
    tgt: DataFrame | None,
    *,
    keys: Sequence[str],
    audit: AuditSpec,
    on_dropped: str = "error",
    history_as_set: bool = False,
    prune: bool = False,
) -> Buckets:
    """Active target rows whose key comes again are closed, even if identical.

    ``prune``: see :func:`_pruned`.
    """
    if tgt is None:
        return Buckets(src, None, audit)
    tgt = _target(src, tgt, on_dropped)
    active, aside = _pruned(_active(tgt), src, [keys], prune)
    marked = _matched(active, key_set(src, keys), keys).withColumnRenamed("_hit", MARK)
    history = _history(marked, _inactive(tgt), history_as_set, aside=aside)
    return Buckets(_active(src), history, audit, closed_flag=1, kept_flag=0)


def load_deact_key(
    src: DataFrame,
    tgt: DataFrame | None,
    *,
    deact: DataFrame | None,
    source_keys: Sequence[str],
    target_keys: Sequence[str],
    audit: AuditSpec,
    on_dropped: str = "error",
    history_as_set: bool = False,
) -> Buckets:
    """A feed of keys deactivates target rows (keys compared without case).

    New rows are active source rows whose hash survives in no active target row;
    a hash that is also on a closed row does not survive.
    """
    if tgt is None:
        return Buckets(src, None, audit)
    tgt = _target(src, tgt, on_dropped)
    names = [f"_k{i}" for i in range(len(target_keys))]
    active = _active(tgt).withColumns({n: F.upper(F.col(k).cast("string")) for n, k in zip(names, target_keys)})
    if deact is None:
        marked = active.withColumn(MARK, F.lit(False))
    else:
        feed = deact.select(*[F.upper(F.col(k).cast("string")).alias(n) for n, k in zip(names, source_keys)])
        marked = _matched(active, key_set(feed, names), names).withColumnRenamed("_hit", MARK)
    hashes = join_side(
        marked.filter(F.col("hashkey").isNotNull()), ["hashkey"], F.bool_or(MARK).alias("_gone")
    )
    surviving = hashes.filter(~F.col("_gone")).select("hashkey")
    fresh = _active(src).join(surviving, "hashkey", "left_anti").select(*src.columns)
    return Buckets(fresh, _history(marked, _inactive(tgt), history_as_set), audit, kept_flag=0)


def _date_state(df: DataFrame, keys: Sequence[str], date_col: str, newest: bool, out: str) -> DataFrame:
    """Per key what is needed to ask "is there a row of another hash on the far
    side of this date": the extreme date, its hash, and the extreme date among
    the other hashes.  One row per key, however many rows the key has."""
    extreme = F.max if newest else F.min
    order = F.col("_d").desc_nulls_last() if newest else F.col("_d").asc_nulls_last()
    per_hash = (
        df.filter(F.col("hashkey").isNotNull())
        .dropna(subset=list(keys))
        .groupBy(*keys, "hashkey")
        .agg(extreme(date_col).alias("_d"))
    )
    ranking = Window.partitionBy(KEY).orderBy(order, F.col("hashkey"))
    ranked = per_hash.select(packed(keys), "hashkey", "_d").withColumn("_rn", F.row_number().over(ranking))
    first_two = ranked.filter("_rn <= 2")
    with_second = first_two.withColumn("_other", F.lead("_d").over(ranking)).filter("_rn = 1")
    state = F.struct(F.col("hashkey").alias("hash"), F.col("_d").alias("date"), F.col("_other").alias("other_date"))
    return with_second.select(f"{KEY}.*", state.alias(out))


def _first_state(df: DataFrame, other: DataFrame, key_sets: Sequence[Sequence[str]], date_col: str, newest: bool):
    """``df`` plus ``_state``: the state of the first key set that has a match."""
    names = []
    for i, keys in enumerate(key_sets):
        names.append(f"_state{i}")
        df = df.join(_date_state(other, keys, date_col, newest, names[-1]), list(keys), "left")
    return df.withColumn("_state", F.coalesce(*names)).drop(*names)


def _far_date() -> Column:
    return F.when(F.col("hashkey") == F.col("_state.hash"), F.col("_state.other_date")).otherwise(F.col("_state.date"))


def load_multi_key_date(
    src: DataFrame,
    tgt: DataFrame | None,
    *,
    key_sets: Sequence[Sequence[str]],
    date_col: str,
    audit: AuditSpec,
    on_dropped: str = "error",
    history_as_set: bool = False,
    prune: bool = False,
) -> Buckets:
    """Alternative keys with a date rule.

    The first key set with a match decides.  An active target row is closed by a
    source row of another hash that is not older; an older source row is
    dropped; a source row without any match is added.  ``prune``: see :func:`_pruned`.
    """
    if tgt is None:
        return Buckets(src, None, audit)
    tgt = _target(src, tgt, on_dropped)
    active, aside = _pruned(_active(tgt), src, key_sets, prune)
    has_hash = F.col("hashkey").isNotNull()
    marked = _first_state(active, src, key_sets, date_col, newest=True)
    closed = has_hash & (F.col(date_col) <= _far_date())
    marked = marked.withColumn(MARK, F.coalesce(closed, F.lit(False))).drop("_state")
    seen = _first_state(src, active, key_sets, date_col, newest=False)
    fresh = seen.filter(F.col("_state").isNull() | (has_hash & (_far_date() <= F.col(date_col))))
    return Buckets(
        fresh.select(*src.columns),
        _history(marked, _inactive(tgt), history_as_set, aside=aside),
        audit,
        closed_flag=0,
        kept_flag=0,
    )


def load_key_date(
    src: DataFrame,
    tgt: DataFrame | None,
    *,
    keys: Sequence[str],
    date_col: str,
    audit: AuditSpec,
    on_dropped: str = "error",
    history_as_set: bool = False,
    prune: bool = False,
) -> Buckets:
    """As the alternative-key load, with one (composite) key."""
    return load_multi_key_date(
        src,
        tgt,
        key_sets=[keys],
        date_col=date_col,
        audit=audit,
        on_dropped=on_dropped,
        history_as_set=history_as_set,
        prune=prune,
    )


def scd2_helper(src: DataFrame, tgt: DataFrame, *, keys: Sequence[str], audit: AuditSpec) -> DataFrame:
    """Type 2 as a distinct union over the sorted column set."""
    out = load_scd2_checksum(src, tgt, keys=keys, audit=audit, on_dropped="drop").to_df()
    return out.select(*sorted(out.columns)).distinct()


def scd1_helper(src: DataFrame, tgt: DataFrame, *, keys: Sequence[str], id_col: str, audit: AuditSpec) -> DataFrame:
    """Type 1: changed rows take the source's values but keep the target's id.

    Target rows that the source does not have, and inactive rows, vanish.  The
    target's key must be unique; of several ids the smallest is kept.
    """
    active = _active(tgt)
    known = active.dropna(subset=list(keys))
    state = join_side(known, keys, F.min(id_col).alias("_id"), F.min("hashkey").alias("_hash"))
    same = active.join(key_set(src, [*keys, "hashkey"]), [*keys, "hashkey"], "left_semi")
    seen = src.join(state, list(keys), "left")
    changed = F.col("_hash").isNotNull() & ~F.coalesce(F.col("_hash") == F.col("hashkey"), F.lit(False))
    fresh = seen.filter(F.col("_hash").isNull() | changed).withColumns(
        {
            id_col: F.when(changed, F.col("_id")).otherwise(F.col(id_col)),
            "add_date": F.when(changed, F.lit(audit.batch_date)).otherwise(F.col("add_date")),
            "last_modified_date": F.when(changed, audit.now()).otherwise(F.col("last_modified_date")),
            "is_active": F.when(changed, F.lit(1)).otherwise(F.col("is_active")),
        }
    )
    out = union_bag([same.select(*src.columns), fresh.select(*src.columns)])
    return out.select(*sorted(out.columns)).distinct()


# Strategies by the name used in configuration.
LOADS: dict[str, Callable[..., Buckets]] = {
    "overwrite": load_overwrite,
    "append": load_append,
    "deact_key": load_deact_key,
    "conditional": load_conditional,
    "checksum_all": load_checksum_all,
    "by_key": load_by_key,
    "scd2_checksum": load_scd2_checksum,
    "key_date": load_key_date,
    "multi_key_date": load_multi_key_date,
    "append_new_keys": load_append_new_keys,
}
LOAD_MODES = ("active", "incremental", "full")


def unplanned_rows(src: DataFrame, column: str, plans: Mapping[str, object]) -> DataFrame:
    """Source rows whose value of ``column`` has no load plan."""
    known = [v.strip().lower() for v in plans]
    return src.filter(~F.coalesce(F.lower(F.trim(F.col(column).cast("string"))).isin(known), F.lit(False)))


def load_partitioned(
    src: DataFrame,
    tgt: DataFrame | None,
    *,
    column: str,
    plans: Mapping[str, tuple[str, dict]],
    audit: AuditSpec,
) -> DataFrame:
    """A strategy of its own for every configured value of ``column``.

    ``plans`` maps the value to (strategy name, its arguments).  Values with the same plan
    are one load, so the scans grow with the different plans, not with the values (a
    deactivation feed is one load per value).  Target rows of other values stay as they are.  Source rows of other values, NULL included, are an
    error: give them a plan or take them out first (:func:`unplanned_rows`).
    """
    rest = unplanned_rows(src, column, plans).select(column).limit(1).collect()
    if rest:
        raise ValueError(f"source rows without a load plan, e.g. {column} = {rest[0][0]!r}")
    value = F.lower(F.trim(F.col(column).cast("string")))
    together: dict[str, list[str]] = {}  # values that are loaded alike
    for name, (strategy, args) in plans.items():
        alike = repr((strategy, sorted(args.items()))) if strategy in _WITHIN else name
        together.setdefault(alike, []).append(name)
    parts = []
    for names in together.values():
        strategy, args = plans[names[0]]
        here = value.isin([n.strip().lower() for n in names])
        part = None if tgt is None else tgt.filter(here)
        if len(names) == 1 or part is None:
            parts.append(LOADS[strategy](src.filter(here), part, audit=audit, **args).to_df())
            continue
        # one load for all of them, in which the value is a part of every key
        ours, theirs = (d.filter(here).withColumn(VALUE, value) for d in (src, tgt))
        parts.append(_WITHIN[strategy](ours, theirs, audit=audit, **_keyed(args)).to_df().drop(VALUE))
    if tgt is not None:
        known = [v.strip().lower() for v in plans]
        parts.append(tgt.filter(~F.coalesce(value.isin(known), F.lit(False))).select(*src.columns))
    return reduce(DataFrame.unionByName, parts)


VALUE = "_value"


def _keyed(args: Mapping[str, object]) -> dict:
    """Arguments of a strategy whose keys hold within a value only."""
    out = dict(args)
    if "keys" in out:
        out["keys"] = [*out["keys"], VALUE]
    if "key_sets" in out:
        out["key_sets"] = [[*keys, VALUE] for keys in out["key_sets"]]
    return out


def _checksum_within(src: DataFrame, tgt: DataFrame, *, audit: AuditSpec, on_dropped: str = "error") -> Buckets:
    return _load_by_presence(src, tgt, [VALUE, "hashkey"], audit, on_dropped, closed_flag=1, kept_flag=0)


# Strategies that load several values of a partition column at once.
_WITHIN: dict[str, Callable[..., Buckets]] = {
    **{name: LOADS[name] for name in LOADS if name not in ("deact_key", "checksum_all")},
    "checksum_all": _checksum_within,
}


def _check_mode(mode: str, allowed_modes: Sequence[str]) -> None:
    if mode not in allowed_modes or mode not in LOAD_MODES:
        raise ValueError(f"load mode {mode!r} not allowed here; expected one of {tuple(allowed_modes)}")


def load(
    src: DataFrame,
    tgt: DataFrame | None,
    *,
    mode: str,
    strategy: str,
    audit: AuditSpec,
    allowed_modes: Sequence[str] = LOAD_MODES,
    **args,
) -> DataFrame:
    """Entry point by mode: ``full`` replaces the target, the others load into it.

    An absent or empty source is refused: with most strategies it would close or replace
    the whole target.  To find out, the source's plan is started here; a load that ends in
    a publish does without (:func:`metered_load`).
    """
    if src is None or src.isEmpty():
        raise ValueError(REFUSED.format(strategy))
    _check_mode(mode, allowed_modes)
    if mode == "full" or tgt is None:
        return src
    return LOADS[strategy](src, tgt, audit=audit, **args).to_df()


REFUSED = "no source rows: {} load refused, the target stays as it is"


def metered_load(
    src: DataFrame | None,
    tgt: DataFrame | None,
    metrics: Metrics,
    *,
    mode: str,
    strategy: str,
    audit: AuditSpec,
    allowed_modes: Sequence[str] = LOAD_MODES,
    **args,
) -> DataFrame:
    """The same load, counted by the write that runs it; no job is started here.

    ``metrics`` then knows ``source``, ``inserted`` and ``history`` (its rows, and how
    many of them were ``closed``).  Publish with ``metrics.not_empty("source", ...)`` as
    a guard to refuse an empty source.
    """
    if src is None:
        raise ValueError(REFUSED.format(strategy))
    _check_mode(mode, allowed_modes)
    watched = metrics.count("source", src)
    if mode == "full" or tgt is None:
        return watched
    # the source is observed in the branch that carries its rows, not in key sets
    inserted = metrics.count("inserted", LOADS[strategy](watched, tgt, audit=audit, **args).inserted)
    parts = LOADS[strategy](src, tgt, audit=audit, **args)
    if parts.history is not None:
        parts = replace(parts, history=metrics.count("history", parts.history, closed=F.count_if(MARK)))
    return replace(parts, inserted=inserted).to_df()
