"""Master records over several sources of the same entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.audit import AUDIT_COLUMNS, AuditSpec, hash_columns, stamp
from strataload.operators.identity import coalesce_update
from strataload.operators.skew import join_side
from strataload.schema import union_bag


def _source(column: str) -> Column:
    return F.lower(F.col(column))


def created_masters(df: DataFrame, master: str, children: Sequence[str], keys: Sequence[str], source_col: str) -> DataFrame:
    """Rows of the first child source, relabelled, for keys the master lacks.

    One partial aggregate per key finds whether the master has it and which
    child comes first; no loop over the children.  A NULL key equals nothing,
    so its child rows are all relabelled.
    """
    place = F.lit(None).cast("int")
    for i, child in reversed(list(enumerate(children))):
        place = F.when(_source(source_col) == child.lower(), F.lit(i)).otherwise(place)
    known = _source(source_col) == master.lower()
    mine = df.filter(known | place.isNotNull()).dropna(subset=list(keys))
    state = join_side(mine, keys, F.bool_or(known).alias("_has"), F.min(place).alias("_first"))
    rows = df.withColumn("_place", place).filter(F.col("_place").isNotNull())
    wins = F.coalesce(~F.col("_has") & (F.col("_place") == F.col("_first")), F.lit(True))
    winners = rows.join(state, list(keys), "left").filter(wins)
    return winners.withColumn(source_col, F.lit(master)).select(*df.columns)


def master_waterfall(df: DataFrame, master: str, children: Sequence[str], keys: Sequence[str], source_col: str) -> DataFrame:
    """The base rows together with the created master rows, repeats removed."""
    return df.unionByName(created_masters(df, master, children, keys, source_col)).distinct()


def cross_update(
    df: DataFrame,
    master: str,
    views: Mapping[str, DataFrame],
    keys: Sequence[str],
    columns: Sequence[str],
    source_col: str,
) -> DataFrame:
    """Master rows take flagged columns from the update views in order."""
    return coalesce_update(df.filter(_source(source_col) == master.lower()), views, keys, columns)


def with_masters(
    df: DataFrame,
    master: str,
    children: Sequence[str],
    keys: Sequence[str],
    source_col: str,
    views: Mapping[str, DataFrame],
    update_keys: Sequence[str],
    update_columns: Sequence[str],
) -> DataFrame:
    """Base rows of the other sources plus the completed master rows."""
    combined = master_waterfall(df, master, children, keys, source_col)
    masters = cross_update(combined, master, views, update_keys, update_columns, source_col)
    others = df.filter(~_source(source_col).eqNullSafe(master.lower()))
    return others.unionByName(masters)


def source_list(
    df: DataFrame, keys: Sequence[str], source_col: str, out: str = "data_source_id_list", repeats: bool = True
) -> DataFrame:
    """Every row with the sorted, comma-joined sources of its key.

    A source is named once per distinct row of the key; ``repeats=False`` names it once.
    Rows are first reduced to one per key and source with a count, so a hot key travels
    as no more rows than there are sources.
    """
    rows = df.distinct()
    name = F.col(source_col).cast("string")
    if repeats:
        counted = rows.groupBy(*keys, source_col).agg(F.count(F.lit(1)).cast("int").alias("_n"))
        listed = F.flatten(F.collect_list(F.array_repeat(name, F.col("_n"))))
    else:
        counted = df.select(*keys, source_col).distinct()
        listed = F.collect_list(name)
    named = counted.filter(F.col(source_col).isNotNull())
    lists = join_side(named, keys, F.concat_ws(",", F.array_sort(listed)).alias(out))
    return rows.join(lists, list(keys), "left").select(*df.columns, out)


def distinct_sources(df: DataFrame, source_col: str) -> DataFrame:
    return df.select(source_col).distinct()


def memberships(masters: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """Masters that contain each source, earlier masters opened up."""
    contents: dict[str, list[str]] = {}
    for master, children in masters.items():
        inner = [x for child in children for x in contents.get(child, [])]
        contents[master] = list(dict.fromkeys([*inner, *children]))
    out: dict[str, list[str]] = {}
    for master, sources in contents.items():
        for source in sources:
            out.setdefault(source, []).append(master)
    return out


def source_flags(
    df: DataFrame,
    sources: Sequence[str],
    masters: Mapping[str, Sequence[str]],
    source_col: str,
    list_col: str = "data_source_id_list",
) -> DataFrame:
    """A 0/1 column per source: it contributed to the key and the row belongs to
    it or to a master that contains it."""
    inside = memberships(masters)
    listed = F.split(F.col(list_col), ",")

    def flag(source: str) -> Column:
        mine = F.col(source_col).isin(source, *inside.get(source, []))
        return F.coalesce(F.array_contains(listed, source) & mine, F.lit(False)).cast("int")

    return df.withColumns({s.lower(): flag(s) for s in sources})


def master_final(df: DataFrame, masters: Sequence[str], source_col: str, audit: AuditSpec) -> DataFrame:
    """Only master rows, with fresh audit columns and hash."""
    rows = df.filter(F.col(source_col).isin(*masters)).drop(*AUDIT_COLUMNS)
    return stamp(rows, audit, hash_cols=hash_columns(rows), distinct=False)


def combine_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Mapped sources, each distinct, united over the merged columns."""
    return union_bag([f.distinct() for f in frames])
