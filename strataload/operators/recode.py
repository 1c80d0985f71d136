"""Masking of listed codes and restricted names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.operators.identity import append_ids
from strataload.operators.lookup import contains_lookup
from strataload.operators.skew import join_side, key_set
from strataload.schema import distinct_values


def recode_multi_value(df: DataFrame, column: str, hidden: DataFrame, code: str, sep: str = "^") -> DataFrame:
    """Drop the items of a list column that are in ``hidden``; order is kept.

    Works on the distinct lists, so no row id is needed and a list that many
    rows share is handled once.  An emptied list becomes NULL, no row is lost.
    """
    lists = df.select(F.col(column).alias("_list")).filter(F.col("_list").isNotNull()).distinct()
    items = lists.select("_list", F.posexplode(F.split("_list", "\\Q" + sep + "\\E", -1)).alias("_at", "_item"))
    codes = key_set(hidden.select(F.col(code).cast("string").alias("_item")), ["_item"])
    left = items.join(codes.withColumn("_hit", F.lit(True)), "_item", "left")
    shown = F.when(F.col("_hit").isNull(), F.struct("_at", "_item"))
    done = join_side(left, ["_list"], F.array_sort(F.collect_list(shown)).alias("_left"))
    text = F.array_join(F.transform("_left", lambda s: s["_item"]), sep)
    done = done.select("_list", F.when(F.trim(text) != "", text).alias("_new"))
    out = df.join(done, df[column] == done["_list"], "left")
    return out.select(*[F.col("_new").alias(c) if c == column else df[c] for c in df.columns])


def update_name_dictionary(
    df: DataFrame,
    columns: Sequence[str],
    restricted: DataFrame,
    dictionary: DataFrame | None,
    pattern: str = "name_pattern",
    match_type: str = "match_type",
    priority: str = "priority",
) -> DataFrame:
    """The dictionary plus the names it does not know, each with its best
    restricted row.  NULL is a name; ids go on from the highest one."""
    found = distinct_values(df, columns)
    best = contains_lookup(found, "name", restricted, pattern, match_type, priority)
    described = found.join(best, "name", "left")
    return append_ids(dictionary, described, keys=["name"], id_col="id")


def recode_restricted(
    df: DataFrame,
    columns: Mapping[str, str],
    restricted: DataFrame,
    dictionary: DataFrame,
    flag: str,
    pattern: str = "name_pattern",
    priority: str = "priority",
) -> DataFrame:
    """Replace the names of restricted rows by numbered templates.

    ``columns`` maps each name column to its template column.  A row is
    restricted (``flag`` = 1) when any name has a dictionary entry with a
    pattern.  Then every non-blank name becomes its own template, or else that
    of the row's first hit, with ``<x>`` replaced by the name's dictionary id.
    """
    templates = sorted(set(columns.values()))
    out = df
    for i, column in enumerate(columns):
        entry = F.struct("id", F.col(pattern).alias("pattern"), *templates).alias(f"_e{i}")
        side = dictionary.select(F.col("name").alias(f"_n{i}"), entry)
        out = out.join(side, F.col(column).eqNullSafe(F.col(f"_n{i}")), "left").drop(f"_n{i}")
    entries = [f"_e{i}" for i in range(len(columns))]
    out = out.withColumn("_hit", F.upper(F.coalesce(*[F.col(f"{e}.pattern") for e in entries])))
    order = F.struct(F.col(priority).isNull(), F.col(priority), F.col(pattern), F.struct(*templates).alias("row"))
    texts = restricted.select("*", F.upper(F.col(pattern)).alias("_hit")).dropna(subset=["_hit"])
    default = join_side(texts, ["_hit"], F.min(order).alias("_o")).select("_hit", F.col("_o.row").alias("_default"))
    out = out.join(default, "_hit", "left")
    hit = F.col("_hit").isNotNull()

    def recoded(i: int, column: str, template: str) -> Column:
        own = F.coalesce(F.col(f"_e{i}.{template}"), F.col(f"_default.{template}"))
        text = F.replace(own, F.lit("<x>"), F.col(f"_e{i}.id").cast("string"))
        blank = F.col(column).isNull() | (F.trim(F.col(column)) == "")
        return F.when(~hit | blank, F.col(column)).otherwise(text)

    new = {c: recoded(i, c, template) for i, (c, template) in enumerate(columns.items())}
    rest = [F.col(c) for c in df.columns if c not in new]
    return out.select(*rest, *[v.alias(c) for c, v in new.items()], hit.cast("int").alias(flag))
