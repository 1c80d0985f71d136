"""Loads that rewrite only the files with rows that change.

A load closes or re-flags a small part of a history.  Here the comparison runs twice:
narrow, over the key columns of all files, to find the files that hold a changed row, and
wide over those files only.  Their rows and the new rows are written; every other file is
carried over into the next version as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.audit import AuditSpec
from strataload.operators.incremental import LOADS, MARK, Buckets
from strataload.sources.versions import (
    Version,
    commit,
    files_of,
    read_files,
    version,
    versioned_publish,
    write_files,
)

FILE = "_file"


@dataclass(frozen=True)
class TouchedLoad:
    """What a load did to the files of a table."""

    version: Version
    kept: int
    rewritten: int
    written: int


def _changes(buckets: Buckets) -> Column:
    """Whether a row of the history is not the same after the load."""
    changed = F.col(MARK)
    if buckets.kept_flag is not None and "is_incremental" in buckets.history.columns:
        changed |= ~F.col("is_incremental").eqNullSafe(buckets.kept_flag)
    return changed


def _compared(strategy: str, args: Mapping[str, object]) -> set[str] | None:
    """Columns that decide which rows a strategy closes; None: any."""
    if strategy == "conditional":
        return None
    named: set[str] = {"hashkey", "is_active", "is_incremental"}
    for key in ("keys", "target_keys", "source_keys"):
        named.update(args.get(key, ()))
    for keys in args.get("key_sets", ()):
        named.update(keys)
    return named | {args["date_col"]} if "date_col" in args else named


def touched_files(src: DataFrame, tgt: DataFrame, *, strategy: str, audit: AuditSpec, **args) -> DataFrame:
    """Distinct ``_file`` of target rows that the load changes; ``tgt`` has that column.

    Only columns that the comparison needs are read from the target.
    """
    compared = _compared(strategy, args)
    wanted = [c for c in src.columns if compared is None or c in compared]
    ours = src.select(*wanted, F.lit(None).cast("string").alias(FILE))
    theirs = tgt.select(*[c for c in tgt.columns if c in wanted], FILE)
    buckets = LOADS[strategy](ours, theirs, audit=audit, **args)
    return buckets.history.filter(_changes(buckets)).select(FILE).distinct()


def load_touched_files(
    spark: SparkSession,
    src: DataFrame,
    path: str,
    *,
    strategy: str,
    audit: AuditSpec,
    partition_by: str | Sequence[str] = "is_active",
    details: Mapping[str, object] | None = None,
    **args,
) -> TouchedLoad:
    """Load stamped rows into the versioned table at ``path``, which may not exist yet.

    The rows of the new version are those of the same load over the whole table.  For
    strategies with set semantics that holds if the active target rows are a set, as
    every load leaves them: repeats in files that are not rewritten stay.  ``details`` go
    into the manifest of the version, so they are committed with the rows or not at all.
    """
    if strategy not in LOADS:
        raise ValueError(f"unknown load strategy {strategy!r}")
    at = version(spark, path)
    if at is None or strategy == "overwrite":
        made = versioned_publish(src, path, partition_by, parent=at.number if at else 0, **(details or {}))
        return TouchedLoad(made, 0, at.files if at else 0, made.files)
    entries = files_of(spark, at)
    names = [r.file for r in entries.select("file").collect()]
    tgt = read_files(spark, path, at, names)
    touched = [r[FILE] for r in touched_files(src, tgt, strategy=strategy, audit=audit, **args).collect()]
    # what is new is decided against the keys of all files, what is closed row by row
    fresh = LOADS[strategy](src, tgt.drop(FILE), audit=audit, **args).inserted
    if touched:
        part = read_files(spark, path, at, touched).drop(FILE)
        part = LOADS[strategy](src, part, audit=audit, **args)
        rows = Buckets(fresh, part.history, audit, part.closed_flag, part.kept_flag).to_df()
    else:
        rows = fresh
    new = write_files(rows, path, partition_by)
    gone = spark.createDataFrame([(t,) for t in touched], "file string")
    kept = entries.join(gone, "file", "left_anti")
    made = commit(spark, path, kept.unionByName(new), src.schema, at.partition_by, at.number, kind="load", strategy=strategy, **(details or {}))
    return TouchedLoad(made, len(names) - len(touched), len(touched), made.files - len(names) + len(touched))
