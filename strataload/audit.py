"""Audit columns: row hash, stamping of new rows and closing of old ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Audit column names, open end date and the mark for NULL in hashes.
AUDIT_COLUMNS = (
    "add_date",
    "delete_date",
    "last_modified_date",
    "is_active",
    "is_incremental",
    "data_version",
    "hashkey",
)
OPEN_END = dt.date(9999, 12, 31)
HASH_SEPARATOR = "-"
HASH_NULL = "-"


@dataclass(frozen=True)
class AuditSpec:
    """The clock of one load; passed in, so that a load is repeatable."""

    batch_date: dt.date
    batch_ts: dt.datetime
    version: str | None = None

    @property
    def closing_date(self) -> dt.date:
        return self.batch_date - dt.timedelta(days=1)

    def now(self) -> Column:
        return F.lit(self.batch_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def row_hash(columns: Sequence[str], strict: bool = False) -> Column:
    """md5 over the sorted columns.

    The default text form lets NULL collide with ``-`` and ``('a-b','c')`` with
    ``('a','b-c')``.  ``strict`` prefixes every part with its length (NULL has
    none), which removes both collisions and changes the hash values.
    """
    parts = []
    for name in sorted(columns):
        text = F.col(name).cast("string")
        if strict:
            text = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(text, F.lit(HASH_NULL)))
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def hash_columns(df: DataFrame, scd_columns: Sequence[str] = ()) -> list[str]:
    """Columns to hash: the tracked ones if any are named, else all but audit."""
    wanted = set(scd_columns) or set(df.columns) - set(AUDIT_COLUMNS)
    return sorted(c for c in df.columns if c in wanted)


def stamp(
    df: DataFrame,
    audit: AuditSpec,
    hash_cols: Sequence[str] | None = None,
    strict: bool = False,
    distinct: bool = True,
) -> DataFrame:
    """Mark rows as new in this batch; with ``hash_cols`` also distinct and hashed."""
    out = df
    if hash_cols is not None:
        out = out.distinct() if distinct else out
        out = out.withColumn("hashkey", row_hash(hash_cols or hash_columns(out), strict))
    stamps = {
        "add_date": F.lit(audit.batch_date),
        "delete_date": F.lit(OPEN_END),
        "last_modified_date": audit.now(),
        "is_active": F.lit(1),
        "is_incremental": F.lit(1),
    }
    if audit.version is not None:
        stamps["data_version"] = F.lit(audit.version)
    return out.withColumns(stamps)
