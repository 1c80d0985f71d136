"""Mapping-driven transforms: columns, joins and filters given as rows of text.

Cells hold Spark SQL expressions; they go to ``F.expr`` unchanged and the
surrounding select, join and union are DataFrame calls, so a whole mapping with
all its rule orders and sets is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.audit import AUDIT_COLUMNS
from strataload.schema import config_constants, union_bag

# Default date pattern and default order of unordered rules.
DEFAULT_FORMAT = "MM/dd/yyyy hh:mm:ss a"
_DATES = ("date", "timestamp", "timestamp_ntz")
LAST = 9999
JOIN_KINDS = {
    "join": "inner",
    "inner join": "inner",
    "left join": "left",
    "left outer join": "left",
    "right join": "right",
    "right outer join": "right",
    "full join": "full",
    "full outer join": "full",
}


@dataclass(frozen=True)
class MappingRow:
    """One row of a mapping.  ``kind`` is blank or ``primary`` for a column, a
    join, or ``where``; ``sql`` holds the column expression, ON text or filter."""

    column: str = ""
    table: str = ""
    source: str = ""
    alias: str = ""
    kind: str = ""
    sql: str = ""
    datatype: str = ""
    length: str = ""
    format: str = ""
    full_load_join: str = ""
    scd: str = ""
    standard_name: str = ""
    rule_order: int = LAST
    rule_set: int = LAST

    @property
    def name(self) -> str:
        return self.alias or self.table

    @property
    def join_how(self) -> str | None:
        return JOIN_KINDS.get(" ".join(self.kind.lower().split()))

    @property
    def is_where(self) -> bool:
        return self.kind.strip().lower() == "where"


def read_mapping(spark: SparkSession, path: str, **wanted: str) -> list[MappingRow]:
    """Active rows of a mapping file, filtered on trimmed lower-case columns.

    A mapping is configuration and ends on the driver, as literals do.
    """
    df = spark.read.csv(path, header=True, inferSchema=False).fillna("")
    df = df.filter(F.trim("is_active_map") == "1")
    for column, value in wanted.items():
        df = df.filter(F.lower(F.trim(F.col(column))) == value.strip().lower())
    known = {f.name for f in fields(MappingRow)}
    rows = []
    for row in df.collect():
        cells = {k: (v or "").strip() for k, v in row.asDict().items() if k in known}
        for order in ("rule_order", "rule_set"):
            cells[order] = int(cells.get(order) or LAST)
        rows.append(MappingRow(**cells))
    return rows


def driving_table(rows: Sequence[MappingRow]) -> str:
    """The one source that is not joined in."""
    joined = {r.name for r in rows if r.join_how}
    tables = dict.fromkeys(r.name for r in rows if r.table and r.name not in joined)
    if len(tables) != 1:
        raise ValueError(f"expected one driving table, found {sorted(tables)}")
    return next(iter(tables))


def primary_keys(rows: Sequence[MappingRow]) -> list[str]:
    return [r.column for r in rows if r.kind.strip().lower() == "primary"]


def tracked_columns(rows: Sequence[MappingRow]) -> list[str]:
    return [r.column for r in rows if r.scd.strip().upper() == "Y"]


def _text(row: MappingRow) -> str:
    if row.sql.strip():
        return row.sql.strip()
    return f"{row.name}.{row.source.strip()}" if row.source.strip() else "NULL"


def typed_column(row: MappingRow) -> Column:
    """Expression cast to the mapped type; text that does not parse gives NULL.

    Values that are dates or timestamps already are not parsed again.
    """
    value = F.expr(_text(row))
    kind = row.datatype.strip().lower()
    pattern = row.format.strip() or DEFAULT_FORMAT
    if kind == "date":
        text = F.try_to_date(value.cast("string"), pattern)
        out = F.when(F.typeof(value).isin(*_DATES), value.try_cast("date")).otherwise(text)
    elif kind == "timestamp":
        text = F.try_to_timestamp(value.cast("string"), F.lit(pattern))
        out = F.when(F.typeof(value).isin(*_DATES), value.try_cast("timestamp")).otherwise(text)
    elif kind in ("", "null") or "varchar" in kind:
        out = value.cast("string")
    else:
        out = value.try_cast(f"{kind}{row.length.strip()}")
    return out.alias(row.column.strip().lower())


def plain_column(row: MappingRow) -> Column:
    """Expression under its name; ``*`` passes all columns of the table."""
    if row.column.strip() == "*":
        return F.col(f"{row.name}.*")
    text = _text(row)
    value = F.lit(None).cast("string") if text == "NULL" else F.expr(text)
    return value.alias(row.column.strip().lower())


def _join_text(row: MappingRow, driving: str, mode: str) -> str:
    """ON text; in a full load the row may ask for valid or active rows only."""
    text = row.sql.strip()
    wanted = row.full_load_join.strip().lower()
    if mode != "full" or wanted in ("", "latest_record"):
        return text
    if wanted == "active":
        return f"{text} and {row.name}.is_active = 1"
    if wanted == "date_based":
        return f"{text} and {driving}.add_date between {row.name}.add_date and {row.name}.delete_date"
    raise ValueError(f"unknown full load join {wanted!r}")


def apply_mapping(
    tables: Mapping[str, DataFrame], rows: Sequence[MappingRow], mode: str = "active", typed: bool = True
) -> DataFrame:
    """Select, join and filter as the mapping rows say."""
    driving = driving_table(rows)
    by_name = {r.name: r.table for r in rows if r.table}
    out = tables[by_name[driving]].alias(driving)
    for row in rows:
        if row.join_how:
            out = out.join(tables[row.table].alias(row.name), F.expr(_join_text(row, driving, mode)), row.join_how)
    where = [r for r in rows if r.is_where]
    if where:
        out = out.filter(F.expr(where[0].sql))
    column = typed_column if typed else plain_column
    columns = [column(r) for r in rows if r.column.strip()]
    if not typed and mode == "full" and not any(r.column.strip() == "*" and r.name == driving for r in rows):
        have = tables[by_name[driving]].columns
        named = {r.column.strip().lower() for r in rows}
        columns += [
            F.col(f"{driving}.{c}") for c in AUDIT_COLUMNS if c in have and c != "hashkey" and c not in named
        ]
    return out.select(*columns)


def rule_groups(rows: Sequence[MappingRow]) -> list[list[MappingRow]]:
    """Rows by ascending rule order, then rule set."""
    groups: dict[tuple[int, int], list[MappingRow]] = {}
    for row in sorted(rows, key=lambda r: (r.rule_order, r.rule_set)):
        groups.setdefault((row.rule_order, row.rule_set), []).append(row)
    return list(groups.values())


def apply_all_rules(
    tables: Mapping[str, DataFrame],
    rows: Sequence[MappingRow],
    mode: str = "active",
    typed: bool = True,
    distinct: bool = False,
) -> DataFrame:
    """One frame per rule order and set, united over the merged columns."""
    frames = [apply_mapping(tables, group, mode, typed) for group in rule_groups(rows)]
    return union_bag([f.distinct() for f in frames] if distinct else frames)


def apply_per_source(
    sources: Mapping[str, Mapping[str, DataFrame]],
    rows: Sequence[MappingRow],
    constants: Mapping[str, Mapping[str, object]],
    mode: str = "active",
) -> DataFrame:
    """The same mapping for every source, each with its constants."""
    frames = []
    for name, tables in sources.items():
        frames.append(config_constants(apply_all_rules(tables, rows, mode), constants.get(name, {})))
    return union_bag(frames)


def sql_step(spark: SparkSession, text: str, tables: Mapping[str, DataFrame], schemas: Mapping[str, str] = {}):
    """A SQL transform over DataFrames named ``{name}`` in its text.

    ``schemas`` gives the source for each schema alias: ``src1_schema.orders``
    reads the frame called ``<source>_orders``.
    """
    for alias, source in schemas.items():
        text = text.replace(f"{{{alias}.", f"{{{source}_")
    return spark.sql(text, **tables)


def run_steps(
    inputs: Mapping[str, DataFrame], steps: Mapping[str, str], keep: Sequence[str] | None = None
) -> DataFrame:
    """Chained SQL steps; the last one wins.  ``keep`` limits its columns."""
    spark = next(iter(inputs.values())).sparkSession
    frames = dict(inputs)
    out = None
    for name, text in steps.items():
        out = frames[name] = spark.sql(text, **{k: v for k, v in frames.items() if f"{{{k}}}" in text})
    if out is None:
        raise ValueError("no steps given")
    return out if keep is None else out.select(*[c for c in out.columns if c in keep])


def distinct_rows(df: DataFrame, name: str, steps: Mapping[str, str]) -> DataFrame:
    """A row-reducing script on one table, limited to the table's columns."""
    return run_steps({name: df}, steps, keep=df.columns)


def with_order(rows: Sequence[MappingRow], rule_order: int, rule_set: int = LAST) -> list[MappingRow]:
    return [replace(r, rule_order=rule_order, rule_set=rule_set) for r in rows]
