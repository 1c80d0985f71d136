"""Outbound extracts and the control tables that go with them."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.plans.mapping import LAST
from strataload.schema import drop_excluded, union_bag
from strataload.sources.scan import list_files, read_delimited

LOAD_TYPES = ("full", "incremental")


@dataclass(frozen=True)
class ExtractField:
    field: str
    datatype: str = "string"
    new_name: str = ""
    length: str = ""
    format: str = ""
    sql: str = ""
    order: int = LAST


@dataclass(frozen=True)
class ExtractSpec:
    """``template`` is SQL with ``<included_fields>``, ``<table:$1>`` (table),
    ``<table:$2>`` (alias), ``<add_date>`` and schema-qualified table names
    ``<extract_source_schema>.t``, ``<extract_lookup_schema>.t`` (a
    ``<layer:$n>.`` or ``<source:$n>.`` part may stand before the table)."""

    table: str
    alias: str
    template: str
    fields: tuple[ExtractField, ...]
    filter_full: str = ""
    filter_incremental: str = ""
    sources: tuple[str, ...] = ()


def field_text(field: ExtractField, alias: str) -> str:
    name = field.new_name.strip() or field.field
    kind = field.datatype.strip().lower()
    source = f"{alias}.{field.field}" if alias else field.field
    if field.sql.strip():
        text = field.sql.strip()
    elif kind == "time":
        text = f"date_format({source}, '{field.format}')"
    elif kind.startswith("varchar") or kind == "string":
        text = f"cast({source} as string)"
    else:
        text = f"try_cast({source} as {kind}{field.length.strip()})"
    return f"{text} as {name}"


def field_texts(fields: Sequence[ExtractField], alias: str) -> list[str]:
    if not fields:
        raise ValueError("no fields included in the extract")
    return [field_text(f, alias) for f in sorted(fields, key=lambda f: f.order)]


def project(df: DataFrame, fields: Sequence[ExtractField], alias: str) -> DataFrame:
    """Extract columns of one table, in field order."""
    return df.alias(alias).selectExpr(*field_texts(fields, alias))


_WHERE = re.compile(r"\bwhere\b", re.I)
_OUTER = re.compile(r"'(?:[^'\\]|\\.)*'|\([^()]*\)")  # literals and innermost brackets
_TABLE = re.compile(r"<extract_(?:source|lookup)_schema>\.(?:<layer:\$\d+>\.)?(?:<source:\$(\d+)>\.)?(\w+)")


def _as_text(df: DataFrame) -> DataFrame:
    """Columns of a length-limited type as plain text; their values stay."""
    limited = [f.name for f in df.schema.fields if f.dataType.typeName() in ("varchar", "char")]
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in limited}) if limited else df


def build_extract(
    spark: SparkSession, spec: ExtractSpec, tables: Mapping[str, DataFrame], load_type: str, add_date: str = ""
) -> DataFrame:
    """Run an extract template over ``tables``.

    A table behind ``<source:$n>`` is looked up as ``<source>_<table>``.  Rows
    flagged as excluded are removed from every table that has the flag.
    """
    if load_type not in LOAD_TYPES:
        raise ValueError(f"unknown load type {load_type!r}")
    extra = (spec.filter_full if load_type == "full" else spec.filter_incremental).strip()
    text = spec.template
    if extra:
        text += (" and " if _WHERE.search(_OUTER.sub(" ", text)) else " where ") + extra
    text = text.replace("<table:$1>", spec.table).replace("<table:$2>", spec.alias)
    used: dict[str, DataFrame] = {}

    def placeholder(match: re.Match) -> str:
        source, table = match.groups()
        name = f"{spec.sources[int(source) - 1]}_{table}" if source else table
        used[name] = drop_excluded(tables[name])
        return f"{{{name}}}"

    text = _TABLE.sub(placeholder, text)
    text = text.replace("<included_fields>", ", ".join(field_texts(spec.fields, spec.alias)))
    text = text.replace("<add_date>", f"'{add_date}'")
    return _as_text(spark.sql(text, **used))


# --- control tables ------------------------------------------------------------
# The column names of the control tables.


def _read(spark: SparkSession, path: str, kind: str, sep: str) -> DataFrame:
    return spark.read.parquet(path) if kind == "parquet" else read_delimited(spark, path, sep=sep)


def _plain_path(path: Column) -> Column:
    """Without the scheme's slashes, which listing and scan write differently."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _data_files(spark: SparkSession, path: str) -> DataFrame:
    """Files with their path (``_file``) and the part of it below ``path``, else their name."""
    files = list_files(spark, path)
    name = F.element_at(F.split("path", "/"), -1)
    base = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path).rstrip("/") + "/"
    at = F.instr("path", base)
    below = F.when(at > 0, F.expr("substring(path, _at)")).otherwise(name)
    found = files.withColumn("_at", at + len(base)).select(
        _plain_path(F.col("path")).alias("_file"), below.alias("file_name"), name.alias("_name"), "size"
    )
    return found.filter(~F.col("_name").startswith("_") & ~F.col("_name").startswith(".")).drop("_name")


def file_control(
    spark: SparkSession, path: str, table: str, export_date: str, kind: str = "parquet", sep: str = ","
) -> DataFrame:
    """One line per file: size in bytes and rows, in one pass over all files.

    Row counts come from the scan's file metadata; files without rows come from
    the listing.  Files are told apart by their full path, since one task writes the
    same name into every partition folder; ``file_name`` is the path below the table.
    """
    scan = _read(spark, path, kind, sep)
    # the scan gives an encoded URI, the listing a path
    read = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    counts = scan.groupBy(_plain_path(read).alias("_file")).agg(F.count(F.lit(1)).alias("rows"))
    files = _data_files(spark, path).join(counts, "_file", "left")
    return files.select(
        F.lit(f"{table}/").alias("Path"),
        "file_name",
        F.col("size").alias("size_KB"),
        F.lit(export_date).alias("export_date"),
        F.coalesce("rows", F.lit(0)).alias("row_counts"),
    )


def control_totals(files: DataFrame) -> DataFrame:
    """One line per table from its file lines: rows and number of files."""
    return files.groupBy("Path").agg(
        F.sum("row_counts").alias("Row_Count"),
        F.max("export_date").alias("Export_Date"),
        F.count(F.lit(1)).alias("File_Count"),
    )


def control_totals_v2(
    files: DataFrame,
    folder: str,
    version: str,
    load_type: str,
    schema: str = "",
    load_function: str = "",
    zorder_by: str = "",
) -> DataFrame:
    """The wider form; unknown settings read ``NA``."""

    def known(value: str) -> Column:
        return F.lit(value or "NA")

    totals = control_totals(files)
    return totals.select(
        F.rtrim(F.col("Path"), F.lit("/")).alias("EXTRACT_TABLE_NAME"),
        F.lit(f"{folder.rstrip('/')}/").alias("EXTRACT_FOLDER_PATH"),
        F.col("Export_Date").alias("EXPORT_DATE"),
        F.col("File_Count").alias("FILE_COUNT"),
        F.col("Row_Count").alias("RECORD_COUNT"),
        F.lit(version).alias("DATA_VERSION"),
        known(schema).alias("SCHEMA_NAME"),
        F.lit(load_type).alias("LOAD_TYPE"),
        known(load_function).alias("LOAD_FUNCTION"),
        known(zorder_by).alias("ZORDER_BY"),
    )


def data_dictionary(df: DataFrame, table: str) -> DataFrame:
    """Folder, field and type of every column."""
    rows = [(f"{table}/", name, kind) for name, kind in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "folder string, field_name string, data_type string")


def collect_summaries(frames: Sequence[DataFrame], path_column: str = "Path", missing: str | None = None) -> DataFrame:
    """Summaries of many extracts as one, without trailing slash in the path."""
    out = union_bag(frames)
    if path_column in out.columns:
        out = out.withColumn(path_column, F.rtrim(F.col(path_column), F.lit("/")))
    return out if missing is None else out.fillna(missing)
