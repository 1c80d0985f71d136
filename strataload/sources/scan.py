"""Reading tables and feeds.

Scans stay declarative: a filter on ``is_active`` prunes the partition folder,
column selection reaches the file reader, and a list of files is one scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataload.operators.skew import key_set
from strataload.sources.headers import read_by_header

LOAD_SCOPES = ("full", "active", "incremental")


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop_path(spark, path)
    return fs.exists(jpath)


def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema=None) -> DataFrame | None:
    """One folder or a list; list members that do not exist are skipped.

    Returns None when nothing is there.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    found = [p for p in wanted if path_exists(spark, p)]
    if not found:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*found)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    encoding: str = "utf-8",
    infer: bool = False,
) -> DataFrame:
    """Delimited text; every column is a string unless ``infer`` is set."""
    wanted = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.csv(wanted, sep=sep, quote=quote, header=header, encoding=encoding, inferSchema=infer)


def master_feed(spark: SparkSession, paths: str | Sequence[str], encoding: str = "utf-8", infer: bool = False):
    """A master feed: delimited text without repeated rows."""
    return read_delimited(spark, paths, encoding=encoding, infer=infer).distinct()


def active_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_active") == 1)


def incremental_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_incremental") == 1)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str = "add_date", ties: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key, nulls last, exactly one.

    Spark limits each map task to one row per key before the shuffle, so a hot
    key does not travel.  ``ties`` makes the choice between equal dates repeatable.
    """
    ranking = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *[F.col(c).desc() for c in ties])
    return df.withColumn("_rn", F.row_number().over(ranking)).filter("_rn = 1").drop("_rn")


def read_scope(
    df: DataFrame,
    mode: str,
    role: str = "driving",
    keys: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> DataFrame:
    """Rows of a table that a load of ``mode`` looks at.

    ``driving`` tables give all, active or changed rows.  ``other`` tables give
    active rows, or in a full load everything (latest row per key if ``keys``).
    ``master`` feeds always give everything.
    """
    if mode not in LOAD_SCOPES:
        raise ValueError(f"unknown load mode {mode!r}")
    if role == "master":
        return df
    if role == "driving":
        return {"full": lambda d: d, "active": active_rows, "incremental": incremental_rows}[mode](df)
    if mode != "full":
        return active_rows(df)
    return latest_per_key(df, keys, ties=ties) if keys else df


def as_strings(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_staging(
    spark: SparkSession,
    files: Sequence[str],
    kind: str = "delimited",
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
) -> DataFrame:
    """A list of feed files as one frame, all columns strings; a workbook in it is an error.

    Files whose columns differ are matched by name: a scan per distinct header.
    """
    usable = list(files)
    workbooks = [f for f in usable if f.lower().endswith((".xlsx", ".xls"))]
    if workbooks:
        raise ValueError(f"workbooks cannot be read as a feed: {workbooks}")
    if not usable:
        raise ValueError("no feed file in the list")
    if kind == "parquet":
        return as_strings(spark.read.option("mergeSchema", "true").parquet(*usable))
    return read_by_header(spark, usable, sep, quote, header)


def read_like(spark: SparkSession, folder: str, example: str, kind: str = "parquet", **options) -> DataFrame:
    """All files of a folder named like ``example`` without its digits, as strings.

    ``options`` of delimited files are those of :func:`read_by_header`.
    """
    stem = re.sub(r"\d", "", example.rsplit("/", 1)[-1]).split(".")[0].strip("_")
    target = f"{folder.rstrip('/')}/{stem}*"
    if kind == "parquet":
        return as_strings(spark.read.option("mergeSchema", "true").parquet(target))
    return read_by_header(spark, target, **options)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size and time of every file below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _bare_name(name: Column) -> Column:
    """Without digits and without empty ``_`` parts."""
    plain = F.trim(F.regexp_replace(name, r"\d", ""))
    return F.array_join(F.filter(F.split(plain, "_"), lambda part: part != ""), "_")


def select_feed_files(
    listing: DataFrame,
    table: str,
    extension: str = "",
    match: str = "fixed",
    kind: str = "file",
    path: str = "path",
) -> DataFrame:
    """Files of a listing that feed ``table``.

    ``fixed`` compares the bare file name, ``pattern`` looks for the table name
    in it; ``directory`` takes folders named like the table.
    """
    table = table.strip().lower()
    full = F.lower(F.trim(F.col(path)))
    if kind == "directory":
        return listing.filter(full.endswith(f"{table}/"))
    if kind != "file" or match not in ("fixed", "pattern"):
        raise ValueError(f"unknown file selection {kind!r}/{match!r}")
    suffix = extension.strip().lower()
    if suffix and not suffix.startswith("."):
        suffix = f".{suffix}"
    last = F.element_at(F.split(full, "/"), -1)
    if suffix:
        last = F.regexp_replace(last, f"^(.*){re.escape(suffix)}", "$1")
    bare_table = "_".join(p for p in re.sub(r"\d", "", table).split("_") if p)
    name = _bare_name(last)
    if match == "fixed":
        hit = name.isin(table, bare_table)
    else:
        hit = name.contains(table) | name.contains(bare_table)
    return listing.filter(hit & ~F.col(path).endswith("/"))


def manifest_filter(manifest: DataFrame, source: str, dataset: str, market: str) -> DataFrame:
    """Manifest rows of one feed, compared trimmed and without case."""

    def same(column: str, value: str) -> Column:
        return F.lower(F.trim(F.col(column))) == value.strip().lower()

    return manifest.filter(same("src", source) & same("dataset", dataset) & same("data_source", market))


def check_manifest(rows: DataFrame) -> DataFrame:
    """The manifest rows, or an error when there are none."""
    if not rows.limit(1).count():
        raise LookupError("no manifest row for this source, dataset and market")
    return rows


def required_missing(manifest: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    """Datasets marked available whose path is not in the listing."""
    required = manifest.filter(F.trim(F.col("is_file_available").cast("string")) == "1")
    return required.join(key_set(listing, [path]), path, "left_anti")


def check_required(manifest: DataFrame, listing: DataFrame, path: str = "path") -> None:
    """Raise when required datasets are missing, naming all of them (a manifest is configuration)."""
    missing = sorted(r[0] for r in required_missing(manifest, listing, path).select(path).collect())
    if missing:
        raise FileNotFoundError(f"{len(missing)} required inputs missing: {missing}")
