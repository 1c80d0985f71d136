"""Delimited feeds whose files do not share one header.

Spark takes the header of one file for all files of a scan, so columns that another
file has in a different place, lacks or adds would be read by position.  Here the first
line of every file is read by a narrow scan, files with the same header become one scan,
and the scans are united by name.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.schema import union_bag

# A file is one split, alone in its task, so a task stops after the first line of its file.
_ALONE = str(1 << 40)


@dataclass(frozen=True)
class HeaderGroup:
    """Files that share a header; ``columns`` as the file spells them."""

    columns: tuple[str, ...]
    files: tuple[str, ...]


def _literal(path: str) -> str:
    """A path from a scan's metadata as a path to read: no URI escapes, no glob signs."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path))


def first_lines(spark: SparkSession, paths: Sequence[str], encoding: str = "utf-8") -> list[tuple[str, str]]:
    """(file, first line that is not blank) of all files; files without such a line are left out.

    One task per file reads its first line and ends.  The lines come to the driver, as
    the files' names do in any scan.
    """
    side = spark.newSession()  # its settings hold for this scan only
    for key in ("openCostInBytes", "maxPartitionBytes"):
        side.conf.set(f"spark.sql.files.{key}", _ALONE)
    side.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    side.conf.set("spark.sql.files.ignoreCorruptFiles", spark.conf.get("spark.sql.files.ignoreCorruptFiles"))
    lines = side.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"), F.col("_metadata.file_block_start").alias("at")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()):
                text = line.decode(encoding, "replace").removeprefix("﻿").rstrip("\r")
                if text.strip():
                    yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([text])], names=["file", "line"])
                    return

    rows = lines.filter("at = 0").select("file", "line").mapInArrow(run, "file string, line string").collect()
    return sorted((r.file, r.line) for r in rows)


def header_groups(
    spark: SparkSession, paths: Sequence[str], sep: str = ",", quote: str = '"', header: bool = True, encoding: str = "utf-8"
) -> list[HeaderGroup]:
    """Files by their header, or without headers by their number of columns."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in first_lines(spark, paths, encoding):
        names = next(csv.reader([line], delimiter=sep, quotechar=quote or None, quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE))
        columns = tuple(names) if header else tuple(f"_c{i}" for i in range(len(names)))
        groups.setdefault(columns, []).append(_literal(file))
    return [HeaderGroup(columns, tuple(files)) for columns, files in sorted(groups.items())]


def _unique(columns: Sequence[str]) -> bool:
    names = [c.strip().lower() for c in columns]
    return all(names) and len(set(names)) == len(names)


def read_by_header(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    encoding: str = "utf-8",
) -> DataFrame:
    """Delimited files as one frame of strings, columns matched by name.

    Names are compared trimmed and without case, the first spelling (by file name) is
    kept; a column that a file lacks is NULL for its rows.  A header that names a column
    twice or not at all is an error when other files have another header.  Files without
    headers are matched by position, shorter ones filled with NULL.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    groups = sorted(header_groups(spark, wanted, sep, quote, header, encoding), key=lambda g: g.files)
    options = {"sep": sep, "quote": quote, "header": header, "encoding": encoding}
    if not groups or (len(groups) == 1 and not _unique(groups[0].columns)):
        return spark.read.csv(wanted, **options)
    spelling: dict[str, str] = {}
    frames = []
    for group in groups:
        if not _unique(group.columns):
            raise ValueError(f"header {list(group.columns)} of {group.files[0]} does not name every column once")
        names = [spelling.setdefault(c.strip().lower(), c.strip()) for c in group.columns]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        frames.append(spark.read.schema(schema).csv(list(group.files), **options))
    return frames[0] if len(frames) == 1 else union_bag(frames)
