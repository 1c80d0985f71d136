"""Tables with committed versions.

A versioned table is a folder with data files that are never changed and a log:

    <path>/data/_write=<id>/[<partition>=<value>/...]part-*.parquet
    <path>/files/<id>/*.parquet      one row per data file of a version
    <path>/commits/<number>.json     one small manifest per version, naming its file list

A version is published by creating its manifest, which fails if that number exists: of
two writers that start from the same version one commits, the other is told.  There is
no moment without a table and nothing is moved or copied.  A reader takes the newest
manifest when it starts and the files of its version stay, so later versions do not
disturb it until :func:`expire_versions` removes what no kept version names.

The list of a version carries over the entries of files that it keeps, so replacing a
part of a table writes only that part (:func:`commit`).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.sources.scan import _hadoop_path
from strataload.sources.sink import present_columns

WRITE = "_write"
FILE_LIST = "file string, partition map<string,string>, rows long, bytes long"


class CommitConflict(RuntimeError):
    """Another writer has committed the version number."""


@dataclass(frozen=True)
class Version:
    """The manifest of a version."""

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    file_list: str
    files: int
    rows: int
    parent: int
    at: str
    details: dict = field(default_factory=dict)

    def text(self) -> str:
        plain = {**self.__dict__, "schema": self.schema.jsonValue(), "partition_by": list(self.partition_by)}
        return json.dumps(plain, sort_keys=True)

    @staticmethod
    def parse(text: str) -> Version:
        plain = json.loads(text)
        plain["schema"], plain["partition_by"] = T.StructType.fromJson(plain["schema"]), tuple(plain["partition_by"])
        return Version(**plain)


def _commit_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/commits/{number:012d}.json"


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _hadoop_path(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all its content, or return False if there is one.

    The text is written beside the place and renamed to it; a rename does not replace a
    file on HDFS.  On a local disk it would, so there a hard link is made instead.
    """
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, at = _hadoop_path(spark, draft)
    _, final = _hadoop_path(spark, path)
    stream = fs.create(at, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(unquote(urlparse(at.toString()).path), unquote(urlparse(final.toString()).path))
            return True
        return not fs.exists(final) and fs.rename(at, final)
    except FileExistsError:
        return False
    finally:
        fs.delete(at, False)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    fs, folder = _hadoop_path(spark, f"{path.rstrip('/')}/commits")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def version(spark: SparkSession, path: str, number: int | None = None, before: dt.datetime | None = None) -> Version | None:
    """The manifest of a version: by number, the newest one committed before a time (UTC),
    or the newest of all; None if there is none."""
    known = versions(spark, path)
    if number is not None:
        if number not in known:
            raise LookupError(f"{path} has no version {number}")
        return Version.parse(_read_text(spark, _commit_path(path, number)))
    for candidate in reversed(known):
        found = Version.parse(_read_text(spark, _commit_path(path, candidate)))
        if before is None or dt.datetime.fromisoformat(found.at) < before:
            return found
    return None


def files_of(spark: SparkSession, at: Version) -> DataFrame:
    """One row per data file of a version: file (below ``data``), partition, rows, bytes."""
    return spark.read.schema(FILE_LIST).parquet(at.file_list)


def _decoded(text: Column) -> Column:
    """Without percent escapes; a plus sign is one."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _below_data() -> Column:
    """The path of a row's file below ``data``."""
    return F.regexp_extract(_decoded(F.col("_metadata.file_path")), f"^.*/data/({WRITE}=.*)$", 1)


def read_files(spark: SparkSession, path: str, at: Version, files: Sequence[str]) -> DataFrame:
    """Rows of some files of a version, with ``_file``, the file's path below ``data``."""
    base = f"{path.rstrip('/')}/data"
    if not files:
        empty = spark.createDataFrame([], at.schema)
        return empty.withColumn("_file", F.lit(None).cast("string"))
    fields = [*at.schema.fields, T.StructField(WRITE, T.StringType())]
    reader = spark.read.schema(T.StructType(fields)).option("basePath", base)
    return reader.parquet(*[f"{base}/{f}" for f in files]).select(*[F.col(f"`{c}`") for c in at.schema.names], _below_data().alias("_file"))


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a version, by default the newest."""
    at = version(spark, path, number)
    if at is None:
        raise LookupError(f"{path} has no committed version")
    names = [r.file for r in files_of(spark, at).select("file").collect()]  # as a scan lists them
    return read_files(spark, path, at, names).drop("_file")


def write_files(
    df: DataFrame, path: str, partition_by: str | Sequence[str] = (), files: int | None = None, rebalance: bool = True
) -> DataFrame:
    """Write rows as new data files that no version names yet; returns their list.

    ``rebalance=False`` keeps the partitioning of ``df``, e.g. by ranges of a key.

    The row counts come from the files' footers.
    """
    spark, keys, mark = df.sparkSession, present_columns(df, partition_by), uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/data/{WRITE}={mark}"
    if files is not None:
        df = df.repartition(files)
    elif keys and rebalance:
        df = df.hint("rebalance", *keys)
    writer = df.write.partitionBy(*keys) if keys else df.write
    writer.parquet(folder)
    fs, root = _hadoop_path(spark, folder)
    found, prefix = [], len(fs.makeQualified(root).toString()) - len(f"{WRITE}={mark}")
    walk = fs.listFiles(root, True)
    while walk.hasNext():
        status = walk.next()
        name = status.getPath().toString()[prefix:]
        if status.getPath().getName().startswith("part-"):
            found.append((name, status.getLen()))
    if not found:
        return spark.createDataFrame([], FILE_LIST)
    parts = F.filter(F.split("file", "/"), lambda p: p.contains("=") & ~p.startswith(f"{WRITE}="))
    values = F.transform(parts, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)), _decoded(F.substring_index(p, "=", -1))))
    listed = spark.createDataFrame(found, "file string, bytes long").withColumn("partition", F.map_from_entries(values))
    counts = spark.read.schema(T.StructType([])).parquet(folder).groupBy(_below_data().alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    return listed.join(counts, "file", "left").select("file", "partition", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes")


def commit(
    spark: SparkSession,
    path: str,
    entries: DataFrame,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    parent: int = 0,
    **details: object,
) -> Version:
    """Publish the files in ``entries`` as version ``parent + 1``.

    ``parent`` is the version that the writer read; if another writer has gone on from
    it, :class:`CommitConflict` is raised and nothing has changed.
    """
    base = path.rstrip("/")
    file_list = f"{base}/files/{uuid.uuid4().hex}"
    entries.select("file", "partition", "rows", "bytes").coalesce(1).write.parquet(file_list)
    total = spark.read.schema(FILE_LIST).parquet(file_list).agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()
    made = Version(parent + 1, schema, tuple(partition_by), file_list, total[0], total[1], parent, now, details)
    fs, folder = _hadoop_path(spark, f"{base}/commits")
    fs.mkdirs(folder)
    if versions(spark, base)[-1:] > [parent] or not _create(spark, _commit_path(base, made.number), made.text()):
        raise CommitConflict(f"{path}: version {made.number} exists; read the newest version and load again")
    return made


def versioned_publish(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] = (),
    parent: int | None = None,
    files: int | None = None,
    rebalance: bool = True,
    **details: object,
) -> Version:
    """Write ``df``, which may read from ``path``, as the next version of the whole table.

    ``parent`` is the version that ``df`` was made from; without it the newest one now.
    ``details`` are kept in the manifest.
    """
    spark = df.sparkSession
    if parent is None:
        at = version(spark, path)
        parent = at.number if at else 0
    entries = write_files(df, path, partition_by, files, rebalance)
    return commit(spark, path, entries, df.schema, present_columns(df, partition_by), parent, **{"kind": "publish", **details})


def restore_version(spark: SparkSession, path: str, number: int, column: str | None = None, value: object = None) -> Version:
    """Make an earlier version the newest one again, or only one of its partitions.

    Only the list of files is written: with ``column`` and ``value`` that partition's
    files are those of the earlier version and all others stay as they are now.
    """
    now, then = version(spark, path), version(spark, path, number)
    entries = files_of(spark, then)
    if column is not None:
        if column not in now.partition_by or column not in then.partition_by:
            raise ValueError(f"{path} is not partitioned by {column!r} in both versions")
        here = F.col("partition")[column].eqNullSafe(F.lit("__HIVE_DEFAULT_PARTITION__" if value is None else str(value)))
        entries = entries.filter(here).unionByName(files_of(spark, now).filter(~here))
    schema = then.schema if column is None else now.schema
    return commit(spark, path, entries, schema, then.partition_by, now.number, kind="restore", of=number)


def expire_versions(spark: SparkSession, path: str, keep: int) -> int:
    """Forget all but the newest ``keep`` versions and delete files that no kept version
    names; returns how many data files went.

    Readers of forgotten versions and writers that have not committed must have ended.
    """
    if keep < 1:
        raise ValueError("the newest version is kept")
    base, known = path.rstrip("/"), versions(spark, path)
    old, kept = known[:-keep], [version(spark, path, n) for n in known[-keep:]]
    if not old:
        return 0
    lists = [version(spark, path, n).file_list for n in old]
    gone, named = (spark.read.schema(FILE_LIST).parquet(*some).select("file") for some in (lists, [at.file_list for at in kept]))
    names = [r.file for r in gone.distinct().join(named, "file", "left_anti").collect()]
    for place in [*(_commit_path(base, n) for n in old), *lists, *(f"{base}/data/{n}" for n in names)]:
        fs, at = _hadoop_path(spark, place)
        fs.delete(at, True)
    return len(names)
