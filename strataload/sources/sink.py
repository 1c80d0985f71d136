"""Publishing tables and extracts.

A table is never overwritten while it may still be read: the new content is
written next to it and swapped in.  An unpartitioned table is written straight from
the plan's last stage.  For a partitioned one the rows are rebalanced by partition
value first: AQE sizes the files and splits a hot value over several tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.schema import union_bag
from strataload.session import _shared_folder
from strataload.sources.scan import _hadoop_path, read_delimited


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{_shared_folder(spark).rstrip('/')}/strataload-{uuid.uuid4().hex}"


def present_columns(df: DataFrame, wanted: str | Sequence[str]) -> list[str]:
    names = wanted.split(",") if isinstance(wanted, str) else wanted
    return [n.strip() for n in names if n.strip() in df.columns]


def _write(df: DataFrame, path: str, mode: str, keys: Sequence[str], **options) -> None:
    writer = df.write.mode(mode).options(**options)
    if keys:
        writer = writer.partitionBy(*keys)
    writer.parquet(path)


def publish(
    df: DataFrame,
    path: str,
    partition_by: str | Sequence[str] = (),
    mode: str = "swap",
    files: int | None = None,
    rebalance: bool = True,
    guards: Sequence[Callable[[DataFrame], None]] = (),
) -> None:
    """Write ``df`` as the table at ``path``.

    ``swap``     replace the whole table; ``df`` may read from ``path``.
    ``dynamic``  replace only the partitions that ``df`` has rows for.
    ``append``   add to the table.
    Partition keys that ``df`` lacks are ignored.  ``files`` fixes the number of
    writing tasks; ``rebalance=False`` saves the shuffle when the partition columns
    have only a few values.

    ``guards`` are called with the written rows between the write and the swap, when the
    metrics of the write are known; one that raises leaves the table as it was.
    """
    if guards and mode != "swap":
        raise ValueError("guards need a swap: the other modes change the table while they write")
    keys = present_columns(df, partition_by)
    if files is not None:
        df = df.repartition(files)
    elif keys and rebalance:
        df = df.hint("rebalance", *keys)
    if mode == "append":
        _write(df, path, "append", keys)
    elif mode == "dynamic":
        if not keys:
            raise ValueError("dynamic mode needs partition columns")
        _write(df, path, "overwrite", keys, partitionOverwriteMode="dynamic")
    elif mode == "swap":
        base = path.rstrip("/")
        fresh, old = f"{base}.new-{uuid.uuid4().hex}", f"{base}.old-{uuid.uuid4().hex}"
        _write(df, fresh, "overwrite", keys)
        fs, here = _hadoop_path(df.sparkSession, base)
        _, there = _hadoop_path(df.sparkSession, fresh)
        try:
            for guard in guards:
                guard(df.sparkSession.read.schema(df.schema).parquet(fresh))
        except Exception:
            fs.delete(there, True)
            raise
        _, aside = _hadoop_path(df.sparkSession, old)
        had_table = fs.exists(here)
        if had_table and not fs.rename(here, aside):
            raise OSError(f"could not move {base} aside; new content is in {fresh}")
        if not fs.rename(there, here):
            if had_table:
                fs.rename(aside, here)
            raise OSError(f"could not move {fresh} to {base}")
        if had_table:
            fs.delete(aside, True)
    else:
        raise ValueError(f"unknown publish mode {mode!r}")


def publish_union(dfs: Sequence[DataFrame], path: str, partition_by: str | Sequence[str] = ()) -> None:
    """Several differently shaped frames as one aligned append."""
    publish(union_bag(dfs), path, partition_by, mode="append")


def copy_table(spark: SparkSession, source: str, target: str, partition_by: str | Sequence[str] = ()) -> None:
    publish(spark.read.parquet(source), target, partition_by)


def restore_partition(spark: SparkSession, source: str, target: str, column: str, value: object) -> None:
    """Version-dated copy: only the rows of one partition value are replaced."""
    publish(spark.read.parquet(source).filter(F.col(column) == F.lit(value)), target, [column], mode="dynamic")


def export_delimited(
    df: DataFrame, path: str, sep: str = ",", files: int | None = None, compression: str = "gzip"
) -> None:
    """Delimited extract with header; only the write itself runs on ``files`` tasks."""
    shaped = df if files is None else df.repartition(files)
    shaped.write.mode("overwrite").csv(path, sep=sep, header=True, compression=compression)


def export_parquet(df: DataFrame, path: str, files: int | None = None, compression: str = "gzip") -> None:
    shaped = df if files is None else df.repartition(files)
    shaped.write.mode("overwrite").parquet(path, compression=compression)


def delimited_to_parquet(spark: SparkSession, source: str, target: str, sep: str = ",") -> None:
    publish(read_delimited(spark, source, sep=sep), target)


def export_snapshot(
    table: DataFrame,
    path: str,
    columns: dict[str, str],
    snapshot_column: str,
    snapshot: object,
    files: int = 1,
) -> None:
    """Delimited export of one snapshot into ``files`` files; no rows is an error.

    One file is what the receiver is promised by default; it is written by one task.
    """
    rows = table.filter(F.col(snapshot_column) == F.lit(snapshot)).select(
        *[F.col(c).alias(name) for c, name in columns.items()]
    )
    if rows.isEmpty():
        raise ValueError(f"no rows to export for {snapshot_column} = {snapshot}")
    rows.repartition(files).write.mode("overwrite").csv(path, header=True)
