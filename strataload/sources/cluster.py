"""Tables written in the order of several columns at once.

Each clustering column is cut into ranges of equal size, the bits of the range numbers
are interleaved, and rows are range-partitioned by that number (Z order): every file
covers a small box of the columns' space.  The smallest and largest value of each column
per file are kept beside the table; a reader with bounds on any of the columns opens only
the files whose box meets them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.sources.sink import publish

STATISTICS = "_statistics"


def range_bounds(df: DataFrame, columns: Sequence[str], ranges: int, accuracy: int = 10_000) -> dict[str, list]:
    """Up to ``ranges`` - 1 cut values per column, from one pass; so many values come to the driver.

    Numbers, dates and timestamps are cut by approximate quantiles of their numeric
    value, other types by those of their first characters' code.
    """
    return _bounds_and_rows(df, columns, ranges, accuracy)[0]


def _bounds_and_rows(df: DataFrame, columns: Sequence[str], ranges: int, accuracy: int = 10_000) -> tuple[dict[str, list], int]:
    shares = [i / ranges for i in range(1, ranges)]
    sketches = [F.percentile_approx(_number(df, c), shares, accuracy).alias(f"_{i}") for i, c in enumerate(columns)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *sketches).first()
    return {c: sorted(set(row[f"_{i}"] or [])) for i, c in enumerate(columns)}, row["rows"]


def _number(df: DataFrame, column: str) -> Column:
    """A number that rises with the column (weakly, for texts)."""
    kind = df.schema[column].dataType.typeName()
    value = F.col(f"`{column}`")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return value.cast("timestamp").cast("double")
    if kind in ("string", "binary"):
        head = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    return value.cast("double")


def _cuts_below(value: Column, cuts: Sequence, first: int = 0) -> Column:
    """``first`` and the number of ascending cuts that are less than the value (none for NULL), by halving."""
    if not cuts:
        return F.lit(first).cast("long")
    half = len(cuts) // 2
    above = _cuts_below(value, cuts[half + 1 :], first + half + 1)
    return F.when(value > F.lit(float(cuts[half])), above).otherwise(_cuts_below(value, cuts[:half], first))


def with_z_value(df: DataFrame, name: str, columns: Sequence[str], bounds: Mapping[str, Sequence], bits: int) -> DataFrame:
    """``df`` with the interleaved bits of the columns' range numbers; NULL counts as the lowest range."""
    # one column at a time, so that neither a value nor its range number is computed twice
    values = df.withColumns({f"_v{i}": _number(df, c) for i, c in enumerate(columns)})
    numbers = values.withColumns({f"_v{i}": _cuts_below(F.col(f"_v{i}"), bounds[c]) for i, c in enumerate(columns)})
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i in range(len(columns)):
            one = F.shiftright(F.col(f"_v{i}"), bit).bitwiseAND(1)
            out = out.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    return numbers.withColumn(name, out).drop(*[f"_v{i}" for i in range(len(columns))])


def clustered_write(df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = 6, file_rows: int = 2_000_000) -> None:
    """Write ``df`` to about ``files`` files in Z order of ``columns``, with their statistics.

    2^``bits`` ranges per column.  There are more files if they would have more than
    ``file_rows`` rows, so that what a task sorts does not grow with the table.  The range
    partitioner samples the Z values and, within one, the columns, so files have like
    sizes; rows that are equal in all the columns stay together.
    """
    if not 1 <= bits * len(columns) <= 62:
        raise ValueError("the interleaved bits must fit a long")
    bounds, count = _bounds_and_rows(df, columns, 1 << bits)
    spark, base = df.sparkSession, path.rstrip("/")
    ordered = with_z_value(df, "_z", columns, bounds, bits)
    parts = max(files, -(-count // file_rows))
    ordered = ordered.repartitionByRange(parts, "_z", *[F.col(f"`{c}`") for c in columns]).sortWithinPartitions("_z").drop("_z")
    publish(ordered, f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    ends = [f(F.col(f"`{c}`")).alias(f"{side}_{i}") for i, c in enumerate(columns) for side, f in (("low", F.min), ("high", F.max))]
    publish(rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends), f"{base}/{STATISTICS}", files=1)
    names = spark.createDataFrame(list(enumerate(columns)), "number int, name string")
    publish(names, f"{base}/{STATISTICS}_columns", files=1)


def files_within(spark: SparkSession, path: str, bounds: Mapping[str, tuple[object, object]]) -> list[str]:
    """Files whose box meets the bounds (column: lowest, highest; None is open)."""
    base = path.rstrip("/")
    numbers = {r["name"]: r["number"] for r in spark.read.parquet(f"{base}/{STATISTICS}_columns").collect()}
    boxes = spark.read.parquet(f"{base}/{STATISTICS}")
    for column, (low, high) in bounds.items():
        if column in numbers:
            i = numbers[column]
            if low is not None:
                boxes = boxes.filter(F.col(f"high_{i}") >= F.lit(low))
            if high is not None:
                boxes = boxes.filter(F.col(f"low_{i}") <= F.lit(high))
    return sorted(r["file"] for r in boxes.select("file").collect())


def read_clustered(spark: SparkSession, path: str, bounds: Mapping[str, tuple[object, object]] | None = None) -> DataFrame:
    """Rows within the bounds (closed); only files that can hold some are opened."""
    base = path.rstrip("/")
    if not bounds:
        return spark.read.parquet(f"{base}/rows")
    files = files_within(spark, path, bounds)
    if not files:
        return spark.read.parquet(f"{base}/rows").limit(0)
    rows = spark.read.parquet(*[f"{base}/rows/{f}" for f in files])
    for column, (low, high) in bounds.items():
        if low is not None:
            rows = rows.filter(F.col(f"`{column}`") >= F.lit(low))
        if high is not None:
            rows = rows.filter(F.col(f"`{column}`") <= F.lit(high))
    return rows
