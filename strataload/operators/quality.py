"""Feed validation, expectation suites and their summaries."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.schema import union_bag

def _verdict(df: DataFrame, check: str, passed: Column, *columns: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), F.coalesce(passed, F.lit(False)).alias("passed"), *columns)


# --- feeds against their control file ------------------------------------------


def control_rows(control: DataFrame, alias: str, match: str) -> DataFrame:
    """Control lines of a feed: name equal (``fixed``) or containing (``pattern``)."""
    name = F.col("file_name")
    if match == "fixed":
        return control.filter(F.trim(name) == alias)
    if match == "pattern":
        return control.filter(name.contains(alias))
    raise ValueError(f"unknown match {match!r}")


def check_total_rows(feed: DataFrame, control: DataFrame, alias: str, match: str, check: str = "total_rows") -> DataFrame:
    """Row count of the feed against the sum of its control lines."""
    actual = feed.agg(F.count(F.lit(1)).alias("actual_rows"))
    wanted = control_rows(control, alias, match).agg(
        F.coalesce(F.sum(F.col("row_count").cast("long")), F.lit(0)).alias("control_rows")
    )
    both = union_bag([actual, wanted]).agg(
        F.max("actual_rows").alias("actual_rows"), F.max("control_rows").alias("control_rows")
    )
    return _verdict(
        both, check, F.col("actual_rows") == F.col("control_rows"), F.col("actual_rows"), F.col("control_rows")
    )


def check_files(
    files: DataFrame,
    control: DataFrame,
    size: bool = True,
    rows: bool = True,
    header_line: bool = False,
    rename: tuple[str, str] | None = None,
) -> DataFrame:
    """Every feed file against its control line; a missing line fails.

    ``files`` has file_name, size_KB (bytes) and row_counts.  ``header_line``
    adds one to the rows, ``rename`` maps the file's last extension to the one
    in the control file.
    """
    name = F.col("file_name")
    if rename:
        old, new = rename
        cut = F.regexp_replace(name, f"^(.*)\\Q{old}\\E", f"$1{new}")
        files = files.withColumn("_name", cut)
    else:
        files = files.withColumn("_name", name)
    lines = control.groupBy(F.col("file_name").alias("_name")).agg(
        F.min(F.col("file_size").cast("long")).alias("control_size") if size else F.lit(None).alias("control_size"),
        F.min(F.col("row_count").cast("long")).alias("control_rows") if rows else F.lit(None).alias("control_rows"),
    )
    joined = files.join(lines, "_name", "left")
    counted = F.col("row_counts") + (1 if header_line else 0)
    tests = []
    if size:
        tests.append(F.col("size_KB") == F.col("control_size"))
    if rows:
        tests.append(counted == F.col("control_rows"))
    passed = reduce(Column.__and__, tests)
    return joined.select("file_name", F.coalesce(passed, F.lit(False)).alias("passed"))


def check_deact_feed(feed: DataFrame, load_type: str, check: str = "deact_feed") -> DataFrame:
    """Empty for a historical load, not empty for an incremental one."""
    if load_type not in ("historical", "incremental"):
        raise ValueError(f"unknown load type {load_type!r}")
    some = feed.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    return _verdict(some, check, (F.col("_n") == 0) if load_type == "historical" else (F.col("_n") > 0))


def check_schema(
    mapped: Iterable[str], actual: Iterable[str], except_mapped: Iterable[str] = (), except_actual: Iterable[str] = ()
) -> dict[str, list[str]]:
    """Column names on one side only, without case and without the exceptions."""

    def clean(names: Iterable[str]) -> set[str]:
        return {n.strip().lower() for n in names}

    ours, theirs = clean(mapped), clean(actual)
    return {
        "mapped_only": sorted(ours - theirs - clean(except_mapped)),
        "feed_only": sorted(theirs - ours - clean(except_actual)),
    }


def schema_gaps(mapped: DataFrame, actual: DataFrame, column: str = "column_name") -> DataFrame:
    """The same for column names that are data, such as the keys of JSON lines."""
    ours, theirs = (d.select(F.lower(F.trim(column)).alias(column)).distinct() for d in (mapped, actual))
    missing = ours.join(theirs, column, "left_anti").withColumn("side", F.lit("mapped_only"))
    return missing.unionByName(theirs.join(ours, column, "left_anti").withColumn("side", F.lit("feed_only")))


def summary_mismatches(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Files in both summaries whose size differs, or whose control rows are not
    the counted rows plus the header line."""
    a = ours.select("file_name", F.col("size").alias("size"), F.col("rows").alias("rows"))
    b = theirs.select("file_name", F.col("size").alias("control_size"), F.col("rows").alias("control_rows"))
    differs = (F.col("size") != F.col("control_size")) | (F.col("control_rows") != F.col("rows") + 1)
    return a.join(b, "file_name").filter(differs)


def gate(results: Sequence[DataFrame]) -> DataFrame:
    """All checks must pass."""
    rows = union_bag([r.select("check_name", "passed") for r in results])
    return rows.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
    )


def validation_log(results: DataFrame, source: str, market: str, table: str, columns: Mapping[str, str], at: Column):
    """One status line; a check that did not run reads ``NA``.

    The upper-case column names are fixed values of the log.

    ``columns`` maps the log column to the check name.
    """

    def status(check: str) -> Column:
        ok = F.bool_and(F.when(F.col("check_name") == check, F.col("passed")))
        return F.when(ok, "SUCCESS").when(~ok, "FAILED").otherwise("NA")

    return results.agg(*[status(check).alias(name) for name, check in columns.items()]).select(
        F.lit(source.upper()).alias("SRC_NAME"),
        F.lit(market.upper()).alias("MARKET_BASKET"),
        F.lit(table.upper()).alias("TABLE_NAME"),
        *columns,
        at.alias("EXPORT_DATE"),
    )


def fanout_check(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a join's right side that would multiply rows, with their count."""
    return right.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def count_check(counts: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of named frames, e.g. source and target of a load."""
    return union_bag([d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("name"), "n") for k, d in counts.items()])


# --- expectation suites ----------------------------------------------------------


@dataclass(frozen=True)
class Case:
    """A test case: SQL giving one row, and what is expected of its columns.

    ``expected`` is ``all_zero``, ``all_one``, ``anynumber`` (every column above
    zero), ``ignore``, or one value per column joined by ``|``, where ``any`` and
    ``ignore`` accept everything.
    """

    id: str
    sql: str | None
    expected: str
    source: str = ""
    table: str = ""
    layer: str = ""
    kind: str = ""
    sanity: bool = False


def select_cases(
    cases: Iterable[Case], layer: str = "", source: str = "", table: str = "", kind: str = "", sanity: bool = False
) -> list[Case]:
    wanted = {"layer": layer, "source": source, "table": table, "kind": kind}

    def fits(case: Case) -> bool:
        same = all(not v or getattr(case, k).strip().lower() == v.strip().lower() for k, v in wanted.items())
        return same and (case.sanity or not sanity)

    return [c for c in cases if fits(c)]


def _outcome(values: Column, width: int, expected: str) -> Column:
    """Pass or Fail for an array of column texts; Failed if they cannot be read
    the way the expectation needs."""
    kind = expected.strip()
    if kind == "ignore":
        return F.lit("Pass")
    if kind == "all_zero":
        readable = F.forall(values, lambda v: v.try_cast("double").isNotNull())
        ok = F.forall(values, lambda v: F.abs(v.try_cast("double")) < 1)
    elif kind in ("all_one", "anynumber"):
        readable = F.forall(values, lambda v: v.rlike(r"^\s*[+-]?\d+\s*$"))
        number = {"all_one": lambda v: v.try_cast("decimal(38,0)") == 1, "anynumber": lambda v: v.try_cast("decimal(38,0)") > 0}
        ok = F.forall(values, number[kind])
    else:
        parts = kind.split("|")
        readable = F.lit(len(parts) <= width)
        tests = [F.lit(True) if p in ("any", "ignore") else F.get(values, F.lit(i)) == p for i, p in enumerate(parts)]
        ok = reduce(Column.__and__, tests)
    return F.when(~readable, "Failed").when(ok, "Pass").otherwise("Fail")


def _line(case: Case, values: Column, width: int, one: Column) -> list[Column]:
    """The result line of a case from the texts of its columns."""
    return [
        F.lit(case.id).alias("testcase_id"),
        F.lit(case.table).alias("table_name"),
        F.lit(case.expected).alias("expected"),
        F.when(one, F.array_join(values, "|")).alias("result"),
        F.when(one, _outcome(values, width, case.expected)).otherwise("Failed").alias("status"),
    ]


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("None"))


def _case_frame(spark: SparkSession, case: Case, tables: Mapping[str, DataFrame]) -> DataFrame:
    used = {k: v for k, v in tables.items() if f"{{{k}}}" in case.sql}
    rows = spark.sql(case.sql, **used)
    rows = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])  # a name may occur twice
    texts = F.array(*[_text(F.col(c)) for c in rows.columns])
    # one line for every case: no row and several rows are no answer
    seen = rows.select(texts.alias("_values")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_values").alias("_values"))
    return seen.select(*_line(case, F.col("_values"), len(rows.columns), F.col("_rows") == 1))


_WHOLE_TABLE = re.compile(r"\s*select\s+(?!distinct\b)(.+?)\s+from\s+\{(\w+)\}\s*", re.I | re.S)


def _measures(case: Case, tables: Mapping[str, DataFrame]) -> tuple[str, list[str]] | None:
    """(table, column names) of a case that is nothing but aggregates over a whole table.

    Whether it is, Spark's analysis says: a grand aggregate, which has exactly one row.
    """
    found = _WHOLE_TABLE.fullmatch(case.sql or "")
    if not found or found.group(2) not in tables or "{" in found.group(1):
        return None
    try:
        one = tables[found.group(2)].selectExpr(f"struct({found.group(1)}) as c")
    except PySparkException:
        return None
    plan = one._jdf.queryExecution().analyzed()
    names = one.schema["c"].dataType.names
    if plan.getClass().getSimpleName() != "Aggregate" or not plan.groupingExpressions().isEmpty():
        return None
    return (found.group(2), names) if len(set(names)) == len(names) else None


def _fused(table: DataFrame, cases: Sequence[tuple[Case, list[str]]]) -> DataFrame:
    """The lines of several cases from one aggregation of their table."""
    lists = [_WHOLE_TABLE.fullmatch(case.sql).group(1) for case, _ in cases]
    row = table.selectExpr(*[f"struct({text}) as c{i}" for i, text in enumerate(lists)])
    lines = []
    for i, (case, names) in enumerate(cases):
        values = F.array(*[_text(F.col(f"c{i}").getField(n)) for n in names])
        lines.append(F.struct(*_line(case, values, len(names), F.lit(True))))
    return row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def _settled(spark: SparkSession, case: Case, status: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(case.id).alias("testcase_id"),
        F.lit(case.table).alias("table_name"),
        F.lit(case.expected).alias("expected"),
        F.lit(None).cast("string").alias("result"),
        F.lit(status).alias("status"),
    )


def run_expectations(
    spark: SparkSession, cases: Sequence[Case], tables: Mapping[str, DataFrame], isolate: bool = False
) -> DataFrame:
    """One line per case: Pass, Fail, Pending (no SQL) or Failed (SQL error, or not exactly one row).

    All cases form one plan, and cases that are aggregates over a whole table are one
    aggregation of it: as many scans as tables, whatever the number of cases.  ``isolate``
    runs each case as its own job first, so that one failing while it runs becomes a line
    instead of failing the suite.
    """
    frames, fused = [], {}
    for case in cases:
        measures = None if isolate else _measures(case, tables)
        if measures:
            fused.setdefault(measures[0], []).append((case, measures[1]))
            continue
        if not case.sql:
            frames.append(_settled(spark, case, "Pending"))
            continue
        try:
            frame = _case_frame(spark, case, tables)
            if isolate:
                frame = spark.createDataFrame(frame.collect(), frame.schema)
        except PySparkException:
            frame = _settled(spark, case, "Failed")
        frames.append(frame)
    frames += [_fused(tables[name], group) for name, group in fused.items()]
    return union_bag(frames)


def qa_summary(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cases per status; ``Fail`` and ``Failed`` both count as failed."""
    status = F.lower("status")
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_test_cases"),
        F.count_if(status.contains("pass")).alias("passed"),
        F.count_if(status.contains("fail")).alias("failed"),
        F.count_if(status.contains("pending")).alias("pending"),
    )


def collect_qa_summaries(frames: Sequence[DataFrame], report: str = "html_file") -> DataFrame:
    """Summaries of many runs without the runs that have no report."""
    named = F.upper(F.coalesce(F.col(report), F.lit("NA")))
    return union_bag(frames).fillna("NA").filter(named != "NA")


def run_validations(checks: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Run every check; raise at the end, naming all that failed."""
    results = union_bag([check().select("check_name", "passed") for check in checks.values()])
    failed = [r[0] for r in results.filter(~F.col("passed")).select("check_name").collect()]
    if failed:
        raise ValueError(f"validation failed: {sorted(failed)}")
    return results
