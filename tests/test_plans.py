"""What the plans look like, and that a hot key is really split."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from strataload import catalog
from strataload.audit import AuditSpec
from strataload.operators import identity, incremental, lookup, mastering, recode
from strataload.sources import scan, sink

AUDIT = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1))
QUERIES = catalog.queries()
# these end in a global aggregate (one partial row per task) or read one row
ONE_ROW = {
    "count_check", "validate_total_rows", "validate_deact_feed", "validation_gate", "validation_log",
    "expectation_suite", "qa_summary", "shuffled_ids_invariants", "selected_cases", "run_all_validations", "fixed_file_count",
}


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_bottleneck_operators(spark, folder, no_broadcast, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert node not in plan
    if name not in ONE_ROW:
        assert "SinglePartition" not in plan


def scans(plan):
    return re.findall(r"FileScan parquet .*", plan)


def test_key_side_reads_only_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select(
        "id", F.lit("x").alias("wide"), F.md5(F.col("id").cast("string")).alias("hashkey"), F.lit(1).alias("is_incremental"),
        F.current_date().alias("delete_date"), F.lit(None).cast("timestamp_ntz").alias("last_modified_date"),
        (F.col("id") % 2).cast("int").alias("is_active"),
    )
    sink.publish(rows, path, "is_active")
    table = spark.read.parquet(path)
    out = incremental.load_checksum_all(table, table, audit=AUDIT).to_df()
    plan = out._jdf.queryExecution().executedPlan().toString()
    narrow = [s for s in scans(plan) if s.split("ReadSchema: ")[1].startswith("struct<hashkey:string>")]
    assert len(narrow) == 2
    assert sum("PartitionFilters: [isnotnull(is_active" in s for s in scans(plan)) >= 2


def test_latest_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1)], "id int, add_date int")
    plan = scan.latest_per_key(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


N = 400_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of all rows have key 0."""
    path = str(tmp_path_factory.mktemp("hot") / "t")
    spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("hashkey"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 300).cast("int")).alias("d"),
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("s"),
        F.lit(1).alias("is_active"),
        F.lit(1).alias("is_incremental"),
        F.lit(dt.date(9999, 12, 31)).alias("delete_date"),
        F.lit("2023-01-01 00:00:00").cast("timestamp_ntz").alias("last_modified_date"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def small_thresholds(spark, no_broadcast):
    small = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
    }
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


JOINS = {
    "by_key": lambda t: incremental.load_by_key(t, t, keys=["k"], audit=AUDIT).to_df(),
    "append_new_keys": lambda t: incremental.load_append_new_keys(t, t.filter("s = 's1'"), keys=["k"], audit=AUDIT).to_df(),
    "key_date": lambda t: incremental.load_key_date(t, t, keys=["k"], date_col="d", audit=AUDIT).to_df(),
    "waterfall": lambda t: mastering.created_masters(t, "s9", ["s1", "s2"], ["k"], "s"),
    "source_list": lambda t: mastering.source_list(t.select("k", "s", "hashkey"), ["k"], "s"),
    "dense_ids": lambda t: identity.dense_ids(t.select("k", "s", "hashkey"), ["k"], 0, "n"),
    "new_rows": lambda t: identity.new_rows(t, t.filter("s = 's1'"), ["k"]),
    "coalesce_update": lambda t: identity.coalesce_update(
        t.select("k", "s", "hashkey"), {"v": t.groupBy("k").agg(F.max("s").alias("s"))}, ["k"], ["s"]
    ),
    "null_safe_lookup": lambda t: lookup.null_safe_lookup(t, t.select("k", F.lit("x").alias("v")).distinct(), {"k": "k"}, {"v": "w"}),
    "recode": lambda t: recode.recode_multi_value(
        t.select(F.concat(F.col("k").cast("string"), F.lit("^a")).alias("codes"), "hashkey"),
        "codes",
        t.select(F.col("s").alias("code")),
        "code",
    ),
}


@pytest.mark.parametrize("name", sorted(JOINS))
def test_hot_key_is_split(hot, small_thresholds, name):
    out = JOINS[name](hot)
    counted = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*out.columns).cast("decimal(38,0)")))
    counted.collect()
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()


def test_hot_partition_value_gets_many_writers(hot, small_thresholds, tmp_path):
    rows = hot.withColumn("p", F.when(F.col("k") == 0, "hot").otherwise(F.col("s")))
    sink.publish(rows, str(tmp_path / "t"), "p")
    files = [f for f in (tmp_path / "t" / "p=hot").iterdir() if f.suffix == ".parquet"]
    assert len(files) > 4
