"""Counts and refusals from the metrics of the write."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from strataload.audit import AuditSpec, hash_columns, stamp
from strataload.operators import incremental
from strataload.plans import jobs
from strataload.sources import sink
from strataload.sources.metrics import Metrics

AUDIT = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1))


def feed(spark, low, high, word="a"):
    rows = spark.range(low, high).select("id", F.concat(F.lit(word), "id").alias("val"), F.lit(dt.date(2024, 1, 1)).alias("day"))
    return stamp(rows, AUDIT, hash_cols=hash_columns(rows))


def jobs_of(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


ARGS = {
    "by_key": {"keys": ["id"]},
    "scd2_checksum": {"keys": ["id"]},
    "append_new_keys": {"keys": ["id"]},
    "key_date": {"keys": ["id"], "date_col": "day"},
    "conditional": {"condition": "id < 5"},
    "deact_key": {"source_keys": ["id"], "target_keys": ["id"]},
}


@pytest.mark.parametrize("strategy", sorted(incremental.LOADS))
def test_counts_of_every_strategy(spark, tmp_path, strategy):
    args = dict(ARGS.get(strategy, {}))
    if strategy == "multi_key_date":
        args = {"key_sets": [["id"], ["val"]], "date_col": "day"}
    if strategy == "deact_key":
        args["deact"] = spark.range(3)
    src, tgt, metrics = feed(spark, 5, 15, "b"), feed(spark, 0, 10), Metrics()
    out = incremental.metered_load(src, tgt, metrics, mode="active", strategy=strategy, audit=AUDIT, **args)
    sink.publish(out, str(tmp_path / "t"))
    plain = incremental.LOADS[strategy](src, tgt, audit=AUDIT, **args)
    assert metrics.rows("source") == 10 and metrics.rows("inserted") == plain.inserted.count()
    if plain.history is not None:
        assert metrics.of("history") == {"rows": plain.history.count(), "closed": plain.closed.count()}
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "t")).collect())) == sorted(map(str, plain.to_df().collect()))


@pytest.mark.parametrize("mode", ["active", "full"])
@pytest.mark.parametrize("strategy", ["checksum_all", "by_key", "key_date", "append"])
def test_an_empty_source_leaves_the_table(spark, tmp_path, strategy, mode):
    target = jobs.Target(str(tmp_path / "t"), strategy, ARGS.get(strategy, {}))
    jobs.load_table(spark, feed(spark, 0, 10), target, "active", AUDIT)
    before = sorted(f.name for f in (tmp_path / "t").iterdir())
    for nothing in (feed(spark, 0, 0), feed(spark, 0, 9).filter("val = 'x'")):
        with pytest.raises(ValueError, match="refused"):
            jobs.load_table(spark, nothing, target, mode, AUDIT)
    assert sorted(f.name for f in (tmp_path / "t").iterdir()) == before
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_a_load_starts_no_counting_job(spark, tmp_path):
    target = jobs.Target(str(tmp_path / "t"), "by_key", {"keys": ["id"]})
    src = feed(spark, 0, 50)
    jobs.load_table(spark, src, target, "active", AUDIT)
    tgt = spark.read.parquet(target.path)
    assert jobs_of(spark, lambda: incremental.metered_load(src, tgt, Metrics(), mode="active", strategy="by_key", audit=AUDIT, keys=["id"])) == 0
    plain = incremental.load_by_key(src, tgt, keys=["id"], audit=AUDIT).to_df()
    alone = jobs_of(spark, lambda: sink.publish(plain, str(tmp_path / "other")))
    listing = 2  # the table is opened before and after
    assert jobs_of(spark, lambda: jobs.load_table(spark, src, target, "active", AUDIT)) <= alone + listing


def test_a_join_that_multiplies_rows_is_refused(spark, tmp_path):
    path, metrics = str(tmp_path / "t"), Metrics()
    sink.publish(spark.range(3), path)
    left = metrics.count("before", spark.range(5))
    twice = metrics.count("after", left.join(spark.createDataFrame([(1,), (1,)], "id long"), "id", "left"))
    with pytest.raises(ValueError, match="5 rows of before became 6 of after"):
        sink.publish(twice, path, guards=[metrics.same_rows("before", "after")])
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(KeyError):
        metrics.count("before", left)
    with pytest.raises(ValueError, match="swap"):
        sink.publish(twice, path, mode="append", guards=[metrics.same_rows("before", "after")])


def test_what_did_not_run_has_no_rows(spark):
    metrics = Metrics(wait=1)
    metrics.count("never", spark.range(3))
    assert metrics.rows("never") == 0 and metrics.frame(spark).collect()[0].n == 0


def test_staging_parses_a_feed_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "feed_1.csv").write_text("id\n1\n2\n")
    listing = spark.createDataFrame([(str(tmp_path / "in" / "feed_1.csv"),)], "path string")
    seen = []

    def check(rows):
        seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows.agg(F.lit("rows").alias("check_name"), (F.count(F.lit(1)) == 2).alias("passed"))

    jobs.stage_feed(spark, listing, "feed", jobs.Target(str(tmp_path / "t")), {"src": "x"}, [check], extension="csv")
    assert len(seen) == 1 and "FileScan parquet" in seen[0] and "FileScan csv" not in seen[0]
