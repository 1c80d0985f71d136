"""Committed versions and loads that rewrite only what changes."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataload.audit import AuditSpec, hash_columns, stamp
from strataload.operators import incremental
from strataload.plans.touched import load_touched_files, touched_files
from strataload.sources import versions as v

AUDIT = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1, 6))
BEFORE = AuditSpec(dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 6))


def bag(df):
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


def files(spark, path, number=None):
    return {r.file for r in v.files_of(spark, v.version(spark, path, number)).collect()}


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "a b+c%")
    rows = spark.range(10).select("id", (F.col("id") % 3).cast("int").alias("p"))
    first = v.versioned_publish(rows, path, "p, not_there")
    assert (first.number, first.rows, first.partition_by) == (1, 10, ("p",))
    old = v.read_version(spark, path)
    v.versioned_publish(rows.filter("id < 4"), path, "p")
    assert old.count() == 10 and v.read_version(spark, path).count() == 4
    assert v.read_version(spark, path, 1).dtypes == rows.dtypes
    assert bag(v.read_version(spark, path, 1)) == bag(rows)
    assert not files(spark, path, 1) & files(spark, path, 2)


def test_a_version_can_read_the_one_before(spark, tmp_path):
    path = str(tmp_path / "t")
    v.versioned_publish(spark.range(5), path)
    v.versioned_publish(v.read_version(spark, path).withColumn("id", F.col("id") + 1), path)
    assert sorted(r.id for r in v.read_version(spark, path).collect()) == [1, 2, 3, 4, 5]


def test_two_writers_cannot_both_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    v.versioned_publish(spark.range(1), path)
    one, two = v.write_files(spark.range(2), path), v.write_files(spark.range(3), path)
    schema = spark.range(1).schema
    v.commit(spark, path, one, schema, parent=1)
    with pytest.raises(v.CommitConflict):
        v.commit(spark, path, two, schema, parent=1)
    assert v.versions(spark, path) == [1, 2] and v.read_version(spark, path).count() == 2
    # also when both have looked before either has committed
    assert not v._create(spark, v._commit_path(path, 2), "{}")
    assert v.version(spark, path).rows == 2
    assert not [n for n in os.listdir(f"{path}/commits") if "tmp" in n]


def test_partition_values_and_counts(spark, tmp_path):
    path, odd = str(tmp_path / "t"), ["a/b", "x=y", "1+1", "50%", "é ü", None]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(odd * 2)], "id int, p string")
    made = v.versioned_publish(rows, path, "p")
    assert bag(v.read_version(spark, path)) == bag(rows) and made.rows == 12
    listed = v.files_of(spark, made).collect()
    known = {p or "__HIVE_DEFAULT_PARTITION__" for p in odd}
    assert {r.partition["p"] for r in listed} == known and sum(r.rows for r in listed) == 12
    assert all(r.bytes > 0 for r in listed)


def test_restore(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(6).select("id", (F.col("id") % 2).cast("int").alias("p"))
    v.versioned_publish(rows, path, "p")
    v.versioned_publish(rows.withColumn("id", F.col("id") + 100), path, "p")
    v.restore_version(spark, path, 1, "p", 1)
    assert sorted(r.id for r in v.read_version(spark, path).collect()) == [1, 3, 5, 100, 102, 104]
    v.restore_version(spark, path, 1)
    assert bag(v.read_version(spark, path)) == bag(rows) and v.versions(spark, path) == [1, 2, 3, 4]
    assert files(spark, path, 4) == files(spark, path, 1)
    with pytest.raises(ValueError):
        v.restore_version(spark, path, 1, "id", 1)


def test_version_by_time_and_missing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert v.version(spark, path) is None and v.versions(spark, path) == []
    with pytest.raises(LookupError):
        v.read_version(spark, path)
    v.versioned_publish(spark.range(1), path)
    between = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    v.versioned_publish(spark.range(2), path)
    assert v.version(spark, path, before=between).number == 1
    assert v.version(spark, path, before=dt.datetime(2000, 1, 1)) is None
    with pytest.raises(LookupError):
        v.version(spark, path, 7)


def test_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4).select("id", (F.col("id") % 2).alias("p"))
    v.versioned_publish(rows, path, "p")
    v.versioned_publish(rows, path, "p")
    v.restore_version(spark, path, 1, "p", 0)  # still names a file of the first version
    assert v.expire_versions(spark, path, 3) == 0
    assert v.expire_versions(spark, path, 1) == 2
    assert v.versions(spark, path) == [3] and bag(v.read_version(spark, path)) == bag(rows)
    with pytest.raises(ValueError):
        v.expire_versions(spark, path, 0)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert v.versioned_publish(spark.range(0), path).rows == 0
    assert v.read_version(spark, path).columns == ["id"] and v.read_version(spark, path).count() == 0


# --- loads ---------------------------------------------------------------------


def history(spark, count=4000):
    rows = spark.range(count).select("id", (F.col("id") % 7).alias("grp"), F.concat(F.lit("v"), "id").alias("val"), F.lit(dt.date(2023, 5, 5)).alias("day"))
    return stamp(rows, BEFORE, hash_cols=hash_columns(rows)).withColumn("is_incremental", F.lit(0))


def changes(spark, low, high):
    rows = spark.range(low, high).select("id", (F.col("id") % 7).alias("grp"), F.concat(F.lit("w"), "id").alias("val"), F.lit(dt.date(2024, 1, 30)).alias("day"))
    return stamp(rows, AUDIT, hash_cols=hash_columns(rows))


STRATEGIES = {
    "by_key": {"keys": ["id"]},
    "key_date": {"keys": ["id"], "date_col": "day"},
    "multi_key_date": {"key_sets": [["id"], ["val"]], "date_col": "day"},
    "append": {},
    "append_new_keys": {"keys": ["id"]},
    "conditional": {"condition": "id between 100 and 120"},
    "overwrite": {},
}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rows_are_those_of_the_full_load(spark, tmp_path, strategy):
    path, args = str(tmp_path / "t"), STRATEGIES[strategy]
    v.versioned_publish(history(spark).repartitionByRange(16, "id"), path)
    before = files(spark, path)
    src = changes(spark, 100, 140).unionByName(changes(spark, 9000, 9010))
    whole = v.read_version(spark, path, 1)
    done = load_touched_files(spark, src, path, strategy=strategy, audit=AUDIT, partition_by="", **args)
    full = incremental.LOADS[strategy](src, whole, audit=AUDIT, **args).to_df()
    assert bag(v.read_version(spark, path)) == bag(full)
    after = files(spark, path)
    assert (done.kept, done.rewritten, done.written) == (len(before & after), len(before - after), len(after - before))
    if strategy not in ("overwrite", "append", "append_new_keys"):
        assert done.rewritten == 1 and done.kept == 15  # an unchanged file keeps its name
    assert done.version.rows == full.count()


@pytest.mark.parametrize("strategy, args", [("checksum_all", {}), ("scd2_checksum", {"keys": ["id"]}), ("deact_key", None)])
def test_whole_day_feeds(spark, tmp_path, strategy, args):
    """Feeds that repeat the unchanged rows: those do not touch their files."""
    path = str(tmp_path / "t")
    v.versioned_publish(history(spark).repartitionByRange(16, "id"), path, "is_active", rebalance=False)
    day = history(spark).filter("id not between 500 and 510").drop("is_incremental").withColumn("is_incremental", F.lit(1))
    src = day.select(*history(spark).columns).unionByName(changes(spark, 500, 511))
    if args is None:
        args = {"deact": spark.range(700, 705).toDF("key"), "source_keys": ["key"], "target_keys": ["id"]}
    whole = v.read_version(spark, path, 1)
    done = load_touched_files(spark, src, path, strategy=strategy, audit=AUDIT, **args)
    assert bag(v.read_version(spark, path)) == bag(incremental.LOADS[strategy](src, whole, audit=AUDIT, **args).to_df())
    assert done.rewritten < 4 < done.kept
    # the next day: yesterday's rows lose their mark, whose files are few
    again = load_touched_files(spark, src, path, strategy=strategy, audit=AUDIT, **args)
    assert again.kept > 8 and again.version.number == 3


def test_first_load_and_unknown_strategy(spark, tmp_path):
    path = str(tmp_path / "t")
    done = load_touched_files(spark, history(spark, 10), path, strategy="by_key", audit=AUDIT, keys=["id"])
    assert done.version.number == 1 and done.version.rows == 10 and done.kept == 0
    with pytest.raises(ValueError):
        load_touched_files(spark, history(spark, 10), path, strategy="weekly", audit=AUDIT)


def test_a_source_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    v.versioned_publish(history(spark, 50).repartitionByRange(5, "id"), path, "is_active")
    src = changes(spark, 3, 5).withColumn("more", F.lit("x"))
    whole = v.read_version(spark, path)
    load_touched_files(spark, src, path, strategy="by_key", audit=AUDIT, keys=["id"])
    assert bag(v.read_version(spark, path)) == bag(incremental.load_by_key(src, whole, keys=["id"], audit=AUDIT).to_df())


def test_the_search_for_files_is_narrow(spark, tmp_path):
    path = str(tmp_path / "t")
    v.versioned_publish(history(spark, 50), path, "is_active")
    at = v.version(spark, path)
    tgt = v.read_files(spark, path, at, sorted(files(spark, path)))
    found = touched_files(changes(spark, 3, 5), tgt, strategy="by_key", audit=AUDIT, keys=["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    reads = [line.split("ReadSchema:")[1] for line in plan.splitlines() if "ReadSchema:" in line]
    assert reads and all("val" not in r and "add_date" not in r for r in reads)
