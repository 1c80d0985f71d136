"""Loads as the body of a stream, and functions that configuration names."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataload.audit import AuditSpec, hash_columns, stamp
from strataload.operators import incremental
from strataload.plans import jobs, named
from strataload.sources import versions
from strataload.streaming import feeds


def audit_of(number):
    return AuditSpec(dt.date(2024, 2, 1) + dt.timedelta(number), dt.datetime(2024, 2, 1) + dt.timedelta(number))


def prepare(batch, audit):
    return stamp(batch, audit, hash_cols=hash_columns(batch))


def bag(df):
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


DAYS = [[(1, "a"), (2, "b"), (3, "c")], [(2, "B"), (4, "d")], [(4, "D"), (1, "a")]]


def test_three_batches_and_a_replay(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id long, val string"
    for i, rows in enumerate(DAYS):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"day={i}"))

    def run(checkpoint):
        feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "day=*"))
        feeds.start_loading(feed, path, str(tmp_path / checkpoint), "s", prepare, audit_of, "by_key", keys=["id"]).awaitTermination()
        return versions.version(spark, path).number

    assert run("one") == 3 and feeds.ledger(spark, path) == {"s": 2}
    table = None
    for i, rows in enumerate(DAYS):
        audit = audit_of(i)
        src = prepare(spark.createDataFrame(rows, schema), audit)
        table = incremental.LOADS["by_key"](src, table, keys=["id"], audit=audit).to_df()
    assert bag(versions.read_version(spark, path)) == bag(table)
    assert run("lost") == 3  # all batches again, under a new checkpoint: nothing changes
    spark.createDataFrame([(9, "z")], schema).write.parquet(str(tmp_path / "in" / "day=3"))
    assert run("one") == 4 and feeds.ledger(spark, path) == {"s": 3}


def test_batches_by_hand(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a")], "id long, val string")
    args = ("s", prepare, audit_of(0), "by_key")
    assert feeds.load_batch(rows, 0, path, *args, keys=["id"])
    assert not feeds.load_batch(rows, 0, path, *args, keys=["id"])
    assert not feeds.load_batch(rows.limit(0), 1, path, *args, keys=["id"])
    assert feeds.load_batch(rows, 0, path, "other", *args[1:], keys=["id"])
    assert feeds.ledger(spark, path) == {"s": 0, "other": 0} and versions.versions(spark, path) == [1, 2]


# --- named functions ---------------------------------------------------------------


def test_named_functions(spark):
    df = spark.createDataFrame([(1, " x ", "a^longer1"), (1, " x ", "a^longer1"), (2, None, "b")], "k int, full string, l string")
    out = named.processed(df, named.BEFORE, " distinct ; without_nulls(full);")
    assert out.count() == 1
    shaped = named.with_columns(out, {"t": "trimmed(full)", "w": "has_long_value(l, 5)", "m": "month_text(full)"}).first()
    assert (shaped.t, shaped.w, shaped.m) == ("x", True, "")
    assert named.run_named(df, named.AFTER, ["constant(src, A)", "drop(full, l)"]).columns == ["k", "src"]
    found = {r.check_name: r.passed for c in named.checks("unique(k); present(k, full); present(l); deact_feed(incremental)") for r in c(df).collect()}
    assert found == {"unique k": False, "present k,full": False, "present l": True, "deact_feed": True}


@pytest.mark.parametrize("text", ["nothing", "drop(", "constant(a)", "deact_feed()", "month_text"])
def test_names_that_are_not_there(text):
    kinds = {"constant(a)": named.AFTER, "deact_feed()": named.CHECKS, "month_text": named.COLUMNS}
    with pytest.raises(LookupError):
        kinds.get(text, named.BEFORE).calls(text)


def test_a_name_is_registered_once():
    with pytest.raises(KeyError):
        named.BEFORE.register("distinct")(lambda df: df)


def test_checks_of_a_staging_job(spark, tmp_path):
    (tmp_path / "feed_1.csv").write_text("id\n1\n1\n")
    listing = spark.createDataFrame([(str(tmp_path / "feed_1.csv"),)], "path string")
    target = jobs.Target(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="unique id"):
        jobs.stage_feed(spark, listing, "feed", target, {}, named.checks("present(id); unique(id)"), extension="csv")
    assert jobs.stage_feed(spark, listing, "feed", target, {}, named.checks("present(id)"), extension="csv").count() == 2


def test_a_wrong_key_fails(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id|n\nbm90IGVuY3J5cHRlZCBhdCBhbGw=|1\n")
    with pytest.raises(Exception):
        jobs.decrypt_feed(spark, [str(tmp_path / "in.csv")], str(tmp_path / "out"), F.lit("example-key-0001")).collect()
