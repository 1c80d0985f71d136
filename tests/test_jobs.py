"""Whole table jobs, each ending in one published table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataload.audit import AuditSpec
from strataload.operators import quality
from strataload.plans import jobs
from strataload.plans.mapping import MappingRow
from strataload.plans.rules import Rule
from strataload.sources import scan

DAY1 = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1), "v1")
DAY2 = AuditSpec(dt.date(2024, 2, 2), dt.datetime(2024, 2, 2), "v2")
ROWS = [
    MappingRow("id", "feed", "k", datatype="long", kind="primary"),
    MappingRow("name", "feed", sql="trim(feed.n)", scd="Y"),
    MappingRow("day", "feed", "d", datatype="date", format="yyyy-MM-dd"),
]


def feed(spark, *rows):
    return {"feed": spark.createDataFrame(list(rows), "k string, n string, d string")}


def state(df):
    return {(r["id"], r["name"], r["data_source"], r["is_active"], str(r["delete_date"])) for r in df.collect()}


def test_staging_reads_selected_files_and_checks_them(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in {"claims_01.csv": "id,full name\n1,a\n", "claims_02.csv": "id,full name\n2,b\n", "other.csv": "x\n9\n"}.items():
        (tmp_path / "in" / name).write_text(text)
    listing = scan.list_files(spark, str(tmp_path / "in"))
    control = spark.createDataFrame([("claims_1", 1), ("claims_2", 1)], "file_name string, row_count int")

    def rows(feed):
        return quality.check_total_rows(feed, control, "claims", "pattern", "rows")

    target = jobs.Target(str(tmp_path / "staged"))
    out = jobs.stage_feed(spark, listing, "claims", target, {"data_version": "v1"}, [rows], extension="csv")
    assert {tuple(r) for r in out.collect()} == {("1", "a", "v1"), ("2", "b", "v1")}
    assert out.columns == ["id", "full_name", "data_version"]
    more = control.unionByName(spark.createDataFrame([("claims_3", 1)], control.schema))
    with pytest.raises(ValueError, match="rows"):
        bad = [lambda feed: quality.check_total_rows(feed, more, "claims", "pattern", "rows")]
        jobs.stage_feed(spark, listing, "claims", target, {}, bad, extension="csv")


def test_two_days_of_ingestion(spark, tmp_path):
    target = jobs.Target(str(tmp_path / "t"), "scd2_checksum", jobs.mapped_keys(ROWS), "is_active, data_source")
    constants = {"a": {"data_source": "A"}, "b": {"data_source": "B"}}
    one = {"a": feed(spark, ("1", " x ", "2020-01-01"), ("1", " x ", "2020-01-01"), ("2", "y", "bad")), "b": feed(spark, ("3", "z", None))}
    first = jobs.ingest_table(spark, one, ROWS, constants, target, DAY1)
    assert state(first) == {(1, "x", "A", 1, "9999-12-31"), (2, "y", "A", 1, "9999-12-31"), (3, "z", "B", 1, "9999-12-31")}
    two = {"a": feed(spark, ("1", "x", "2021-01-01"), ("2", "Y", None)), "b": feed(spark, ("4", "w", None))}
    second = jobs.ingest_table(spark, two, ROWS, constants, target, DAY2)
    assert state(second) == {
        (1, "x", "A", 1, "9999-12-31"),
        (2, "y", "A", 0, "2024-02-01"),
        (2, "Y", "A", 1, "9999-12-31"),
        (3, "z", "B", 0, "2024-02-01"),
        (4, "w", "B", 1, "9999-12-31"),
    }
    # only "name" is tracked, so the new day of row 1 is not a change
    assert second.filter("id = 1").first()["day"] == dt.date(2020, 1, 1)
    with pytest.raises(ValueError):
        jobs.ingest_table(spark, two, ROWS, constants, target, DAY2, mode="weekly")


def test_cleansing_scope_and_pass_through(spark, tmp_path):
    table = spark.createDataFrame([(1, "a", 1, 1), (2, "b", 0, 1), (3, "c", 1, 0)], "id int, v string, is_active int, is_incremental int")
    target = jobs.Target(str(tmp_path / "t"), partition_by="is_active")
    rule = Rule("element", "v", "concat(t.v, '!')")
    out = jobs.cleanse_table(spark, table, "t", [rule], {}, target, "active", names={"v": "value"})
    assert {(r["id"], r["value"]) for r in out.collect()} == {(1, "a!"), (3, "c!")}
    out = jobs.cleanse_table(spark, table, "t", [], {}, target, "incremental")
    assert {(r["id"], r["v"]) for r in out.collect()} == {(1, "a"), (2, "b")}


def test_integration_with_lookups_and_ids(spark, tmp_path):
    orders = spark.createDataFrame([(1, 7, "x", 1), (2, 8, "y", 1), (3, 7, "z", 0)], "id int, c int, v string, is_incremental int")
    people = spark.createDataFrame([(7, "Ann", 1), (8, "Bob", 0), (9, "Cy", 1)], "c int, n string, is_active int")
    codes = spark.createDataFrame([("x", "ex", 1), ("y", "why", 2)], "v string, w string, s int")
    rows = [MappingRow("id", "o", "id", kind="primary"), MappingRow("c", "o", "c"), MappingRow("v", "o", "v")]
    target = jobs.Target(str(tmp_path / "t"), "by_key", {"keys": ["id"]})
    out = jobs.integrate_table(
        spark, {"o": orders, "p": people, "k": codes}, rows, target, DAY1, "incremental", driving="o", masters=["k"],
        lookups=[("k", ("v", "v"), "w", "word", "s = 1")], ids=[("p", {"c": "c"}, "n", "person")],
    )
    assert {(r["id"], r["word"], r["person"]) for r in out.collect()} == {(1, "ex", "Ann"), (2, None, None)}
    assert "hashkey" in out.columns and out.first()["data_version"] == "v1"


def test_full_integration_keeps_the_history(spark, tmp_path):
    orders = spark.sql(
        "select * from values (1, 'a', date'2020-01-01', date'2020-12-31', 0), (1, 'b', date'2021-01-01', date'9999-12-31', 1)"
        " as v(id, v, add_date, delete_date, is_active)"
    )
    rows = [MappingRow("id", "o", "id"), MappingRow("v", "o", "v")]
    target = jobs.Target(str(tmp_path / "t"), "by_key", {"keys": ["id"]})
    out = jobs.integrate_table(spark, {"o": orders}, rows, target, DAY1, "full", driving="o")
    assert {(r["v"], str(r["add_date"]), r["is_active"]) for r in out.collect()} == {("a", "2020-01-01", 0), ("b", "2021-01-01", 1)}


def test_masters_end_to_end(spark, tmp_path):
    a = spark.createDataFrame([(1, "A", "a1"), (2, "A", None), (2, "A", None)], "k int, s string, v string")
    b = spark.createDataFrame([(2, "B", "b2"), (3, "B", "b3")], "k int, s string, v string")

    def fill(df):
        return {"from_b": df.filter("s = 'B'").select("k", F.upper("v").alias("v"))}

    target = jobs.Target(str(tmp_path / "t"), "checksum_all")
    out = jobs.master_table(
        spark, [a, b], {"M": ["A", "B"]}, ["k"], "s", {"M": fill}, ["v"], ["A", "B"], target, DAY1
    )
    got = {(r["k"], r["s"], r["v"], r["data_source_id_list"], r["a"], r["b"]) for r in out.collect()}
    assert got == {(1, "M", "a1", "A,M", 1, 0), (2, "M", "B2", "A,B,M", 1, 1), (3, "M", "B3", "B,M", 0, 1)}
