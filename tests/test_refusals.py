"""Loads without a source, cases without one row, id maps that would shrink, known ciphertext, plan growth."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataload.audit import AuditSpec
from strataload.functions.scalar import decrypt_text, encrypt_text
from strataload.operators import identity, incremental, lookup, quality
from strataload.operators.quality import Case
from strataload.plans import extract, jobs
from strataload.sources import sink

AUDIT = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1))


@pytest.mark.parametrize("strategy", sorted(incremental.LOADS))
@pytest.mark.parametrize("mode", incremental.LOAD_MODES)
def test_an_empty_or_absent_source_is_refused(spark, strategy, mode):
    tgt = spark.createDataFrame([(1, "a", 1)], "id int, hashkey string, is_active int")
    for src in (tgt.limit(0), None):
        with pytest.raises(ValueError, match="refused"):
            incremental.load(src, tgt, mode=mode, strategy=strategy, audit=AUDIT)


def test_every_case_gives_one_line(spark):
    cases = [
        Case("none", "select 0 as a where false", "all_zero"),
        Case("two", "select * from values (0), (5) t(a)", "all_zero"),
        Case("one", "select 0 as a", "all_zero"),
    ]
    found = {r["testcase_id"]: (r["status"], r["result"]) for r in quality.run_expectations(spark, cases, {}).collect()}
    assert found == {"none": ("Failed", None), "two": ("Failed", None), "one": ("Pass", "0")}


def test_an_id_map_does_not_shrink(spark):
    id_map = spark.createDataFrame([(1, 7, "a", "t0"), (1, 7, "b", "t0"), (2, 8, "c", "t0")], "k int, id int, v string, update_ts string")
    views = {"r": spark.createDataFrame([(1, "z")], "k int, v string")}
    with pytest.raises(Exception, match="row count would change"):
        identity.id_map_update(id_map, views, ["k"], ["v"], F.lit("t1")).collect()
    views = {"r": spark.createDataFrame([(2, "z")], "k int, v string")}
    rows = {tuple(r) for r in identity.id_map_update(id_map, views, ["k"], ["v"], F.lit("t1")).collect()}
    assert rows == {(1, 7, "a", "t1"), (1, 7, "b", "t1"), (2, 8, "z", "t1")}


def test_published_cipher_vector(spark):
    """FIPS 197, appendix C.1: one block, key 00..0f, plain text 00112233..ff."""
    key = F.unhex(F.lit("000102030405060708090a0b0c0d0e0f"))
    block = F.aes_encrypt(F.unhex(F.lit("00112233445566778899aabbccddeeff")), key, F.lit("ECB"), F.lit("PKCS"))
    row = spark.range(1).select(F.lower(F.hex(block)).alias("x"), encrypt_text(F.lit("secret"), key).alias("y")).first()
    assert row["x"].startswith("69c4e0d86a7b0430d8cdb78070b4c55a")
    assert row["y"] != "secret"
    assert spark.range(1).select(decrypt_text(F.lit(row["y"]), key)).first()[0] == "secret"


def test_files_of_the_same_name_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "a table+")
    rows = spark.range(300).withColumn("p", F.concat(F.lit("x y+"), F.col("id") % 3))
    sink.publish(rows, path, "p", files=1)
    found = extract.file_control(spark, path, "t", "d").collect()
    assert sorted(r["row_counts"] for r in found) == [100, 100, 100]
    assert len({r["file_name"] for r in found}) == 3


def test_a_full_load_takes_the_latest_version_of_a_lookup(spark, tmp_path):
    from strataload.plans.mapping import MappingRow

    tables = {
        "t": spark.createDataFrame([(1, 5)], "id int, k int"),
        "l": spark.createDataFrame([(5, "old", dt.date(2023, 1, 1)), (5, "new", dt.date(2024, 1, 1))], "k int, v string, add_date date"),
    }
    rows = [MappingRow("id", "t", "id"), MappingRow("k", "t", "k")]
    target = jobs.Target(str(tmp_path / "o"))
    out = jobs.integrate_table(
        spark, tables, rows, target, AUDIT, "full", driving="t", lookups=[("l", ("k", "k"), "v", "name", None)]
    )
    assert [r["name"] for r in out.collect()] == ["new"]


def test_plans_of_masters_grow_with_their_number(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3)], "k int, s string, v int")

    def size(n):
        masters = {f"m{i}": ["a", "b", "c"] for i in range(n)}
        out = jobs.build_masters(df, masters, ["k"], "s", {}, ["v"])
        return len(out._jdf.queryExecution().optimizedPlan().toString().splitlines())

    assert size(4) <= size(1) + 3


def test_an_empty_pattern_needs_no_cross_join(spark):
    names = spark.createDataFrame([("abc",), ("xyz",), ("",), (None,)], "n string")
    patterns = spark.createDataFrame(
        [("pattern", "", 9, "any"), ("pattern", "b", 1, "b"), ("pattern", "yz", None, "yz")], "m string, p string, o int, v string"
    )
    out = lookup.contains_lookup(names, "n", patterns, "p", "m", "o")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert {r["n"]: r["v"] for r in out.collect()} == {"abc": "b", "xyz": "any", "": "any"}


def test_inactive_history_meets_no_exchange(spark, tmp_path):
    path = str(tmp_path / "t")
    cols = ["k", "hashkey", "is_incremental", "delete_date", "last_modified_date", "d", "is_active"]
    rows = spark.range(50).select(
        F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("hashkey"), F.lit(1).alias("is_incremental"),
        F.current_date().alias("delete_date"), F.lit(None).cast("timestamp_ntz").alias("last_modified_date"),
        F.current_date().alias("d"), (F.col("id") % 2).cast("int").alias("is_active"),
    ).select(*cols)
    sink.publish(rows, path, "is_active")
    tgt = spark.read.parquet(path).select(*cols)
    for load in (
        incremental.load_by_key(rows, tgt, keys=["k"], audit=AUDIT),
        incremental.load_key_date(rows, tgt, keys=["k"], date_col="d", audit=AUDIT),
        incremental.load_deact_key(rows, tgt, deact=rows, source_keys=["k"], target_keys=["k"], audit=AUDIT),
    ):
        plan = load.to_df()._jdf.queryExecution().executedPlan().toString()
        branches = plan.split("FileScan parquet")
        inactive = [i for i, x in enumerate(branches[1:], 1) if "NOT (is_active" in x.split("ReadSchema")[0] or "<=> 1" in x.split("ReadSchema")[0]]
        assert inactive
        for i in inactive:
            above = branches[i - 1].rsplit("Union", 1)[-1]
            assert "Exchange" not in above.split("\n")[-1]
