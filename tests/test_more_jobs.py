"""External ids, partitioned loads in few scans, fused suites, clustered files."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strataload.audit import AuditSpec, hash_columns, stamp
from strataload.operators import incremental, quality
from strataload.operators.quality import Case
from strataload.plans import jobs
from strataload.plans.jobs import IdColumn
from strataload.sources import cluster

AUDIT = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1))


def bag(df):
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


# --- external ids ----------------------------------------------------------------


def members(spark, *rows, schema="m string, v string"):
    return spark.createDataFrame(list(rows), schema)


def test_external_ids_over_days(spark, tmp_path):
    path, ids = str(tmp_path / "t"), [IdColumn("id", 10), IdColumn("ext", salt="s")]

    def run(rows, columns=ids, day="d"):
        table, new = jobs.external_ids_table(spark, rows, ["m"], columns, path, day)
        return {(r.m, r.v): r for r in table.collect()}, new

    one, new = run(members(spark, ("b", "1"), ("a", "1"), ("a", "2"), ("a", "2"), (None, "n")), day="d1")
    assert new == 4 and one[None, "n"].id == 11 and one["a", "1"].id == one["a", "2"].id == 12 and one["b", "1"].id == 13
    assert sorted({r.ext for r in one.values()}) == [1, 2, 3]
    written = sorted(f.name for f in (tmp_path / "t").iterdir())
    same, new = run(members(spark, ("a", "9"), (None, "x")))
    assert new == 0 and same == one and sorted(f.name for f in (tmp_path / "t").iterdir()) == written
    two, new = run(members(spark, ("c", "1"), ("b", "7")), day="d2")
    assert new == 1 and two["c", "1"].id == 14 and two["c", "1"].ext == 4 and {k: two[k] for k in one} == one
    more = members(spark, ("d", "1", 5), ("a", "0", 6), schema="m string, v string, w int")
    three, new = run(more, [*ids, IdColumn("late", 100)], "d3")
    assert new == 1 and three["d", "1"].late == 101 and three["d", "1"].w == 5 and three["a", "1"].w is None
    assert three["a", "1"].late == three["a", "2"].late and sorted({r.late for r in three.values()}) == [101, 102, 103, 104, 105]
    assert {k: three[k].id for k in two} == {k: two[k].id for k in two}
    # a new column alone is written, though nothing is new
    four, new = run(members(spark, ("d", "1")), [*ids, IdColumn("late", 100), IdColumn("z")], "d4")
    assert new == 0 and sorted({r.z for r in four.values()}) == [1, 2, 3, 4, 5]


# --- partitioned loads -------------------------------------------------------------


def day(spark, word, values=8):
    rows = spark.range(64).select("id", F.concat(F.lit(word), F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(0)).alias("val"), F.concat(F.lit("p"), F.col("id") % values).alias("part"))
    return stamp(rows, AUDIT, hash_cols=hash_columns(rows))


PLANS = {
    "checksum_all": {},
    "by_key": {"keys": ["id"]},
    "scd2_checksum": {"keys": ["id"]},
    "append": {},
    "overwrite": {},
    "append_new_keys": {"keys": ["id"]},
    "conditional": {"condition": "id < 20"},
    "deact_key": {"source_keys": ["id"], "target_keys": ["id"]},
}


@pytest.mark.parametrize("strategy", PLANS)
def test_values_loaded_together_or_alone(spark, strategy):
    args = dict(PLANS[strategy], **({"deact": spark.range(9)} if strategy == "deact_key" else {}))
    src, tgt = day(spark, "b").filter("part <> 'p7'"), day(spark, "a").unionByName(day(spark, "b").filter("id > 40"))
    plans = {f" P{i}": (strategy, args) for i in range(7)}
    out = incremental.load_partitioned(src, tgt, column="part", plans=plans, audit=AUDIT)
    assert out.columns == src.columns
    alone = tgt.filter("part = 'p7'")
    for i in range(7):
        mine = [d.filter(f"part = 'p{i}'") for d in (src, tgt)]
        alone = alone.unionByName(incremental.LOADS[strategy](*mine, audit=AUDIT, **args).to_df())
    assert bag(out) == bag(alone)


def test_the_same_key_in_two_values(spark):
    rows = spark.createDataFrame([(1, "x", "p"), (1, "x", "q")], "id long, val string, part string")
    tgt = stamp(rows.filter("part = 'p'"), AUDIT, hash_cols=["val"])
    src = stamp(rows, AUDIT, hash_cols=["val"])
    out = incremental.load_partitioned(src, tgt, column="part", plans={"p": ("checksum_all", {}), "q": ("checksum_all", {})}, audit=AUDIT)
    assert Counter((r.part, r.is_active) for r in out.collect()) == {("p", 1): 1, ("q", 1): 1}


def test_scans_do_not_grow_with_the_values(spark, tmp_path):
    day(spark, "a").write.parquet(str(tmp_path / "t"))
    tgt, found = spark.read.parquet(str(tmp_path / "t")), []
    for count in (2, 4, 8):
        plans = {f"p{i}": ("checksum_all", {}) for i in range(count)}
        src = tgt.filter(F.col("part").isin(list(plans)))
        out = incremental.load_partitioned(src, tgt, column="part", plans=plans, audit=AUDIT)
        found.append(out._jdf.queryExecution().executedPlan().toString().count("FileScan"))
    assert found[0] == found[1] == found[2]


# --- fused suites ------------------------------------------------------------------


def test_one_scan_per_table(spark, tmp_path):
    spark.range(50).withColumn("v", F.col("id") % 3).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    measures = ["count(*) as n", "sum(v) as s, max(id) as m", "count(distinct v)", "min(v) + 0 as a", "count_if(v is null) as k", "max(named_struct('a', id)).a as x"]
    cases = [Case(f"c{i}", f"SELECT {m}\nFROM {{t}} ", "ignore", table="t") for i, m in enumerate(measures)]
    others = [
        Case("w", "select count(*) as n from {t} where id > 3", "anynumber"),
        Case("r", "select v from {t}", "ignore"),
        Case("g", "select max(id) as a from {t} group by v having v = 1", "anynumber"),
        Case("u", "select max(id) as a from {t} union select 1 from {t}", "ignore"),
        Case("d", "select distinct 1 as a from {t}", "all_one"),
        Case("e", "select count(nothing) from {t}", "ignore"),
        Case("two", "select count(*) as a, max(id) as a from {t}", "50|49"),
        Case("win", "select count(*) over () as a from {t}", "ignore"),
    ]
    fused = quality.run_expectations(spark, cases, {"t": table})
    assert fused._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    every = quality.run_expectations(spark, cases + others, {"t": table})
    alone = quality.run_expectations(spark, cases + others, {"t": table}, isolate=True)
    assert bag(every) == bag(alone)
    status = {r.testcase_id: r.status for r in every.collect()}
    assert status["two"] == "Pass" and status["e"] == "Failed" and status["r"] == "Failed" and status["d"] == "Pass"


def test_an_empty_table_has_one_line(spark):
    empty = spark.createDataFrame([], "v int")
    found = quality.run_expectations(spark, [Case("a", "select count(*) as n, max(v) as m from {t}", "0|None")], {"t": empty})
    assert [(r.result, r.status) for r in found.collect()] == [("0|None", "Pass")]


# --- clustered files ---------------------------------------------------------------


def test_a_filter_on_either_column_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(40_000).select(
        (F.col("id") * 7919 % 40_000).alias("a"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.xxhash64("id") % 500).cast("int")).alias("b"), F.sha2(F.col("id").cast("string"), 256).alias("c"), F.when(F.col("id") % 9 > 0, F.rand(3)).alias("d")
    )
    cluster.clustered_write(rows, path, ["a", "b"], files=64)
    assert bag(cluster.read_clustered(spark, path)) == bag(rows)
    cases = [{"a": (1000, 2000)}, {"b": (dt.date(2020, 2, 1), dt.date(2020, 2, 9))}, {"a": (0, 9_000), "b": (None, dt.date(2019, 6, 1))}]
    for bounds in cases:
        test = F.lit(True)
        for c, (low, high) in bounds.items():
            test &= (F.lit(True) if low is None else F.col(c) >= low) & (F.lit(True) if high is None else F.col(c) <= high)
        assert len(cluster.files_within(spark, path, bounds)) <= 64 / 3
        assert bag(cluster.read_clustered(spark, path, bounds)) == bag(rows.filter(test))
    assert cluster.read_clustered(spark, path, {"a": (-9, -1)}).count() == 0
    assert cluster.read_clustered(spark, path, {"c": ("0", "1")}).count() == rows.filter("c between '0' and '1'").count()


def test_clustered_files_are_many_alike_and_small_boxes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("a"), (F.xxhash64("id") % 1000).alias("b"))
    cluster.clustered_write(rows, path, ["a", "b"], files=16)
    sizes = [r["rows"] for r in spark.read.parquet(f"{path}/{cluster.STATISTICS}").collect()]
    assert len(sizes) >= 12 and sum(sizes) == 20_000 and max(sizes) < 20_000 / 4
    for bounds in ({"a": (100, 200)}, {"b": (100, 140)}):
        assert len(cluster.files_within(spark, path, bounds)) <= len(sizes) / 2
    # more rows, more files; a frequent value is no single file
    rows = rows.withColumn("a", F.when(F.col("a") % 2 == 0, 7).otherwise(F.col("a")))
    cluster.clustered_write(rows, path, ["a"], files=2, file_rows=1000)
    sizes = [r["rows"] for r in spark.read.parquet(f"{path}/{cluster.STATISTICS}").collect()]
    assert len(sizes) >= 8
    cluster.clustered_write(rows.withColumn("c", F.lit(1)), path, ["c", "b"], files=2, file_rows=1000)
    sizes = [r["rows"] for r in spark.read.parquet(f"{path}/{cluster.STATISTICS}").collect()]
    assert len(sizes) >= 15 and max(sizes) <= 3000 and bag(cluster.read_clustered(spark, path)) == bag(rows.withColumn("c", F.lit(1)))


def test_range_numbers_count_the_cuts_below(spark):
    rows = spark.createDataFrame([(None,), (float("-inf"),), (1.0,), (1.5,), (2.0,), (3.0,), (9.0,), (float("nan"),)], "v double")
    found = cluster.with_z_value(rows, "z", ["v"], {"v": [1.0, 2.0, 5.0]}, bits=3)
    assert [r["z"] for r in found.collect()] == [0, 0, 0, 1, 1, 2, 3, 3] and found.columns == ["v", "z"]


def test_texts_nulls_and_one_value(spark, tmp_path):
    rows = spark.createDataFrame([("é", None, 1), (None, 2.5, 1), ("zebra", -1.0, 1), ("", None, 1)] * 20, "x string, y double, z int")
    cluster.clustered_write(rows, str(tmp_path / "t"), ["x", "y", "z"], files=4, bits=3)
    assert bag(cluster.read_clustered(spark, str(tmp_path / "t"))) == bag(rows)
    assert cluster.read_clustered(spark, str(tmp_path / "t"), {"x": ("y", None)}).count() == 40
    with pytest.raises(ValueError):
        cluster.clustered_write(rows, str(tmp_path / "u"), ["x", "y"], 2, bits=40)
    cluster.clustered_write(rows.limit(0), str(tmp_path / "v"), ["x"], 2)
    assert cluster.read_clustered(spark, str(tmp_path / "v")).count() == 0
