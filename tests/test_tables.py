"""Scans, sinks, mappings, extracts and quality checks on files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strataload import schema
from strataload.operators import dedupe, quality
from strataload.operators.quality import Case
from strataload.plans import extract, mapping
from strataload.plans.mapping import MappingRow
from strataload.sources import scan, sink


def files(path, suffix):
    return sorted(f for f in os.listdir(path) if f.endswith(suffix))


def test_publish_over_its_own_input(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.publish(spark.range(10), path)
    sink.publish(spark.read.parquet(path).filter("id > 6"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [7, 8, 9]
    assert os.listdir(tmp_path) == ["t"]


def test_publish_dynamic_append_and_file_count(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(30).select("id", (F.col("id") % 3).cast("int").alias("p"))
    sink.publish(rows, path, "p, missing", files=2)
    sink.publish(rows.filter("p = 1").withColumn("id", -F.col("id")), path, "p", mode="dynamic")
    got = spark.read.parquet(path)
    assert got.filter("p = 1").agg(F.max("id")).first()[0] < 0 and got.count() == 30
    sink.publish(rows.filter("p = 0"), path, "p", mode="append")
    assert spark.read.parquet(path).count() == 40
    fixed = str(tmp_path / "fixed")
    sink.publish(rows, fixed, files=3)
    assert len(files(fixed, ".parquet")) == 3
    with pytest.raises(ValueError):
        sink.publish(rows, path, mode="dynamic")


def test_copies_and_unions(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    sink.publish_union([spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([("2", 3.5)], "k string, w double")], a)
    sink.copy_table(spark, a, b)
    assert {tuple(r) for r in spark.read.parquet(b).collect()} == {("1", "x", None), ("2", None, 3.5)}


def test_exports(spark, tmp_path):
    gz = str(tmp_path / "gz")
    sink.export_parquet(spark.range(5), gz, files=1)
    assert files(gz, ".gz.parquet")
    table = spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 2)) for i in range(10)], "id int, snapshot_date date")
    one = str(tmp_path / "one")
    sink.export_snapshot(table, one, {"id": "KEY"}, "snapshot_date", dt.date(2024, 1, 2))
    assert len(files(one, ".csv")) == 1
    sink.export_snapshot(table, one, {"id": "KEY"}, "snapshot_date", dt.date(2024, 1, 2), files=3)
    assert len(files(one, ".csv")) == 3
    assert scan.read_delimited(spark, one).count() == 5
    with pytest.raises(ValueError, match="no rows"):
        sink.export_snapshot(table, one, {"id": "KEY"}, "snapshot_date", dt.date(2025, 1, 1))


def test_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.publish(spark.range(10).withColumn("is_active", (F.col("id") % 2).cast("int")), path, "is_active")
    plan = scan.active_rows(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_active" in plan


def test_missing_inputs(spark, tmp_path):
    assert scan.read_parquet(spark, [str(tmp_path / "no")]) is None
    manifest = spark.createDataFrame([("a", " 1"), ("b", "0"), ("c", "1")], "path string, is_file_available string")
    listing = spark.createDataFrame([("c",)], "path string")
    assert [r["path"] for r in scan.required_missing(manifest, listing).collect()] == ["a"]
    with pytest.raises(FileNotFoundError):
        scan.check_required(manifest, listing)
    scan.check_required(manifest, manifest)
    assert scan.check_manifest(manifest) is manifest
    with pytest.raises(LookupError):
        scan.check_manifest(manifest.filter("path = 'z'"))


def test_feed_selection(spark):
    names = ["in/Claims_2023_01.csv", "in/pre_claims.CSV", "in/claims/", "in/other.csv", "in/claims99.csv.gz", "in/claims.csv"]
    listing = spark.createDataFrame([(n,) for n in names], "path string")

    def pick(**args):
        return {r[0] for r in scan.select_feed_files(listing, "claims2024", **args).collect()}

    assert pick(extension="csv") == {"in/Claims_2023_01.csv", "in/claims.csv"}
    assert pick(extension=".csv", match="pattern") == set(names) - {"in/claims/", "in/other.csv"}
    assert scan.select_feed_files(listing, "Claims", kind="directory").first()[0] == "in/claims/"
    with pytest.raises(ValueError):
        pick(match="guess")


def test_listing_and_glob(spark, tmp_path):
    for name in ("feed_01", "feed_02", "food_01"):
        sink.export_delimited(spark.range(3), str(tmp_path / name), files=1)
    assert scan.read_like(spark, str(tmp_path), "feed_77.csv", kind="delimited").count() == 6
    listing = scan.list_files(spark, str(tmp_path)).filter("path like '%.csv.gz'")
    assert listing.count() == 3 and listing.filter("size > 0").count() == 3


def test_staging_reads_strings(spark, tmp_path):
    sink.export_delimited(spark.range(3), str(tmp_path / "a"))
    out = scan.read_staging(spark, [str(tmp_path / "a")])
    assert out.dtypes == [("id", "string")]
    with pytest.raises(ValueError, match="b.xlsx"):
        scan.read_staging(spark, [str(tmp_path / "a"), "b.xlsx"])
    with pytest.raises(ValueError, match="no feed file"):
        scan.read_staging(spark, [])


def test_encoding_of_master_feed(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_bytes("k,v\n1,é\n1,é\n2,ü\n".encode("latin-1"))
    out = scan.master_feed(spark, str(path), encoding="ISO-8859-1", infer=True)
    assert {tuple(r) for r in out.collect()} == {(1, "é"), (2, "ü")}


def test_read_scopes(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, "2024-01-02"), (1, 0, 1, None), (2, 0, 0, "2024-01-01"), (2, 0, 1, "2024-01-03")],
        "k int, is_active int, is_incremental int, add_date string",
    )

    def ids(mode, role="driving", **args):
        return sorted((r["k"], r["add_date"]) for r in scan.read_scope(df, mode, role, **args).fillna("-").collect())

    assert len(ids("full")) == 4 and ids("active") == [(1, "2024-01-02")]
    assert ids("incremental") == [(1, "-"), (2, "2024-01-03")]
    assert ids("incremental", "other") == [(1, "2024-01-02")]
    assert ids("full", "other", keys=["k"]) == [(1, "2024-01-02"), (2, "2024-01-03")]
    assert len(ids("active", "master")) == 4
    with pytest.raises(ValueError):
        ids("weekly")


# --- mappings ------------------------------------------------------------------------


def test_mapping_file(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text(
        "is_active_map,cdm_table,column,table,source,datatype,kind,scd,rule_order\n"
        " 1,Orders ,id,o,k,bigint,primary,,2\n1,orders,v,o,v,,,Y,\n0,orders,w,o,w,,,,\n1,other,z,o,z,,,,\n"
    )
    rows = mapping.read_mapping(spark, str(path), cdm_table="ORDERS")
    assert [(r.column, r.rule_order) for r in rows] == [("id", 2), ("v", 9999)]
    assert mapping.primary_keys(rows) == ["id"] and mapping.tracked_columns(rows) == ["v"]


def test_full_load_joins(spark):
    facts = spark.sql("select 1 as k, date'2024-01-05' as add_date, 1 as is_active, 'h' as hashkey")
    dims = spark.sql(
        "select * from values (1, 'old', 0, date'2024-01-01', date'2024-01-31'), (1, 'cur', 1, date'2024-02-01', date'9999-12-31')"
        " as v(k, name, is_active, add_date, delete_date)"
    )

    def names(join_type, mode):
        rows = [
            MappingRow("k", "f", "k"),
            MappingRow("name", "d", "name"),
            MappingRow(table="d", kind="left join", sql="f.k = d.k", full_load_join=join_type),
        ]
        out = mapping.apply_mapping({"f": facts, "d": dims}, rows, mode, typed=False)
        return sorted(r["name"] for r in out.collect()), out.columns

    assert names("date_based", "full") == (["old"], ["k", "name", "add_date", "is_active"])
    assert names("active", "full")[0] == ["cur"]
    assert names("active", "active") == (["cur", "old"], ["k", "name"])
    with pytest.raises(ValueError):
        names("nearest", "full")
    with pytest.raises(ValueError, match="one driving table"):
        mapping.apply_mapping({}, [MappingRow("a", "f", "a"), MappingRow("b", "d", "b")])


def test_star_mapping(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    out = mapping.apply_mapping({"t": df}, [MappingRow("*", "t"), MappingRow("n", sql="upper(t.v)")], typed=False)
    assert out.first().asDict() == {"k": 1, "v": "a", "n": "A"}


def test_typed_projection_never_fails(spark):
    df = spark.createDataFrame([("x", "13/45/2020", "9,5")], "i string, d string, n string")
    rows = [
        MappingRow("i", "t", "i", datatype="integer"),
        MappingRow("d", "t", "d", datatype="date", format="MM/dd/yyyy"),
        MappingRow("ts", "t", "d", datatype="timestamp"),
        MappingRow("n", "t", "n", datatype="decimal", length="(5,2)"),
        MappingRow("s", "t", "i", datatype="varchar", length="(1)"),
    ]
    assert tuple(mapping.apply_mapping({"t": df}, rows).first()) == (None, None, None, None, "x")


def test_schema_helpers(spark):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    two = spark.createDataFrame([("x", 2.5)], "a string, b double")
    assert [f.dataType.simpleString() for f in schema.union_bag([one, two]).schema] == ["string", "double"]
    assert [f.dataType.simpleString() for f in schema.union_bag([two, one]).schema] == ["string", "int"]
    assert schema.reorder(one, ["b"], ["a"]).columns == ["b", "a"]
    assert schema.empty_table(spark, {"a": "long", "b": "unknown"}).dtypes == [("a", "bigint"), ("b", "string")]
    assert schema.drop_excluded(one) is one
    repeated = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    assert [r[0] for r in schema.except_rows(repeated, repeated.filter("a = 2")).collect()] == [1]
    nulls = spark.createDataFrame([(None, 1), (None, 2), (1, None)], "a int, b int")
    left = schema.except_rows(nulls, nulls.filter("b = 1 or a = 1"))
    assert left._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert [tuple(r) for r in left.collect()] == [(None, 2)]


def test_patch_clears_what_has_no_fix(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 0)], "k int, v string, is_active int")
    script = {"fix": "select k, upper(v) as v, 'new' as w from {t} where k = 1"}
    out = dedupe.dedupe_patch(df, "t", [script], ["k"])
    assert {(r["k"], r["v"], r["w"]) for r in out.collect()} == {(1, "A", "new"), (2, None, None), (3, "c", None)}


# --- control tables and checks -------------------------------------------------------


def test_file_control_counts_every_file_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 100, 1, 4).write.csv(path, header=True)
    lines = extract.file_control(spark, path, "t", "2024-02-01", kind="delimited")
    got = {r["file_name"]: (r["size_KB"], r["row_counts"]) for r in lines.collect()}
    assert sum(n for _, n in got.values()) == 100
    assert {f: s for f, (s, _) in got.items()} == {f: os.path.getsize(f"{path}/{f}") for f in files(path, ".csv")}
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # the data once, the listing once
    totals = extract.control_totals(lines).first()
    assert (totals["Path"], totals["Row_Count"], totals["File_Count"]) == ("t/", 100, 4)


def test_data_dictionary(spark):
    out = extract.data_dictionary(spark.createDataFrame([(1, "a")], "k int, v string"), "t").collect()
    assert [tuple(r) for r in out] == [("t/", "k", "int"), ("t/", "v", "string")]


def test_file_checks(spark):
    lines = spark.createDataFrame(
        [("a.gz", 10, 5), ("b.gz", 10, 5), ("c.gz", 11, 5), ("d.gz", 10, 5)], "file_name string, size_KB long, row_counts long"
    )
    control = spark.createDataFrame(
        [("a.TXT", "10", "6"), ("b.TXT", "10", "7"), ("c.TXT", "10", "6")], "file_name string, file_size string, row_count string"
    )

    def failed(**args):
        out = quality.check_files(lines, control, rename=(".gz", ".TXT"), **args)
        return {r["file_name"][0] for r in out.filter("not passed").collect()}

    assert failed(header_line=True) == {"b", "c", "d"}
    assert failed(rows=False) == {"c", "d"}
    assert failed(size=False, header_line=True) == {"b", "d"}
    assert failed(size=False) == {"a", "b", "c", "d"}


def test_total_and_gate(spark):
    feed = spark.range(12)
    control = spark.createDataFrame([("x_1", 5), ("x_2", 7), ("y", 1)], "file_name string, row_count int")
    good = quality.check_total_rows(feed, control, "x_", "pattern", "good")
    bad = quality.check_total_rows(feed, control, "x_1", "fixed", "bad")
    none = quality.check_total_rows(feed, control, "zzz", "fixed", "none")
    assert [r["passed"] for r in good.unionByName(bad).unionByName(none).collect()] == [True, False, False]
    line = quality.gate([good, bad]).first()
    assert (line["checks"], line["failed"], line["passed"]) == (2, 1, False)
    with pytest.raises(ValueError, match="bad"):
        quality.run_validations({"good": lambda: good, "bad": lambda: bad})
    assert quality.run_validations({"good": lambda: good}).count() == 1


def test_schema_check():
    out = quality.check_schema([" A", "b", "gone"], ["a", "B ", "extra", "known"], ["gone"], ["KNOWN"])
    assert out == {"mapped_only": [], "feed_only": ["extra"]}


@pytest.mark.parametrize(
    "sql, expected, status",
    [
        ("select 0 as a, -0.4 as b", "all_zero", "Pass"), ("select 0 as a, 1 as b", "all_zero", "Fail"),
        ("select 'x' as a", "all_zero", "Failed"), ("select cast(null as int) as a", "all_zero", "Failed"),
        ("select 1 as a, '1' as b", "all_one", "Pass"), ("select 1.0 as a", "all_one", "Failed"), ("select 2 as a", "all_one", "Fail"),
        ("select 3 as a, 1 as b", "anynumber", "Pass"), ("select 3 as a, 0 as b", "anynumber", "Fail"),
        ("select 'a' as a, 7 as b, 1 as c", "a|any|ignore", "Pass"), ("select 'a' as a, 7 as b", "a|8", "Fail"),
        ("select 'a' as a", "a|b", "Failed"), ("select 'a' as a, 'b' as b", "a", "Pass"),
        ("select 'whatever' as a", "ignore", "Pass"), ("select nope", "ignore", "Failed"), (None, "all_one", "Pending"),
    ],
)
def test_expectations(spark, sql, expected, status):
    assert quality.run_expectations(spark, [Case("c", sql, expected)], {}).first()["status"] == status


def test_failing_case_does_not_stop_the_suite(spark):
    cases = [Case("bad", "select raise_error('boom') as a", "all_one"), Case("ok", "select 1 as a", "all_one")]
    out = quality.run_expectations(spark, cases, {}, isolate=True)
    assert {r["testcase_id"]: r["status"] for r in out.collect()} == {"bad": "Failed", "ok": "Pass"}


def test_case_selection_and_summaries(spark):
    cases = [Case("1", "x", "", layer="stg", kind="qa", sanity=True), Case("2", "x", "", layer="STG "), Case("3", "x", "", layer="model")]
    assert [c.id for c in quality.select_cases(cases, layer="stg")] == ["1", "2"]
    assert [c.id for c in quality.select_cases(cases, sanity=True)] == ["1"]
    runs = spark.createDataFrame([("t", "report.html"), ("u", None), ("v", "na")], "table_name string, html_file string")
    assert [r["table_name"] for r in quality.collect_qa_summaries([runs]).collect()] == ["t"]


def test_extract_filters_and_flags(spark):
    table = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 0)], "id int, v string, Exclude_Per_DID int")
    spec = extract.ExtractSpec(
        "t", "x", "select <included_fields> from <extract_source_schema>.<layer:$1>.<table:$1> <table:$2>",
        (extract.ExtractField("v", "varchar"), extract.ExtractField("id", "int", "ID", order=1)), filter_full="x.id < 3",
    )
    out = extract.build_extract(spark, spec, {"t": table}, "full")
    assert out.columns == ["ID", "v"] and [tuple(r) for r in out.collect()] == [(1, "a")]
    assert extract.build_extract(spark, spec, {"t": table}, "incremental").count() == 2
    with pytest.raises(ValueError):
        extract.build_extract(spark, spec, {"t": table}, "weekly")
    with pytest.raises(ValueError):
        extract.project(table, [], "x")
