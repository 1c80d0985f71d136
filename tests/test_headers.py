"""Delimited feeds whose files have different headers."""

import gzip

import pytest

from strataload.sources import scan
from strataload.sources.headers import first_lines, header_groups, read_by_header


def write(folder, **files):
    paths = []
    for name, text in files.items():
        path = folder / f"{name}.csv"
        path.write_text(text, encoding="utf-8")
        paths.append(str(path))
    return paths


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns_are_matched_by_name(spark, tmp_path):
    paths = write(tmp_path, a="id,name,city\n1,ann,rome\n", b="id,city,name\n2,oslo,bob\n", c="id,zip\n3,99\n")
    df = scan.read_staging(spark, paths)
    assert df.columns == ["id", "name", "city", "zip"]
    assert rows(df) == [("1", "ann", "rome", None), ("2", "bob", "oslo", None), ("3", None, None, "99")]
    assert [len(g.files) for g in header_groups(spark, paths)] == [1, 1, 1]


def test_spelling_quotes_blanks_and_bom(spark, tmp_path):
    paths = write(tmp_path, a='﻿ID,"full, name"\n1,"x, y"\n', b='\n"Full, Name",id \n"z",2\n', c="id,FULL\n", d="")
    df = read_by_header(spark, paths)
    assert df.columns == ["ID", "full, name", "FULL"]
    assert rows(df) == [("1", "x, y", None), ("2", "z", None)]


def test_one_header_is_one_scan(spark, tmp_path):
    paths = write(tmp_path, a="x,y\n1,2\n", b="x,y\n3,4\n")
    df = read_by_header(spark, str(tmp_path / "*.csv"))
    assert rows(df) == [("1", "2"), ("3", "4")] == rows(scan.read_staging(spark, paths))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_without_headers(spark, tmp_path):
    paths = write(tmp_path, a="1,2\n", b="3,4,5\n", c="6,7\n")
    df = scan.read_staging(spark, paths, header=False)
    assert df.columns == ["_c0", "_c1", "_c2"]
    assert rows(df) == [("1", "2", None), ("3", "4", "5"), ("6", "7", None)]


def test_names_that_need_care(spark, tmp_path):
    folder = tmp_path / "in {x} [1]"
    folder.mkdir()
    (folder / "a b%20+é.csv").write_text("x\n1\n")
    with gzip.open(folder / "z.csv.gz", "wt") as f:
        f.write("y,x\n2,3\n")
    df = read_by_header(spark, str(tmp_path / "in*" / "*"))
    assert rows(df) == [("1", None), ("3", "2")]


def test_a_column_named_twice(spark, tmp_path):
    paths = write(tmp_path, a="x,x\n1,2\n")
    assert rows(read_by_header(spark, paths)) == [("1", "2")]
    with pytest.raises(ValueError, match="every column once"):
        read_by_header(spark, [*paths, *write(tmp_path, b="y\n1\n")])


def test_only_first_lines_are_read(spark, tmp_path):
    paths = write(tmp_path, a="x,y\n" + "1,2\n" * 300_000, b="\n\n", c="only\r\n")
    found = first_lines(spark, paths)
    assert [line for _, line in found] == ["x,y", "only"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert before == "134217728b" or int(before.rstrip("bB")) < 1 << 40


def test_parquet_files_that_differ(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{tmp_path}/feed_1")
    spark.createDataFrame([("b", 2)], "y string, z int").write.parquet(f"{tmp_path}/feed_2")
    df = scan.read_like(spark, str(tmp_path), "feed_2.parquet")
    assert sorted(df.columns) == ["x", "y", "z"] and df.count() == 2
