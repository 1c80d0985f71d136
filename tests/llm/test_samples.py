"""Bounded samples: sizes, the same rows whatever the partitions, no hot task."""

import pytest
from pyspark.sql import functions as F

from strataload.llm import warc
from strataload.llm.common import sample_ids


def ids(df):
    return sorted((r.doc_id, r.label) for r in df.collect())


def test_sizes_and_rows(spark):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("label"))
    found = sample_ids(rows, ["label"], 500, "x")
    assert {r.label: r["count"] for r in found.groupBy("label").count().collect()} == {0: 500, 1: 500}
    assert ids(found) == ids(sample_ids(rows.repartition(17, "doc_id"), ["label"], 500, "x"))
    first = sorted(r.doc_id for r in rows.filter("label = 1").orderBy(F.xxhash64(F.lit("x"), "doc_id")).limit(500).collect())
    assert [d for d, label in ids(found) if label == 1] == first
    assert ids(found) != ids(sample_ids(rows, ["label"], 500, "y"))


@pytest.mark.parametrize("per", [[], ["label"]])
def test_small_and_empty_tables(spark, per):
    rows = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (None, 1)], "doc_id long, label int")
    assert sorted(map(str, sample_ids(rows, per, 50, "x").collect())) == sorted(map(str, rows.collect()))
    assert sample_ids(rows, per, 1, "x").count() == (2 if per else 1)
    assert sample_ids(rows.limit(0), per, 5, "x").count() == 0
    clash = rows.withColumn("rank", F.lit(1)).withColumn("total", F.lit("t"))
    assert sample_ids(clash, per, 50, "x").columns == clash.columns


def test_few_rows_are_ranked(spark):
    rows = spark.range(0, 400_000, 1, 8).select(F.col("id").alias("doc_id"), F.lit(1).alias("label"))
    plan = sample_ids(rows, ["label"], 100, "x")
    kept = [c for c in plan.columns]
    assert plan.count() == 100 and kept == ["doc_id", "label"]


def test_ranges_of_an_archive_are_tasks_of_their_own(spark, tmp_path):
    pages = spark.range(60).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat_ws(" ", *[F.sha2((F.col("id") * 997 + i).cast("string"), 256) for i in range(40)]).alias("html")
    )
    spec = warc.WarcSpec(range_bytes=8_000)
    warc.write_archives(pages.coalesce(1), str(tmp_path / "w"), spec)
    records = warc.read_archives(spark, str(tmp_path / "w"), spec)
    tasks = records.withColumn("task", F.spark_partition_id())
    assert records.count() == 60 and tasks.select("task").distinct().count() > 5
