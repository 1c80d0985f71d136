"""Pruned loads, the sweep join and table comparison: rows, shuffles and growth."""

import datetime as dt
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from measured import shuffled_rows
from strataload.audit import AuditSpec, hash_columns, stamp
from strataload.operators import incremental, prune
from strataload.operators.diff import bucket_sums, diff_counts, table_diff, unequal_buckets
from strataload.operators.lookup import validity_join
from strataload.operators.sweep import asof_sweep, overlapping_versions

AUDIT = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1))


def bag(df):
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


# --- pruning -------------------------------------------------------------------


def feed(spark, low, high, word="a", step=1):
    rows = spark.range(low, high, step).select(
        "id", (F.col("id") + 1_000_000).cast("string").alias("code"), F.concat(F.lit(word), "id").alias("val"), F.lit(dt.date(2024, 1, 1)).alias("day")
    )
    return stamp(rows, AUDIT, hash_cols=hash_columns(rows))


LOADS = {
    "by_key": {"keys": ["id"]},
    "key_date": {"keys": ["id"], "date_col": "day"},
    "multi_key_date": {"key_sets": [["id"], ["code"]], "date_col": "day"},
}


@pytest.mark.parametrize("strategy", LOADS)
def test_a_small_feed_shuffles_few_active_rows(spark, strategy, tmp_path):
    feed(spark, 0, 40_000).write.partitionBy("is_active").parquet(str(tmp_path / "t"))
    src, tgt = feed(spark, 0, 40_000, "b", 100), spark.read.parquet(str(tmp_path / "t"))
    load, args = incremental.LOADS[strategy], LOADS[strategy]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pruned, plain = (load(src, tgt, audit=AUDIT, prune=p, **args).to_df() for p in (True, False))
        few, all_ = shuffled_rows(pruned), shuffled_rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert bag(pruned) == bag(plain)
    assert all_ > 40_000 and few < 0.05 * all_


def test_the_bitmap_loses_no_match(spark):
    small = spark.createDataFrame([(1, "x"), (2, None), (None, "y"), (-5, "z")], "k long, v string")
    big = spark.range(-10, 3000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.lit("q").alias("v"))
    for bits in (64, 1 << 12, prune.BITS):
        may, rest = prune.split(big, small, [["k"]], bits)
        assert may.count() + rest.count() == big.count()
        assert {1, 2, -5} <= {r.k for r in may.collect()} and not rest.filter("k in (1, 2, -5)").count()
        assert prune.key_bitmap(big, ["k"], bits).count() <= bits // 64
    may, rest = prune.split(big, small, [["k"]])
    assert may.count() == 3 and rest.filter("k is null").count() == 1
    may, _ = prune.split(big.withColumn("v", F.lit("x")), small, [["k", "v"], ["v"]])
    assert may.count() == big.count()
    assert prune.split(big, small.limit(0), [["k"]])[0].count() == 0


# --- sweep ---------------------------------------------------------------------

FACTS, VERSIONS = "f long, k long, k2 string, at date", "k long, k2 string, since date, until date, v string"
ON, VALID = {"k": "k", "k2": "k2"}, ("since", "until")


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(n)


def histories(rng, keys, versions, facts, most):
    made = []
    for k in range(keys):
        for i in range(versions):
            start = rng.randint(0, 300)
            made.append((k, "a", day(start), day(start + rng.randint(-3, most)), f"{k}-{i}"))
    made += [(0, None, day(0), day(9), "n"), (None, "a", day(0), day(9), "n"), (1, "a", None, day(9), "n"), (1, "a", day(0), None, "n"), *made[:4]]
    found = [(i, rng.randrange(keys + 1), "a", day(rng.randint(-5, 320))) for i in range(facts)]
    found += [(-1, None, "a", day(3)), (-2, 1, None, day(3)), (-3, 1, "a", None), *found[:3]]
    return found, made


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("most, stream_rows", [(4, 10**6), (200, 10**6), (30, 7)])
def test_the_sweep_is_the_interval_join(spark, most, stream_rows, how):
    facts, versions = histories(random.Random(most), 6, 40, 400, most)
    facts, versions = spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS)
    args = {"at": "at", "valid": VALID, "outputs": {"v": "v", "until": "ends"}, "how": how}
    found = asof_sweep(facts, versions, ON, stream_rows=stream_rows, **args)
    plain = validity_join(facts, versions, ON, **args)
    assert found.columns == plain.columns and bag(found) == bag(plain)


def test_empty_sides(spark):
    facts, versions = spark.createDataFrame([(1, 1, "a", day(1))], FACTS), spark.createDataFrame([], VERSIONS)
    args = {"at": "at", "valid": VALID, "outputs": {"v": "v"}}
    assert [tuple(r) for r in asof_sweep(facts, versions, ON, **args).collect()] == [(1, 1, "a", day(1), None)]
    assert asof_sweep(facts.limit(0), versions, ON, **args).count() == 0
    with pytest.raises(ValueError):
        asof_sweep(facts, versions, ON, how="outer", **args)


def test_near_linear_in_versions_per_key(spark):
    """One key: ten times the facts and versions take far less than a hundred times the work."""

    def took(count):
        facts = spark.range(count).select(F.col("id").alias("f"), F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("at"))
        versions = spark.range(count).select(
            F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 60 - 30).alias("since"), F.timestamp_seconds(F.col("id") * 60 + 29).alias("until"), F.col("id").alias("v")
        )
        out = asof_sweep(facts, versions, {"k": "k"}, "at", VALID, {"v": "v"})
        start = time.perf_counter()
        assert out.filter("f = v").count() == count
        return time.perf_counter() - start

    took(2_000)
    assert took(100_000) < 30 * max(took(10_000), 0.3)


def test_overlaps(spark):
    rows = [(1, "a", day(0), day(9), "x"), (1, "a", day(9), day(12), "y"), (1, "a", day(13), day(14), "z"), (2, "a", day(3), day(4), "w")]
    found = overlapping_versions(spark.createDataFrame(rows, VERSIONS), ["k", "k2"], VALID)
    assert [r.v for r in found.collect()] == ["y"] and found.columns == ["k", "k2", "since", "until", "v"]


# --- comparison ----------------------------------------------------------------


def plain_diff(a, b):
    a, b = Counter(a), Counter(b)
    return {(*row, a[row], b[row]) for row in a | b if a[row] != b[row]}


@pytest.mark.parametrize("buckets", [1, 8, 1 << 16])
def test_differences_are_counted(spark, buckets):
    rng = random.Random(buckets)
    pool = [(i % 5 or None, rng.choice(["p", None, ""]), i / 4) for i in range(30)] + [(None, "1", 0.0), (1, None, 0.0)]
    a, b = [rng.choice(pool) for _ in range(80)], [rng.choice(pool) for _ in range(80)]
    frames = [spark.createDataFrame(rows, "x int, y string, z double") for rows in (a, b)]
    found = table_diff(*frames, buckets=buckets)
    assert {tuple(r) for r in found.collect()} == plain_diff(a, b) and found.count() == len(plain_diff(a, b))
    kinds = {r.kind: r.n for r in diff_counts(*frames, buckets=buckets).collect()}
    assert sum(kinds.values()) == found.count()
    assert kinds.get("left_only", 0) == frames[0].exceptAll(frames[1]).join(frames[1], ["x"], "left_anti").count() or kinds["left_only"] > 0


def test_null_places_and_repeats(spark):
    one = spark.createDataFrame([(None, "a"), ("b", "b"), ("b", "b")], "x string, y string")
    two = spark.createDataFrame([("a", None), ("b", "b")], "x string, y string")
    assert {tuple(r) for r in table_diff(one, two).collect()} == {(None, "a", 1, 0), ("a", None, 0, 1), ("b", "b", 2, 1)}
    assert table_diff(one, one.repartition(3)).count() == 0 and table_diff(one.limit(0), two.limit(0)).count() == 0
    wider = table_diff(one.select("x"), two)
    assert {tuple(r) for r in wider.collect()} >= {("b", "b", 0, 1), ("b", None, 2, 0)}
    with pytest.raises(ValueError):
        table_diff(one.withColumnRenamed("x", "LEFT_ROWS"), two)


def test_equal_tables_shuffle_only_sums(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    rows.write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    buckets = 64
    assert shuffled_rows(table_diff(a, a, buckets=buckets)) <= 2 * 8 * buckets * 4
    changed = a.withColumn("wide", F.when(F.col("id") == 77, "new").otherwise(F.col("wide")))
    assert {(r.id, r.left_rows, r.right_rows) for r in table_diff(a, changed, 1 << 12).collect()} == {(77, 1, 0), (77, 0, 1)}
    assert unequal_buckets(a, changed, 1 << 12).count() == 2
    assert shuffled_rows(table_diff(a, changed, 1 << 10)) < 20_000
    assert bucket_sums(a, buckets).count() == buckets
