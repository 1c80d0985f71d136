"""Ids and master records."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strataload.audit import AuditSpec
from strataload.operators import identity, mastering

AUDIT = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1))


def test_dense_ids_equal_dense_rank(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a string, b int, i int").repartition(5)
    got = {r["i"]: r["id"] for r in identity.dense_ids(df, ["a", "b"], 40, "id").collect()}
    keys = sorted({r[:2] for r in rows}, key=lambda k: (k[0] is not None, k[0] or "", k[1] is not None, k[1] or 0))
    assert got == {r[2]: 41 + keys.index(r[:2]) for r in rows}


def test_number_keys_over_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    out = identity.number_keys(df, ["k"], 0, "n", partitions=13).orderBy("k").collect()
    assert [r["n"] for r in out] == list(range(1, 5001))


def test_shuffled_ids_are_stable_and_unique(spark):
    df = spark.range(200).select(F.concat(F.lit("p"), "id").alias("p"))
    one = {r["p"]: r["x"] for r in identity.shuffled_ids(df, ["p"], 10, "x", "salt").collect()}
    two = {r["p"]: r["x"] for r in identity.shuffled_ids(df.repartition(7), ["p"], 10, "x", "salt").collect()}
    other = {r["p"]: r["x"] for r in identity.shuffled_ids(df, ["p"], 10, "x", "pepper").collect()}
    assert one == two != other
    assert sorted(one.values()) == list(range(11, 211))
    assert [one[p] for p in sorted(one)] != sorted(one.values())


def test_append_ids_never_change(spark):
    known = spark.createDataFrame([(7, "b"), (9, None)], "id long, name string")
    incoming = spark.createDataFrame([("b",), (None,), ("a",), ("c",)], "name string")
    out = {r["name"]: r["id"] for r in identity.append_ids(known, incoming, ["name"], "id").collect()}
    assert out == {"b": 7, None: 9, "a": 10, "c": 11}
    nothing = identity.append_ids(known, incoming.filter("name = 'b'"), ["name"], "id")
    assert {tuple(r) for r in nothing.collect()} == {(7, "b"), (9, None)}


def test_backfill(spark):
    df = spark.createDataFrame([("a", 3), ("b", None), ("c", None), ("b", None)], "k string, id long")
    out = Counter(tuple(r) for r in identity.backfill_ids(df, ["k"], "id").collect())
    assert out == Counter([("a", 3), ("b", 4), ("b", 4), ("c", 5)])


def test_first_id_map(spark):
    ids = spark.createDataFrame([("x",), ("x",), ("y",)], "member string")
    out = identity.id_map_insert(None, ids, ["member"], "member_id", F.lit("now"), seed=100)
    assert {(r["member"], r["member_id"], r["update_ts"]) for r in out.collect()} == {("x", 101, "now"), ("y", 102, "now")}


def test_coalesce_update_order_and_guard(spark):
    base = spark.createDataFrame([(1, "a", None), (2, "b", "q"), (None, "n", None)], "k int, u string, v string")
    first = spark.createDataFrame([(1, None), (2, "B1"), (2, "B1")], "k int, u string")
    second = spark.createDataFrame([(1, "A2", "V2"), (2, "B2", None), (None, "Z", "Z"), (None, "Y", "Y")], "k int, u string, v string")
    out = identity.coalesce_update(base, {"one": first, "two": second}, ["k"], ["u", "v"])
    assert {tuple(r) for r in out.collect()} == {(1, "A2", "V2"), (2, "B1", "q"), (None, "n", None)}
    for conflict in ([(1, "x"), (1, "y")], [(1, "x"), (1, None)]):
        bad = spark.createDataFrame(conflict, "k int, u string")
        with pytest.raises(PySparkException, match="multiply rows"):
            identity.coalesce_update(base, {"bad": bad}, ["k"], ["u"]).collect()


def waterfall(rows, master, children):
    """One child after the other, each seeing what was created before."""
    created = []
    for child in children:
        have = {r[0] for r in rows + created if r[1].lower() == master.lower() and r[0] is not None}
        created += [(r[0], master, r[2]) for r in rows if r[1].lower() == child.lower() and r[0] not in have]
    return set(rows) | set(created)


@pytest.mark.parametrize("seed", range(4))
def test_waterfall_is_the_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(12)]), rng.choice(["M", "a", "B", "c", "d"]), rng.randint(0, 2)) for _ in range(40)]
    df = spark.createDataFrame(rows, "k int, s string, v int")
    out = mastering.master_waterfall(df, "M", ["c", "A", "b"], ["k"], "s")
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == waterfall(rows, "M", ["c", "A", "b"])


def test_source_list_with_and_without_repeats(spark):
    rows = [(1, "b", 1), (1, "a", 1), (1, "a", 2), (1, "a", 2), (2, None, 1), (2, "z", 1)]
    df = spark.createDataFrame(rows, "k int, s string, v int")
    plain = {(r["k"], r["s"], r["v"]): r["l"] for r in mastering.source_list(df, ["k"], "s", "l", repeats=False).collect()}
    assert plain[(1, "a", 2)] == "a,b" and plain[(2, None, 1)] == "z" and len(plain) == 5
    repeated = {(r["k"], r["s"], r["v"]): r["l"] for r in mastering.source_list(df, ["k"], "s", "l").collect()}
    assert repeated[(1, "b", 1)] == "a,a,b"


def test_flags_open_earlier_masters(spark):
    masters = {"m1": ["a", "b"], "m2": ["m1", "c"]}
    assert mastering.memberships(masters) == {"a": ["m1", "m2"], "b": ["m1", "m2"], "m1": ["m2"], "c": ["m2"]}
    df = spark.createDataFrame([("m2", "a,c,m2"), ("a", "a,b"), ("c", "a"), ("m1", None)], "s string, data_source_id_list string")
    out = mastering.source_flags(df, ["a", "b", "C"], masters, "s")
    assert [tuple(r)[2:] for r in out.collect()] == [(1, 0, 0), (1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_with_masters_replaces_master_rows(spark):
    df = spark.createDataFrame([(1, "M", None), (2, "a", "x"), (3, "b", "y")], "k int, s string, v string")
    views = {"u": spark.createDataFrame([(1, "one"), (2, "two")], "k int, v string")}
    out = mastering.with_masters(df, "M", ["a", "b"], ["k"], "s", views, ["k"], ["v"])
    assert {tuple(r) for r in out.collect()} == {(2, "a", "x"), (3, "b", "y"), (1, "M", "one"), (2, "M", "two"), (3, "M", "y")}


def test_master_final_restamps(spark):
    df = spark.createDataFrame([(1, "M", "old"), (2, "a", "old")], "k int, s string, hashkey string")
    out = mastering.master_final(df, ["M"], "s", AUDIT).collect()
    assert len(out) == 1 and out[0]["hashkey"] != "old" and out[0]["add_date"] == AUDIT.batch_date
