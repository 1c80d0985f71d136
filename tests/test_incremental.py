"""Load strategies against row-by-row Python on small hand-made and random tables."""

import datetime as dt
import random
from collections import Counter

import pytest

from strataload.audit import AuditSpec, row_hash, stamp
from strataload.operators import incremental as inc
from strataload.schema import SchemaDrift

AUDIT = AuditSpec(dt.date(2024, 2, 1), dt.datetime(2024, 2, 1))
SCHEMA = "k long, alt string, d date, hashkey string, is_active int, is_incremental int, delete_date date, last_modified_date timestamp_ntz"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
OPEN, CLOSING = dt.date(9999, 12, 31), dt.date(2024, 1, 31)
OLD, NOW = dt.datetime(2023, 1, 1), dt.datetime(2024, 2, 1)


def row(k, h, d=1, active=1, alt=None, inc_flag=1):
    when = None if d is None else dt.date(2023, 5, d)
    return (k, alt, when, h, active, inc_flag, OPEN, OLD)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def close(r, flag=None):
    return (*r[:4], 0, r[5] if flag is None else flag, CLOSING, NOW)


def keep(r, flag=None):
    return r if flag is None else (*r[:5], flag, *r[6:])


def is_active(r):
    return r[4] == 1


def expected_presence(src, tgt, on, closed_flag, kept_flag):
    """Closed when ``on`` (None never matches) is not in the source."""
    have = {on(s) for s in src if None not in on(s)}
    known = {on(t) for t in tgt if is_active(t) and None not in on(t)}
    out = [s for s in src if on(s) not in known]
    for t in tgt:
        gone = is_active(t) and on(t) not in have
        out.append(close(t, closed_flag) if gone else keep(t, kept_flag))
    return Counter(out)


def expected_by_key(src, tgt):
    keys = {s[0] for s in src if s[0] is not None}
    out = [s for s in src if is_active(s)]
    for t in set(tgt):
        out.append(close(t, 1) if is_active(t) and t[0] in keys else keep(t, 0))
    return Counter(out)


def expected_date(src, tgt, key_sets):
    def first_hits(r, others):
        for key in key_sets:
            hits = [o for o in others if r[key] is not None and o[key] == r[key] and o[3] is not None]
            if hits:
                return hits
        return []

    active = [t for t in tgt if is_active(t)]
    out = []
    for s in src:
        hits = first_hits(s, active)
        later = any(
            s[3] is not None and t[3] != s[3] and None not in (t[2], s[2]) and t[2] <= s[2] for t in hits
        )
        if not hits or later:
            out.append(s)
    for t in set(tgt):
        hits = first_hits(t, src) if is_active(t) else []
        gone = any(t[3] is not None and s[3] != t[3] and None not in (t[2], s[2]) and t[2] <= s[2] for s in hits)
        out.append(close(t, 0) if gone else keep(t, 0))
    return Counter(out)


SRC = [
    row(1, "a"), row(2, "b2", 5), row(3, "c", 5), row(4, "d", 1), row(5, "e", 9), row(6, "f"),
    row(None, "n"), row(8, None), row(9, "i"), row(9, "i2", 3), row(10, "j", None, alt="x"),
]
TGT = [
    row(1, "a"), row(2, "b1", 4), row(3, "c0", 5), row(4, "d0", 2), row(6, "f", active=0), row(7, "g"),
    row(None, "n"), row(None, "n9"), row(8, "h8"), row(9, "i"), row(11, None), row(10, "j0", None, alt="x"),
    row(12, "l", inc_flag=0), row(12, "l", inc_flag=0),
]


def random_rows(seed, n):
    rng = random.Random(seed)
    return [
        row(
            rng.choice([None, 1, 2, 3, 4]),
            rng.choice([None, "a", "b", "c"]),
            rng.choice([None, 1, 2, 3]),
            rng.choice([1, 1, 1, 0]),
            rng.choice([None, "x", "y", "z"]),
            rng.choice([0, 1]),
        )
        for _ in range(n)
    ]


def active_rows(rows):
    return [(*r[:4], 1, *r[5:]) for r in rows]


INPUTS = [(SRC, TGT)] + [(active_rows(random_rows(i, 9)), random_rows(100 + i, 12)) for i in range(6)]


@pytest.mark.parametrize("src, tgt", INPUTS)
def test_checksum_all(spark, src, tgt):
    got = inc.load_checksum_all(frame(spark, src), frame(spark, tgt), audit=AUDIT).to_df()
    assert rows_of(got) == expected_presence(src, tgt, lambda r: (r[3],), 1, 0)


@pytest.mark.parametrize("src, tgt", INPUTS)
def test_scd2(spark, src, tgt):
    got = inc.load_scd2_checksum(frame(spark, src), frame(spark, tgt), keys=["k"], audit=AUDIT).to_df()
    assert rows_of(got) == expected_presence(src, tgt, lambda r: (r[0], r[3]), None, None)


@pytest.mark.parametrize("src, tgt", INPUTS)
def test_by_key(spark, src, tgt):
    got = inc.load_by_key(frame(spark, src), frame(spark, tgt), keys=["k"], audit=AUDIT).to_df()
    assert rows_of(got) == expected_by_key(src, tgt)


@pytest.mark.parametrize("src, tgt", INPUTS)
def test_key_date(spark, src, tgt):
    got = inc.load_key_date(frame(spark, src), frame(spark, tgt), keys=["k"], date_col="d", audit=AUDIT).to_df()
    assert rows_of(got) == expected_date(src, tgt, [0])


@pytest.mark.parametrize("src, tgt", INPUTS)
def test_multi_key_date(spark, src, tgt):
    got = inc.load_multi_key_date(
        frame(spark, src), frame(spark, tgt), key_sets=[["k"], ["alt"]], date_col="d", audit=AUDIT
    ).to_df()
    assert rows_of(got) == expected_date(src, tgt, [0, 1])


@pytest.mark.parametrize("src, tgt", INPUTS[:3])
def test_append_new_keys(spark, src, tgt):
    known = {t[0] for t in tgt if is_active(t)} - {None}
    got = inc.load_append_new_keys(frame(spark, src), frame(spark, tgt), keys=["k"], audit=AUDIT).to_df()
    assert rows_of(got) == Counter([s for s in src if s[0] not in known] + tgt)


def test_conditional_null_is_kept_and_or_stays_inside(spark):
    tgt = [row(1, "a"), row(2, "b"), row(None, "c"), row(2, "d", active=0)]
    got = inc.load_conditional(frame(spark, [row(9, "z")]), frame(spark, tgt), condition="k = 1 or k = 2", audit=AUDIT)
    want = [row(9, "z"), close(tgt[0], 0), close(tgt[1], 0), keep(tgt[2], 0), keep(tgt[3], 0)]
    assert rows_of(got.to_df()) == Counter(want)


def test_deactivation_feed(spark):
    tgt = [row(1, "a", alt="x"), row(1, "a", alt="x"), row(2, "b", alt="y"), row(3, "b", alt="z"), row(4, "d", alt="x", active=0)]
    src = [row(1, "a", alt="q"), row(2, "b", alt="q"), row(5, "e", alt="q"), row(6, "f", active=0)]
    deact = spark.createDataFrame([("X", "1"), ("x", "1"), ("Y", "2"), (None, "3")], "a string, b string")
    args = {"source_keys": ["a", "b"], "target_keys": ["alt", "k"], "audit": AUDIT}
    got = inc.load_deact_key(frame(spark, src), frame(spark, tgt), deact=deact, **args).to_df()
    # "b" is closed on one row and open on another: it does not survive, so src 2 is new
    want = [close(tgt[0]), close(tgt[2]), keep(tgt[3], 0), keep(tgt[4], 0), src[0], src[1], src[2]]
    assert rows_of(got) == Counter(want)
    none = inc.load_deact_key(frame(spark, src), frame(spark, tgt), deact=None, **args).to_df()
    assert rows_of(none) == Counter([keep(t, 0) for t in set(tgt)] + [src[2]])


def test_same_feed_twice_changes_nothing(spark):
    src = frame(spark, [row(i, f"h{i}") for i in range(20)])
    first = inc.load_checksum_all(src, frame(spark, TGT), audit=AUDIT).to_df()
    again = inc.load_checksum_all(src, first, audit=AUDIT)
    assert again.inserted.count() == 0
    assert again.closed.count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_one_active_row_per_key(spark, seed):
    rng = random.Random(seed)
    src = [row(k, rng.choice("abc"), rng.randint(1, 9)) for k in range(12) if rng.random() < 0.8]
    tgt = [row(k, rng.choice("abc"), rng.randint(1, 9), active=rng.choice([0, 1])) for k in range(12)]
    for result in (
        inc.load_scd2_checksum(frame(spark, src), frame(spark, tgt), keys=["k"], audit=AUDIT),
        inc.load_key_date(frame(spark, src), frame(spark, tgt), keys=["k"], date_col="d", audit=AUDIT),
    ):
        active = Counter(r["k"] for r in result.to_df().filter("is_active = 1").collect())
        assert max(active.values()) == 1
        assert result.kept.count() + result.closed.count() == len(tgt)


def test_first_load_and_modes(spark):
    src = frame(spark, SRC)
    for name, load in inc.LOADS.items():
        args = {
            "by_key": {"keys": ["k"]},
            "scd2_checksum": {"keys": ["k"]},
            "append_new_keys": {"keys": ["k"]},
            "key_date": {"keys": ["k"], "date_col": "d"},
            "multi_key_date": {"key_sets": [["k"]], "date_col": "d"},
            "conditional": {"condition": "true"},
            "deact_key": {"deact": None, "source_keys": ["k"], "target_keys": ["k"]},
        }.get(name, {})
        assert rows_of(load(src, None, audit=AUDIT, **args).to_df()) == Counter(SRC)
    tgt = frame(spark, TGT)
    assert rows_of(inc.load(src, tgt, mode="full", strategy="append", audit=AUDIT)) == Counter(SRC)
    with pytest.raises(ValueError):
        inc.load(src, tgt, mode="weekly", strategy="append", audit=AUDIT)
    with pytest.raises(ValueError):
        inc.load(src, tgt, mode="full", strategy="append", audit=AUDIT, allowed_modes=("active",))


def test_schema_drift(spark):
    src = frame(spark, [row(1, "a")]).withColumnRenamed("alt", "fresh")
    tgt = frame(spark, [row(2, "b")])
    with pytest.raises(SchemaDrift, match="alt"):
        inc.load_checksum_all(src, tgt, audit=AUDIT)
    out = inc.load_checksum_all(src, tgt, audit=AUDIT, on_dropped="drop").to_df()
    assert out.columns == src.columns
    assert {(r["k"], r["fresh"]) for r in out.collect()} == {(1, None), (2, None)}


def test_type_1_keeps_target_id(spark):
    schema = "k long, id long, hashkey string, is_active int, add_date date, last_modified_date timestamp_ntz"
    src = spark.createDataFrame([(1, 91, "a", 1, OPEN, OLD), (2, 92, "b2", 1, OPEN, OLD), (3, 93, "c", 1, OPEN, OLD)], schema)
    tgt = spark.createDataFrame(
        [(1, 1, "a", 1, CLOSING, OLD), (2, 2, "b", 1, CLOSING, OLD), (4, 4, "d", 1, CLOSING, OLD), (3, 3, "c", 0, CLOSING, OLD)],
        schema,
    )
    out = inc.scd1_helper(src, tgt, keys=["k"], id_col="id", audit=AUDIT).orderBy("k").collect()
    assert [(r["k"], r["id"], r["add_date"]) for r in out] == [(1, 1, CLOSING), (2, 2, AUDIT.batch_date), (3, 93, OPEN)]


def test_partitioned_load_leaves_other_partitions(spark):
    src = frame(spark, [row(1, "a", alt="x"), row(2, "b", alt="y"), row(3, "c", alt="z")])
    tgt_rows = [row(1, "a0", alt="x"), row(2, "b0", alt="y"), row(4, "w", alt="w"), row(5, "v")]
    plans = {"X": ("checksum_all", {}), "y": ("append", {})}
    with pytest.raises(ValueError, match="without a load plan"):
        inc.load_partitioned(src, frame(spark, tgt_rows), column="alt", plans=plans, audit=AUDIT)
    assert inc.unplanned_rows(src, "alt", plans).count() == 1
    src = src.filter("alt <> 'z'")
    out = inc.load_partitioned(src, frame(spark, tgt_rows), column="alt", plans=plans, audit=AUDIT)
    want = [close(tgt_rows[0], 1), row(1, "a", alt="x"), tgt_rows[1], row(2, "b", alt="y"), tgt_rows[2], tgt_rows[3]]
    assert rows_of(out) == Counter(want)


def test_row_hash_collisions_only_without_strict(spark):
    df = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), (None, "x"), ("-", "x")], "p string, q string")
    loose = [r[0] for r in df.select(row_hash(["q", "p"])).collect()]
    assert loose[0] == loose[1] and loose[2] == loose[3]
    assert len({r[0] for r in df.select(row_hash(["q", "p"], strict=True)).collect()}) == 4


def test_stamp_is_distinct_and_repeatable(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    out = stamp(df, AUDIT, hash_cols=["v"])
    assert out.count() == 2
    assert out.columns[:3] == ["k", "v", "hashkey"]
    first = {tuple(r) for r in out.collect()}
    assert first == {tuple(r) for r in stamp(df, AUDIT, hash_cols=["v"]).collect()}
