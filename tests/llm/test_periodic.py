"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from strataload.llm.periodic import RunSpec, collapsed, find_runs, periodic_runs, seeded, without_repeats
from strataload.llm.registry import QUERIES


def plain_runs(w, least=6, times=4):
    """All maximal stretches, period by period; a stretch belongs to its smallest period."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, times * q) and not any(q % p == 0 for p in found.get((i, length), [])):
                found.setdefault((i, length), []).append(q)
            i = j
    return sorted((s, n, q) for (s, n), qs in found.items() for q in qs)


def plain_collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


FIXED = ["", "a", "aaaaa", "aaaaaa", "aaaaaaa", "abababab", "abababa", "xabababab", "abcabcabcabc" * 3, "aabaabaabaab" + "b" * 9]


@pytest.mark.parametrize("text", FIXED)
def test_small(text):
    assert periodic_runs([list(text)]) == [plain_runs(text)]


@pytest.mark.parametrize("letters, most", [("ab", 60), ("abc", 120), ("abcdefgh", 200)])
def test_random(letters, most):
    rng = random.Random(most)
    texts = []
    for _ in range(250):
        w = []
        while len(w) < rng.randint(1, most):
            root = [rng.choice(letters) for _ in range(rng.randint(1, 9))]
            w += (root * 9)[: rng.randint(1, 7 * len(root))] if rng.random() < 0.6 else root
        texts.append(w)
    assert periodic_runs(texts) == [plain_runs(w) for w in texts]
    for w in texts:
        found = plain_runs(w)
        assert collapsed(w, found) == plain_collapsed(w, found)


def test_long_periods_and_one_word():
    rng = random.Random(5)
    root = [str(rng.random()) for _ in range(1000)]
    head = [str(rng.random()) for _ in range(77)]
    assert periodic_runs([head + root * 5 + ["x"], ["w"] * 50_000]) == [[(77, 5000, 1000)], [(0, 50_000, 1)]]


def test_runs_do_not_cross_texts():
    assert periodic_runs([["a"] * 3, ["a"] * 3, [], ["a"] * 6]) == [[], [], [], [(0, 6, 1)]]


def test_other_bounds():
    text = list("ababababab" + "c" * 8)
    assert periodic_runs([text], RunSpec(least=9, times=5)) == [plain_runs(text, 9, 5)] == [[(0, 10, 2)]]
    with pytest.raises(ValueError):
        RunSpec(times=3)


def test_seeded_tail():
    for doc_id in range(400):
        w = [f"w{i}".encode() for i in range(90)]
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % 90
        p = 1 + (90 - a) // (3 + g % 8)
        expected = w if h % 10 else [w[i] if i < a else w[a + (i - a) % p] for i in range(90)]
        assert seeded(w, doc_id) == expected
    assert seeded([], 0) == [] and seeded([b"x"], None) == [b"x"]


def expected_row(doc_id, text):
    w = seeded(re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()), doc_id)
    found = plain_runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return (
        len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(plain_collapsed(w, found))).hexdigest(),
    )


def test_query_against_brute_force(spark, folder):
    found = QUERIES["op12_basic_factors"](spark, folder)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert rows == {d: expected_row(d, t) for d, t in docs}
    assert sum(r[0] > 0 for r in rows.values()) > 5


def test_odd_rows(odd, odd_rows, empty):
    found = find_runs(odd)
    rows = found.collect()
    assert len(rows) == len(odd_rows) and find_runs(empty).count() == 0
    nothing = hashlib.sha256(b"").hexdigest()
    for r in rows:
        if r.doc_id in (3, 4, 5):
            assert (r.n_runs, r.start, r.runs_sha256, r.collapsed_sha256) == (0, None, nothing, nothing)
    assert find_runs(odd.selectExpr("*", "'x' as `START`", "1 as n_runs")).select("start").count() == len(rows)
    cut = without_repeats(odd)
    assert cut.columns == odd.columns and cut.count() == len(rows)


def test_cut_texts(spark):
    df = spark.createDataFrame([(1, "go  on on on on on on\tend"), (2, "as  it is"), (3, None)], "doc_id long, text string")
    assert [r.text for r in without_repeats(df).orderBy("doc_id").collect()] == ["go on end", "as  it is", None]
