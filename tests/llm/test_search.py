"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strataload.llm import search as s
from strataload.llm.search import Places, SearchSpec, Tree, search, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, top=50):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, length = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    held = {}
    for item_id, text in items:
        if item_id is not None:
            held.setdefault(item_id, set()).update(plain_terms(text))
    out = []
    for item_id, wanted in held.items():
        scored = []
        for (doc_id, c), n in zip(counted, sizes):
            if not n:
                continue
            m, score = 100 - 50 + (50 * n * n_docs) // length, 0
            for t in wanted & c.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for i, (score, unknown, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, i, None if unknown else doc_id, -score))
    return sorted(out, key=lambda r: r[:2])


def result(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("text", [None, "", "a-B_c", "Éa éA 12x٣ x\x7fy", "[x]{y}~z", " q\x85r İ"])
def test_terms(text):
    assert [t.decode() for t in terms(text)] == plain_terms(text)


DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def made(rng, count, words):
    """Texts with frequent and rare words, ties and copies."""
    vocabulary = [f"t{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 20, 80]))) for _ in range(count)]
    return [*texts, *texts[: count // 3]]


@pytest.mark.parametrize("spec", [SearchSpec(top=5, tree=50, leaf=2), SearchSpec(top=50), SearchSpec(top=7, items=3, leaf=1)])
def test_against_brute_force(spark, spec):
    rng = random.Random(spec.top)
    docs = list(enumerate(made(rng, 300, 60)))
    items = [(i, " ".join(rng.sample([f"t{j}" for j in range(70)], rng.randint(1, 12)))) for i in range(15)]
    found = search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS), spec)
    assert result(found) == plain_search(docs, items, spec.top)


def tree_of(rng, count, leaf):
    vectors = [np.array(sorted(rng.sample(range(30), rng.randint(0, 8))), np.int64) for _ in range(count)]
    tfs = [np.array([rng.randint(1, 9) for _ in v], np.int64) for v in vectors]
    m = np.array([rng.randint(50, 400) for _ in range(count)], np.int64)
    return Tree(list(range(count)), m, vectors, tfs, leaf)


def test_bounds_hold_and_prune():
    rng = random.Random(3)
    tree = tree_of(rng, 800, 8)
    slots, looked, leaves = np.zeros(30, np.int64), 0, sum(not c for _, _, c in tree.nodes)
    for _ in range(20):
        item = np.array(sorted(rng.sample(range(30), 6)))
        weights = np.array([rng.randint(0, 5000) for _ in item])
        slots[:] = 0
        slots[item] = weights
        bounds = tree.bounds(item, weights)
        for bound, (low, high, children) in zip(bounds, tree.nodes):
            assert tree.scores(low, high, slots).max(initial=0) <= bound
            assert not children or (tree.nodes[min(children)] and sum(tree.nodes[c][1] - tree.nodes[c][0] for c in children) == high - low)
        places = Places(5)
        looked += tree.search(item, weights, slots, places)
        every = sorted(((int(x), True, -tree.ids[i]) for i, x in enumerate(tree.scores(0, 800, slots)) if x > 0), reverse=True)
        assert sorted(places.heap, reverse=True) == every[:5]
    assert looked < 20 * leaves / 2


def test_paths_are_shared():
    same = [np.array([0, 1, 2]) for _ in range(100)]
    tree = Tree(list(range(100)), np.full(100, 60), same, [np.ones(3, np.int64)] * 100, 4)
    assert len(tree.nodes) == 1
    tree = Tree(list(range(100)), np.full(100, 60), [*same[:50], *[np.array([0, 1, 3])] * 50], [np.ones(3, np.int64)] * 100, 4)
    assert [(b - a, len(c)) for a, b, c in tree.nodes] == [(100, 2), (50, 0), (50, 0)]


def test_odd_rows(odd, odd_rows, empty, spark):
    items = [(1, "quick fox"), (1, "RIVER one"), (2, None), (3, ""), (4, "?!"), (None, "fox"), (5, "nowhere"), (6, "123 two")]
    table = spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as rank", "'x' as score")
    assert result(search(odd, table)) == plain_search([r[:2] for r in odd_rows], items)
    assert search(empty, table).count() == 0 and search(odd, table.limit(0)).count() == 0
    assert search(odd.filter("text is null"), table).columns == ["item_id", "rank", "doc_id", "score"]


def test_lots_keep_ties_in_order(spark):
    rows = [(0, None if i == 7 else i, 5 + i % 2) for i in range(500)]
    found = s._ranked(spark.createDataFrame(rows, "item int, doc_id long, score long"), 300).orderBy("rank").collect()
    ids = [*range(1, 500, 2), *range(0, 500, 2)]
    ids = [i for i in ids[:250] if i != 7] + [None] + ids[250:]
    assert [r.doc_id for r in found] == ids[:300] and [r["rank"] for r in found] == list(range(1, 301))
