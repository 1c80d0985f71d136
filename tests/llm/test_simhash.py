"""SimHash against brute force: fingerprints, keys, links and components."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from strataload.llm import simhash
from strataload.llm.registry import QUERIES
from strataload.llm.simhash import Cell, SimHashSpec, chain_length, fingerprint, key_masks, near_duplicates


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """doc_id -> smallest doc_id reachable, by comparing all pairs."""
    parent = {d: d for d, _ in rows if d is not None}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, x), (b, y) in itertools.combinations([r for r in rows if r[0] is not None], 2):
        if (x ^ y).bit_count() <= 4:
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return {d: top(d) for d in parent}


TEXTS = ["", None, " \n", "One", "one TWO", "É é É", "a b c d", "a b c d e a b c d", "x " * 9000, " a b\x0bc\x0cd\x1fe f"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("chain", [1, 2, 3])
def test_every_close_pair_shares_a_key(chain):
    rng, masks = random.Random(chain), [m for _, m in key_masks(SimHashSpec(), chain)]
    for _ in range(20_000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        assert any(x & m == 0 for m in masks)


@pytest.mark.parametrize("chain", [1, 2, 3])
def test_a_link_is_found_in_one_bucket(chain):
    rng, spec = random.Random(7), SimHashSpec(chain=chain)
    keys = key_masks(spec, chain)
    cell = Cell(spec, keys)
    for bits in range(7):
        for _ in range(300):
            x = sum(1 << b for b in rng.sample(range(64), bits))
            met = np.array([k for k, (_, m) in enumerate(keys) if x & m == 0])
            found = cell.linked(met, np.full(len(met), x, np.uint64)) if len(met) else np.zeros(0)
            assert found.sum() == (bits <= 4)


def test_longer_keys_for_more_rows():
    spec = SimHashSpec()
    assert chain_length(spec, 1000) == 2 and chain_length(spec, 10**9) == 3
    assert chain_length(SimHashSpec(chain=1), 10**9) == 1


def cluster(rng, count, steps):
    """Fingerprints in chains of close neighbours, and others at five bits from them."""
    out = []
    for _ in range(count):
        at = rng.getrandbits(64)
        for _ in range(steps):
            out.append(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 3, 4, 5, 5])))
    return out


@pytest.mark.parametrize("chain, block", [(1, 16), (2, 8), (3, 1024)])
def test_links_against_all_pairs(spark, chain, block):
    rng = random.Random(chain)
    prints = sorted(set(cluster(rng, 40, 12)) | set(range(40)))
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)]
    classes = spark.createDataFrame(rows, "print long, id long")
    spec = SimHashSpec(chain=chain, block=block)
    found = {tuple(sorted(r)) for r in simhash.links(classes, spec).collect()}
    assert all((prints[a] ^ prints[b]).bit_count() <= 4 for a, b in found)
    stars = {r.u: r.m for r in simhash.components(simhash.links(classes, spec)).collect()}
    expected = plain_components(list(enumerate(prints)))
    assert {i: stars.get(i, i) for i in expected} == expected


def test_rows_grow_with_the_group(spark):
    """A large group in one bucket gives links in proportion, not its pairs."""
    made = []
    for size in (300, 600, 1200):
        pairs = list(itertools.combinations(range(50), 2))[:size]
        rows = [((1 << a) | (1 << b), i) for i, (a, b) in enumerate(pairs)]
        classes = spark.createDataFrame(rows, "print long, id long")
        made.append(simhash.links(classes, SimHashSpec(chain=2)).count())
    assert all(rows < 15 * size for rows, size in zip(made, (300, 600, 1200)))


def test_query_against_brute_force(spark, folder):
    found = QUERIES["op13_pigeonring_simhash"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = {d: plain_fingerprint(t) for d, t in docs}
    assert len(found) == len(docs)
    assert {r.doc_id: int(r.fingerprint, 16) for r in found} == expected
    assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in found)
    assert {r.doc_id: r.component_id for r in found} == plain_components(list(expected.items()))


def test_odd_rows(odd, odd_rows, empty, spark):
    found = near_duplicates(odd).collect()
    assert len(found) == len(odd_rows) and near_duplicates(empty).count() == 0
    by = {r.doc_id: r for r in found}
    assert by[2].component_id == 1 and by[8].component_id == 7
    assert {by[i].component_id for i in (3, 4, 5)} == {3} and by[3].fingerprint == "0" * 16
    assert all(r.component_id is None and r.fingerprint for r in found if r.doc_id is None)
    twice = spark.createDataFrame([(1, "a b c d e f"), (5, "a b c d e f"), (5, "q r s t u v"), (9, "q r s t u v")], "doc_id long, text string")
    assert {r.component_id for r in near_duplicates(twice).collect()} == {1}
