"""Large groups of copies that are alike, some of them just below the threshold."""

import itertools
import random

import numpy as np
import pytest

from strataload.llm import minhash
from strataload.llm.minhash import NearDupSpec, common_shingles, near_duplicates


def loose_copies(count, changed, seed=1):
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(count):
        words = list(base)
        for at in rng.sample(range(120), changed):
            words[at] = f"x{i}of{at}"
        out.append((i, " ".join(words)))
    return out


def plain_components(rows, percent):
    sets = {}
    for i, text in rows:
        w = text.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    label = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((label[a], label[b]))
            label = {k: low if v == high else v for k, v in label.items()}
    return label


SPECS = [NearDupSpec(), NearDupSpec(percent=80, bands=30, rows=5)]


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.percent)
def test_links_grow_in_proportion(spark, monkeypatch, spec):
    made = []
    plain = minhash._bucket_links

    def counted(*args):
        links = plain(*args)
        made.append(links.count())
        return links

    monkeypatch.setattr(minhash, "_bucket_links", counted)
    rows = []
    for count in (150, 300, 600):
        made.clear()
        near_duplicates(spark.createDataFrame(loose_copies(count, 3), "doc_id long, text string"), spec).count()
        rows.append(sum(made))
    assert rows[2] < 40 * 600 and rows[2] < 8 * max(rows[0], 150)


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.percent)
@pytest.mark.parametrize("changed, size", [(2, 60), (3, 80), (4, 60)])
def test_groups_against_brute_force(spark, monkeypatch, spec, changed, size):
    monkeypatch.setattr(minhash, "_BLOCK_MEMBERS", 16)
    data = loose_copies(size, changed, seed=changed)
    found = near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), spec).collect()
    assert {r.doc_id: r.component_id for r in found} == plain_components(data, spec.percent)


def test_sizes_of_intersections():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 90, n).astype(np.uint64)) for n in (0, 1, 40, 90, 7, 30)]
    for width in (3, 4096):
        found = common_shingles(sets[:3], sets[2:], width)
        assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:3]]
