"""Malformed pages and repetitive texts take time and memory in proportion."""

import random
import resource
import time

import numpy as np
import pytest

from strataload.llm import decontaminate, htmltext
from strataload.llm.decontaminate import tiles, windows


def tree(node):
    return (node.tag, node.attributes, [c if isinstance(c, str) else tree(c) for c in node.children])


BAD = {
    "open tags": "<a " * 300_000,
    "open tags, closed once": "<a " * 300_000 + ">",
    "open quotes": '<a b="x ' * 100_000 + ">",
    "odd quotes": "<a ' > " * 100_001,
    "quoted ends": '<a ">" ' * 100_000,
    "declarations": "<!x " * 300_000,
    "comments": "<!-- " * 300_000,
    "end tags": "<b>" * 12_000 + "</i>" * 12_000,
    "paragraphs": "<b>" * 12_000 + "<p></p>" * 12_000,
    "signs": "<" * 500_000 + ">" * 500_000,
}


@pytest.mark.parametrize("name", BAD)
def test_malformed_pages(name):
    start = time.process_time()
    htmltext.parse(BAD[name])
    assert time.process_time() - start < 2


def test_trees():
    page = "<!DOCTYPE html><html a=1><head><title>x<y</title><body class='a > b'><!-- no > --><p>one<p id=\"q\">two</i></b><ul><li>x<li>y</ul>z < 3"
    assert tree(htmltext.parse(page)) == (
        "html", " a=1",
        [
            ("head", "", [("title", "", ["x<y"])]),
            ("body", " class='a > b'", [("p", "", ["one"]), ("p", ' id="q"', ["two"]), ("ul", "", [("li", "", ["x"]), ("li", "", ["y"])]), "z < 3"]),
        ],
    )
    assert tree(htmltext.parse('<a b="open > x')) == ("html", "", [("a", ' b="open ', [" x"])])


def plain_runs(a, b, least):
    out = []
    for i in range(len(a)):
        for j in range(len(b)):
            if i and j and a[i - 1] == b[j - 1]:
                continue
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if n >= least:
                out.append((i, j, n))
    return sorted(out)


@pytest.mark.parametrize("listed", [1, 64, 1 << 20])
def test_runs(monkeypatch, listed):
    rng = random.Random(listed)
    monkeypatch.setattr(decontaminate, "_LISTED", listed)
    for _ in range(60):
        a, b = ([rng.choice((1, 2, 3)) for _ in range(rng.randint(0, 40))] for _ in range(2))
        found = decontaminate._runs(*(windows(np.array(x, np.uint64), 4) for x in (a, b)), 4)
        assert sorted(map(tuple, found.tolist())) == plain_runs(a, b, 4)


def test_repetition_takes_bounded_memory():
    doc, item = np.full(20_000, 7, np.uint64), np.full(1_000, 7, np.uint64)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    start = time.process_time()
    assert tiles(doc, item, 4) == [(0, 0, 1000)]
    assert time.process_time() - start < 3
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000
    two = np.tile(np.array([1, 2], np.uint64), 10_000)
    assert sum(n for _, _, n in tiles(two, two[:1001], 4)) >= 1000


def test_long_items_in_pieces():
    rng = np.random.default_rng(3)
    item = rng.integers(0, 2, 9_000).astype(np.uint64)
    doc = np.concatenate([rng.integers(0, 2, 3_000).astype(np.uint64), item[100:8_900]])
    found = decontaminate._runs_by_block(windows(item, 4), windows(doc, 4), 4)
    assert (100, 3_000, 8_800) in {tuple(r) for r in found.tolist()} or max(found[:, 2]) >= 8_800
