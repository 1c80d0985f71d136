"""Ranked lexical search: every document against every item, on document FP-trees.

Terms are maximal runs of ASCII letters, digits and other non-ASCII characters, A-Z
lower-cased.  With N documents that have terms, L terms in all, n terms in a document and
df documents with a term, integers rounded down:

    w = floor(1000 * ln((2N + 2) / (2df + 1)))      m = 100 - 50 + (50 * n * N) div L
    score = sum of w * ((10^9 * tf) div (1000 * tf + 20 * m)) over the terms of the item

1. One pass over the texts restricts every document to the terms that any item holds: a
   narrow table of (doc_id, n, terms, tfs).  N, L and df are counted over all of it.
2. Every task deals the restricted vectors of its rows into trees of ``tree`` documents.
   A tree is the trie of the vectors with terms in order of falling df, so documents with
   the same frequent terms share a path.  Nodes of at most ``leaf`` documents are not
   split further and paths without branches are one node.  Each node knows the largest tf
   of every term, and the smallest m, of the documents below it.
3. A term's part of the score grows with tf and falls with m, and no w is negative, so a
   node's maxima and minimum bound every score below it.  For each item the tree is
   searched depth first, best bound first; a subtree whose bound is below the item's
   current last place is left out.  Places are carried from tree to tree within a task.
4. The best of every task are ranked, first in lots, then as a whole.

Items are taken in blocks of about ``items``, so what a task holds of them is bounded
however many there are; each block is a pass of its own.

Defined cases: NULL, empty and termless texts and items match nothing; rows of items that
share an item_id are one item with the terms of all of them, rows without item_id are left
out; every row of ``docs`` is a document of its own, and one without doc_id comes last
among equal scores; without documents or items the result is empty; extra columns are
ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataload.llm.common import settle


@dataclass(frozen=True)
class SearchSpec:
    """``top`` documents per item; documents per ``tree`` and per ``leaf``; ``items`` per block."""

    top: int = 50
    tree: int = 8192
    leaf: int = 32
    items: int = 2000


# lower-cases A-Z and turns every ASCII character that is no letter or digit into a space
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def part(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term gives to the score; 0 where tf is 0."""
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


class Tree:
    """The documents of a block as a trie of their vectors, with bounds at its nodes."""

    def __init__(self, ids: list, m: np.ndarray, vectors: list[np.ndarray], tfs: list[np.ndarray], leaf: int):
        """``vectors``: rising term numbers (0 is the most frequent term); ``tfs`` beside them."""
        order = sorted(range(len(ids)), key=lambda i: vectors[i].astype(">u4").tobytes())
        self.ids = [ids[i] for i in order]
        self.m = m[order]
        self.offsets = np.cumsum([0, *(len(vectors[i]) for i in order)])
        self.terms = np.concatenate([vectors[i] for i in order])
        self.tfs = np.concatenate([tfs[i] for i in order])
        self.lengths = np.diff(self.offsets)
        self.nodes: list[tuple[int, int, list[int]]] = []  # first and last document, children
        self.least_m: list[int] = []
        self._grow(leaf)
        self._by_term()

    def _children(self, low: int, high: int, depth: int) -> list[tuple[int, int, int]]:
        """Groups of documents by their next term after ``depth`` common ones."""
        while True:
            at = self.offsets[low:high] + depth
            here = self.lengths[low:high] > depth
            next_ = np.where(here, self.terms[np.where(here, at, 0)], -1)
            cuts = np.nonzero(np.diff(next_))[0] + 1
            if len(cuts) or not here[0]:
                break
            depth += 1
        if not len(cuts):
            return []  # equal vectors
        edges = [low, *(cuts + low).tolist(), high]
        return [(a, b, depth + 1) for a, b in zip(edges, edges[1:])]

    def _grow(self, leaf: int) -> None:
        todo = [(0, len(self.ids), 0, -1)]
        while todo:
            low, high, depth, parent = todo.pop()
            number = len(self.nodes)
            self.nodes.append((low, high, []))
            self.least_m.append(int(self.m[low:high].min()))
            if parent >= 0:
                self.nodes[parent][2].append(number)
            if high - low > leaf:
                todo += [(*child, number) for child in self._children(low, high, depth)]

    def _by_term(self) -> None:
        """For each term the nodes that have it below them, with its largest tf there."""
        found = []
        for number, (low, high, children) in enumerate(self.nodes):
            if not children:
                span = slice(self.offsets[low], self.offsets[high])
                found.append(self._largest(self.terms[span], self.tfs[span]))
            else:
                found.append(None)
        for number in range(len(self.nodes) - 1, -1, -1):  # children have larger numbers
            children = self.nodes[number][2]
            if children:
                found[number] = self._largest(*(np.concatenate([found[c][i] for c in children]) for i in (0, 1)))
        names = np.concatenate([t for t, _ in found])
        order = np.argsort(names, kind="stable")
        self.held = names[order]
        self.holders = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])[order]
        self.largest = np.concatenate([x for _, x in found])[order]

    @staticmethod
    def _largest(names: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort([values, names])
        names, values = names[order], values[order]
        last = np.ones(len(names), bool)
        last[:-1] = names[1:] != names[:-1]
        return names[last], values[last]

    def bounds(self, item: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every node a score that none below it exceeds."""
        first, last = np.searchsorted(self.held, item, "left"), np.searchsorted(self.held, item, "right")
        least_m, out = np.array(self.least_m, np.int64), np.zeros(len(self.nodes), np.int64)
        for a, b, w in zip(first.tolist(), last.tolist(), weights.tolist()):
            nodes = self.holders[a:b]  # each at most once
            out[nodes] += part(w, self.largest[a:b], least_m[nodes])
        return out

    def scores(self, low: int, high: int, slots: np.ndarray) -> np.ndarray:
        """Scores of the documents low .. high - 1; ``slots`` has an item's weights by term."""
        span = slice(self.offsets[low], self.offsets[high])
        given = slots[self.terms[span]]
        hit = np.nonzero(given)[0]
        owner = np.repeat(np.arange(high - low), self.lengths[low:high])[hit]
        out = np.zeros(high - low, np.int64)
        np.add.at(out, owner, part(given[hit], self.tfs[span][hit], self.m[low:high][owner]))
        return out

    def search(self, item: np.ndarray, weights: np.ndarray, slots: np.ndarray, places: Places) -> int:
        """Offers all documents that can take a place; the number of leaves looked at."""
        bounds, todo, looked = self.bounds(item, weights), [0], 0
        while todo:
            low, high, children = self.nodes[at := todo.pop()]
            if bounds[at] < places.least:
                continue
            if children:
                todo += sorted(children, key=bounds.__getitem__)  # the best bound is taken next
                continue
            looked += 1
            scores = self.scores(low, high, slots)
            for i in np.nonzero(scores >= places.least)[0].tolist():
                places.offer(int(scores[i]), self.ids[low + i])
        return looked


class Places:
    """The best documents of an item so far."""

    def __init__(self, top: int):
        self.top, self.least, self.heap = top, 1, []

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0))
        if len(self.heap) < self.top:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)
        if len(self.heap) == self.top:
            self.least = self.heap[0][0]

    def entries(self) -> list[tuple[int | None, int]]:
        return [(-minus_id if known else None, score) for score, known, minus_id in self.heap]


def restricted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): each document's number of terms, and those in ``numbers``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch.text:
                words = terms(text)
                known = Counter(n for n in map(numbers.get, words) if n is not None)
                rows.append((len(words), list(known.keys()), list(known.values())))
            made = pd.DataFrame(rows, columns=["n", "terms", "tfs"])
            yield pd.DataFrame({"doc_id": batch.doc_id.values, **{c: made[c].values for c in made}})

    # ids travel as text: NULL would turn a column of numbers into inexact ones
    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text")
    found = texts.mapInPandas(run, "doc_id string, n long, terms array<int>, tfs array<long>")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


@dataclass(frozen=True)
class Items:
    """Items by number: term numbers and weights; ``rank``: term number to place by falling df."""

    terms: list[np.ndarray]
    weights: list[np.ndarray]
    rank: np.ndarray


def _best(vectors: DataFrame, items: Items, documents: int, length: int, spec: SearchSpec) -> DataFrame:
    """(item, doc_id, score): what takes a place among the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [Places(spec.top) for _ in items.terms]
        slots = np.zeros(len(items.rank), np.int64)
        ids: list = []
        sizes: list[np.ndarray] = []
        found: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def finish() -> None:
            if not ids:
                return
            m = 50 + (50 * np.concatenate(sizes) * documents) // length
            tree = Tree(ids, m, found, counts, spec.leaf)
            for item, weights, mine in zip(items.terms, items.weights, places):
                slots[item] = weights
                tree.search(item, weights, slots, mine)
                slots[item] = 0
            for kept in (ids, sizes, found, counts):
                kept.clear()

        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            sizes.append(batch.column("n").to_numpy().astype(np.int64))
            lists = [batch.column(c) for c in ("terms", "tfs")]
            ends = lists[0].offsets.to_numpy()
            ranked = items.rank[lists[0].values.to_numpy()]
            tfs = lists[1].values.to_numpy()
            shift = lists[1].offsets.to_numpy()[0] - ends[0]
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                order = np.argsort(ranked[a:b])
                found.append(ranked[a:b][order])
                counts.append(tfs[a + shift : b + shift][order])
            if len(ids) >= spec.tree:
                finish()
        finish()
        for number, mine in enumerate(places):
            entries = mine.entries()
            if entries:
                made = zip(*entries)
                columns = [pa.array([number] * len(entries), pa.int32()), *(pa.array(c, pa.int64()) for c in made)]
                yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return vectors.filter("size(terms) > 0").mapInArrow(run, "item int, doc_id long, score long")


_LOTS = 64


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item with their rank; a task gets a lot of an item first."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(_LOTS))
    rows = found.withColumn("lot", lot).withColumn("rank", F.row_number().over(Window.partitionBy("item", "lot").orderBy(*order)))
    rows = rows.filter(F.col("rank") <= top).drop("lot", "rank")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)


def _block(docs: DataFrame, block: DataFrame, spec: SearchSpec) -> DataFrame | None:
    """The result for one block of items; None if they have no terms or no document does."""
    spark = docs.sparkSession
    held: dict = {}
    for item_id, text in block.select("item_id", "text").collect():  # about spec.items rows
        held.setdefault(item_id, set()).update(terms(text))
    names = sorted(i for i in held if held[i])
    vocabulary = sorted(set().union(*held.values()))
    if not names:
        return None
    numbers = {term: i for i, term in enumerate(vocabulary)}
    vectors = settle(restricted(docs, numbers))
    documents, length = vectors.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the vocabulary
        df[term] = count
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    weights = np.array([weight(documents, int(d)) for d in df], np.int64)
    own = [np.array(sorted(map(numbers.__getitem__, held[i]))) for i in names]
    items = Items([rank[o] for o in own], [weights[o] for o in own], rank)
    best = _ranked(settle(_best(vectors, items, documents, length, spec)), spec.top)
    schema = block.select(F.lit(0).alias("item"), "item_id").schema
    named = spark.createDataFrame(list(enumerate(names)), schema)
    return best.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, spec: SearchSpec = SearchSpec()) -> DataFrame:
    """Columns item_id, rank (from 1), doc_id, score: the best documents of each item."""
    items = items.filter("item_id is not null").select("item_id", "text")
    blocks = max(1, math.ceil(items.count() / spec.items))
    mine = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = [_block(docs, items.filter(mine == i) if blocks > 1 else items, spec) for i in range(blocks)]
    found = [f for f in found if f is not None]
    if not found:
        kind = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out
