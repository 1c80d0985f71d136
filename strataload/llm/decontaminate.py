"""Benchmark decontamination by greedy string tiling.

A document leaks an item if tiles, non-overlapping runs of tokens that occur in both,
cover a large enough part of the item.  Order does not matter, so a passage whose
sentences were moved around is caught as well.

Pairs to tile come from a join on shared seeds, hashes of ``least_tile`` tokens.  A
filter of fixed size, built from the benchmark's seeds, drops most document seeds before
that join; it has false hits but no misses, and the join decides.  A pair is tiled only
if the seeds it shares could cover the item.  Tiling takes the longest common run that
is left again and again; running Karp-Rabin hashes find the runs, token hashes confirm
them.

Defined cases: tokens are runs of word characters, case-folded.  A NULL or empty text
has no tokens.  An item with fewer tokens than a tile cannot be covered; one
without item_id is not searched for.  Rows are
judged one by one, so repeated rows are found each, also without doc_id.  Items with the
same text are found each.  Empty tables give an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.common import WordHashes, append, fresh, settle

_TOKEN = re.compile(r"\w+")


@dataclass(frozen=True)
class LeakSpec:
    """``coverage``: least covered part of an item; ``filter_bits``: log2 of the filter's size."""

    least_tile: int = 4
    coverage: float = 0.6
    filter_bits: int = 25


_BASE = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(hashes: WordHashes, text: str | None) -> np.ndarray:
    if not text:
        return np.empty(0, np.uint64)
    return hashes.of([t.encode("utf-8", "surrogatepass") for t in _TOKEN.findall(text.casefold())])


def windows(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2^64, of all windows of ``size`` tokens.

    The rolling step is a difference of running sums: window hash = B^-i (S[i+size] - S[i])
    is kept as the polynomial sum itself by Horner's rule over the window.
    """
    count = len(tokens) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out *= _BASE
        out += tokens[i : i + count]
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)


_LISTED = 1 << 20  # places of common windows that are listed at once


def _runs(in_item: np.ndarray, in_doc: np.ndarray, least: int) -> np.ndarray:
    """Maximal runs of equal windows along the diagonals: rows (start in item, start in doc, tokens).

    The places of common windows are listed if they are few.  Where both sides repeat
    themselves their number is the product of the repeats: then the diagonals are compared
    in blocks of bounded size, and only runs are kept.
    """
    spots = np.flatnonzero(np.isin(in_doc, in_item))
    if not len(spots):
        return np.empty((0, 3), np.int64)
    order = np.argsort(in_item, kind="stable")
    ranked = in_item[order]
    low, high = np.searchsorted(ranked, in_doc[spots], "left"), np.searchsorted(ranked, in_doc[spots], "right")
    counts = high - low
    if counts.sum() > _LISTED:
        return _runs_by_block(in_item, in_doc, least)
    j = np.repeat(spots, counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    i = order[np.repeat(low, counts) + offset]
    # consecutive hits on one diagonal are one maximal run
    by = np.lexsort((i, j - i))
    i, j = i[by], j[by]
    starts = np.flatnonzero(np.r_[True, (np.diff(i) != 1) | (np.diff(j) != 1)])
    lengths = np.diff(np.r_[starts, len(i)]) + least - 1
    return np.stack([i[starts], j[starts], lengths], axis=1)


def _runs_by_block(in_item: np.ndarray, in_doc: np.ndarray, least: int) -> np.ndarray:
    """The same from blocks of diagonals; the item is taken in pieces too, with runs joined across them."""
    found = []
    for top in range(0, len(in_item), 4096):  # rows of the comparison: windows of the item
        piece = in_item[top : top + 4096]
        rows = np.arange(len(piece))
        width = max(1, _LISTED // len(piece))
        for first in range(-(len(piece) - 1), len(in_doc), width):
            diagonal = np.arange(first, min(first + width, len(in_doc)))[:, None]
            at = diagonal + rows
            inside = (at >= 0) & (at < len(in_doc))
            same = np.zeros((len(diagonal), len(piece) + 2), np.int8)
            same[:, 1:-1] = inside & (in_doc[np.where(inside, at, 0)] == piece)
            d, i = np.nonzero(np.diff(same, axis=1))
            starts, ends = (d[::2], i[::2]), i[1::2]
            found.append(np.stack([starts[1] + top, starts[1] + first + starts[0], ends - starts[1]], axis=1))
    runs = np.concatenate(found)
    runs = runs[np.lexsort([runs[:, 0], runs[:, 1] - runs[:, 0]])]
    # a run that ends where a piece does goes on in the next one
    on = (np.diff(runs[:, 1] - runs[:, 0]) == 0) & (runs[1:, 0] == runs[:-1, 0] + runs[:-1, 2])
    starts = np.flatnonzero(np.r_[True, ~on])
    return np.stack([runs[starts, 0], runs[starts, 1], np.add.reduceat(runs[:, 2], starts) + least - 1], axis=1)


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (start in item, start in doc, length), longest first.

    Ties go to the earlier place in the item, then in the document.
    """
    heap = [(-int(n), int(i), int(j)) for i, j, n in _runs(windows(item, least), windows(doc, least), least)]
    heapq.heapify(heap)
    used_item, used_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    out = []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = ~(used_item[a : a + n] | used_doc[b : b + n])
        if free.all():
            if np.array_equal(item[a : a + n], doc[b : b + n]):
                used_item[a : a + n] = used_doc[b : b + n] = True
                out.append((a, b, n))
                if used_item.all():
                    break
            continue
        edges = np.flatnonzero(np.diff(np.r_[False, free, False].astype(np.int8)))
        for x, y in zip(edges[::2], edges[1::2]):
            if y - x >= least:
                heapq.heappush(heap, (-int(y - x), a + int(x), b + int(x)))
    return out


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _seeds(items: DataFrame, spec: LeakSpec) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            for item_id, text in zip(batch.item, batch.text):
                tokens = token_hashes(hashes, text)
                found = windows(tokens, spec.least_tile).view(np.int64)
                yield pd.DataFrame(
                    {"item": item_id, "n_tokens": len(tokens), "seed": found, "place": np.arange(len(found))}
                )

    return items.select("item", "text").mapInPandas(run, "item string, n_tokens int, seed long, place int")


def _filter_of(seeds: DataFrame, spec: LeakSpec) -> np.ndarray:
    """The seeds as a bit set of fixed size, put together from pieces of 2^15 bits."""
    piece = 15
    bit = F.col("seed").bitwiseAND(F.lit((1 << spec.filter_bits) - 1))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << piece, bool)
        bits[rows.bit.to_numpy() & ((1 << piece) - 1)] = True
        return pd.DataFrame({"part": [rows.part.iloc[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    found = seeds.select(bit.alias("bit")).distinct().withColumn("part", F.shiftright("bit", piece))
    out = np.zeros(1 << (spec.filter_bits - 3), np.uint8)
    width = 1 << (piece - 3)
    for row in found.groupBy("part").applyInPandas(pack, "part long, bits binary").toLocalIterator():
        out[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return out


def _document_seeds(docs: DataFrame, seeds: DataFrame, spec: LeakSpec) -> DataFrame:
    """Distinct seeds of each document that the filter lets through."""
    kept = docs.sparkSession.sparkContext.broadcast(_filter_of(seeds, spec))  # of fixed size
    mask = np.uint64((1 << spec.filter_bits) - 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, bits = WordHashes(), kept.value
        for batch in batches:
            keys, found = [], []
            for key, text in zip(batch.row, batch.text):
                all_seeds = windows(token_hashes(hashes, text), spec.least_tile)
                spot = all_seeds & mask
                hit = (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1
                if hit.any():
                    own = np.unique(all_seeds[hit.astype(bool)]).view(np.int64)
                    keys.append(np.full(len(own), key))
                    found.append(own)
            if keys:
                yield pd.DataFrame({"row": np.concatenate(keys), "seed": np.concatenate(found)})

    return docs.select(_row_key().alias("row"), "text").mapInPandas(run, "row long, seed long")


def find_leaks(docs: DataFrame, benchmark: DataFrame, spec: LeakSpec = LeakSpec()) -> DataFrame:
    """A row per leaking row of ``docs`` and item.

    Columns: doc_id, row (key of the row: its doc_id and text), item (item_id as text),
    n_tokens, covered (tokens of the item in tiles), n_tiles, coverage.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("text is not null")
    seeds = settle(_seeds(items, spec))
    found = _document_seeds(docs, seeds, spec)
    share, least = spec.coverage, spec.least_tile
    pairs = (
        found.join(seeds, "seed")
        .groupBy("row", F.struct("item").alias("of"), "n_tokens")
        .agg(F.countDistinct("place").alias("hits"))
        .filter(F.col("hits") * least >= F.col("n_tokens") * share)
        .select("row", "of.item")
    )
    pairs = settle(pairs)
    texts = docs.select("doc_id", _row_key().alias("row"), "text")
    named = items.select("item", F.col("text").alias("item_text"))

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        hashes, out = WordHashes(), []
        for text, item_text in zip(batch.text, batch.item_text):
            item = token_hashes(hashes, item_text)
            own = tiles(token_hashes(hashes, text), item, least)
            covered = sum(n for _, _, n in own)
            out.append((len(item), covered, len(own), covered / len(item) if len(item) else 0.0))
        return pd.DataFrame(out, columns=added.names, dtype=object)

    added = T.StructType().add("n_tokens", "integer").add("covered", "integer").add("n_tiles", "integer").add("coverage", "double")
    joined = texts.join(pairs, "row").join(named, "item").select("doc_id", "row", "item", "text", "item_text")
    return append(joined, ["text", "item_text"], run, added).filter(F.col("coverage") >= share).drop("text", "item_text")


def without_leaks(docs: DataFrame, benchmark: DataFrame, spec: LeakSpec = LeakSpec()) -> DataFrame:
    """Stage: the rows of ``docs`` that leak no item."""
    (row,) = fresh(docs, "row")
    leaking = find_leaks(docs, benchmark, spec).select(F.col("row").alias(row)).distinct()
    return docs.join(leaking, _row_key() == F.col(row), "left_anti")
