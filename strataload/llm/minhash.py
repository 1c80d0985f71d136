"""Near-duplicate documents by circulant MinHash, with exact Jaccard verification.

Circulant MinHash needs two permutations instead of one per coordinate: ``sigma``
shuffles the shingle universe once, and coordinate k is the minimum of one second
permutation ``pi`` shifted circularly by k.  The universe is the ring of 32-bit
numbers; both permutations are bijections of it, so the shift is an addition.

Steps: (1) one pass over the texts gives each document its shingle count, a 128-bit
digest of its shingle set, band keys and a short sketch; (2) equal sets form one class,
so a hot group of copies is one row from here on; (3) classes that share a band key are
compared through pivots (below); (4) a pair that the sketches do not rule out is
verified on its full shingle sets; (5) links are contracted to components.

A bucket of m classes is not expanded to its pairs.  Its smallest member is compared with
the others first, which finds nearly all links.  Buckets whose other members are still in
different components are dealt into blocks, and each pair of blocks decides in one task:
the sizes of all its intersections are one matrix product over the sets, and only links
that join two components leave the task, fewer than the blocks have members.  No pair of
a bucket that could join two components is left out.

Defined cases: a NULL or wordless text has no shingles and is linked with nothing; a
text with fewer words than a shingle is one shingle, its whole sequence; rows that
share a doc_id are one node; rows without doc_id are linked with nothing and kept, with
component_id NULL; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.common import WordHashes, append, fresh, lower_words, rolled, settle, spanning
from strataload.operators.skew import join_side


@dataclass(frozen=True)
class NearDupSpec:
    """``percent``: least Jaccard similarity of a link.  ``bands`` x ``rows`` coordinates.

    At a similarity of 0.85 a pair meets in no band with probability 1.2e-5.
    ``sketch_margin`` is the number of standard deviations by which two sketches must
    fall short of ``percent`` before a pair is ruled out without its sets.
    """

    shingle: int = 5
    percent: int = 85
    bands: int = 24
    rows: int = 6
    sketch_margin: float = 4.5

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def least_matches(self) -> float:
        p = self.percent / 100
        return self.size * p - self.sketch_margin * (self.size * p * (1 - p)) ** 0.5


def shingle_set(hashes: WordHashes, text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = lower_words(text)
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(rolled(hashes.of(words), min(size, len(words))))


def _mix32(x: np.ndarray) -> np.ndarray:
    """A bijection of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash coordinates 0 .. size-1 of a non-empty shingle set."""
    sigma = _mix32((shingles >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
    shifts = np.arange(size, dtype=np.uint32) * np.uint32(0x9E3779B1)  # shifts of one permutation
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(sigma), 1024):
        out = np.minimum(out, _mix32(sigma[start : start + 1024, None] + shifts).min(axis=0))
    return out


def band_keys(coordinates: np.ndarray, spec: NearDupSpec) -> np.ndarray:
    table = coordinates.reshape(spec.bands, spec.rows).astype(np.uint64)
    keys = np.arange(1, spec.bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(spec.rows):
        keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + table[:, j]
    return (keys ^ (keys >> np.uint64(32))).view(np.int64)


_FEATURES = (
    T.StructType()
    .add("n_shingles", "long")
    .add("set_a", "long")
    .add("set_b", "long")
    .add("bands", T.ArrayType(T.LongType()))
    .add("sketch", "binary")
)


def _featured(docs: DataFrame, spec: NearDupSpec) -> DataFrame:
    """doc_id, and of each text the size and digest of its shingle set, band keys and a sketch."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        hashes, rows = WordHashes(), []
        for text in batch.text:
            shingles = shingle_set(hashes, text, spec.shingle)
            if not len(shingles):
                rows.append((0, None, None, None, None))
                continue
            coordinates = signature(shingles, spec.size)
            a, b = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64).tolist()
            sketch = coordinates.astype(np.uint8).tobytes()
            rows.append((len(shingles), a, b, band_keys(coordinates, spec).tolist(), sketch))
        return pd.DataFrame(rows, columns=_FEATURES.names, dtype=object)

    return append(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["text"], run, _FEATURES).drop("text")


def _sets_of(docs: DataFrame, ids: DataFrame, spec: NearDupSpec) -> DataFrame:
    """Full shingle sets of the documents in ``ids``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(hashes, text, spec.shingle).tobytes() for text in batch.text]
            yield pd.DataFrame({"id": batch.id, "shingles": sets})

    wanted = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return wanted.mapInPandas(run, "id long, shingles binary")


def _sketches_agree(pairs: DataFrame, spec: NearDupSpec) -> DataFrame:
    least = spec.least_matches

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (
                    np.frombuffer(b"".join(batch[c]), np.uint8).reshape(len(batch), spec.size)
                    for c in ("sketch_a", "sketch_b")
                )
                agree = ((a == b).sum(axis=1) >= least) | batch.several_a | batch.several_b
                yield batch.loc[agree, ["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def _verified(pairs: DataFrame, spec: NearDupSpec) -> DataFrame:
    percent = spec.percent

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.set_a, batch.set_b):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[linked, ["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """Rows (u, m) for every node with an edge: m is the smallest node it can reach, u > m.

    Alternating star contraction: neighbours move to the smallest neighbour, first from
    the larger nodes, then from the smaller ones, until every component is a star.
    """
    stars = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    while True:
        # a star: every node has one smaller neighbour, which has none
        parents = stars.groupBy("u").agg(F.count(F.lit(1)).alias("parents"))
        centers = stars.select(F.col("v").alias("u")).distinct().withColumn("center", F.lit(True))
        if parents.join(centers, "u", "left").filter("parents > 1 or center").isEmpty():
            break
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = join_side(both, ["u"], F.min("v").alias("n")).withColumn("m", F.least("u", "n")).drop("n")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        met = large.join(join_side(large, ["u"], F.min("v").alias("m")), "u")
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        stars = settle(met.select(F.explode(ends).alias("e")).select("e.*").filter("u > v").distinct())
    return stars.withColumnRenamed("v", "m")


def _linked(candidates: DataFrame, sketches: DataFrame, sets, spec: NearDupSpec) -> DataFrame:
    """The verified pairs of ``candidates`` (a, b): on sketches first, then on full sets."""
    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"), F.col("several").alias("several_a"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"), F.col("several").alias("several_b"))
    likely = settle(_sketches_agree(candidates.join(left, "a").join(right, "b"), spec))
    known = sets(likely.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    return settle(
        _verified(
            likely.join(known.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a").join(
                known.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b"
            ),
            spec,
        ).distinct()
    )


# A block holds about so many members of a bucket, and so many shingles, at most.
_BLOCK_MEMBERS, _BLOCK_SHINGLES = 512, 1 << 18


def common_shingles(x: list[np.ndarray], y: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every set of ``x`` with every set of ``y``.

    Sets as rows over the shingles that several of them hold: a matrix product, taken over
    ``width`` shingles at a time.
    """
    sets = [*x, *y]
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    rows, values = rows[order], values[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    again = np.concatenate([~first[1:], [False]]) | ~first  # in several sets
    rows, shingle = rows[again], np.cumsum(first[again]) - 1
    out = np.zeros((len(x), len(y)), np.float32)
    for low in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, width):
        span = slice(*np.searchsorted(shingle, (low, low + width)))
        table = np.zeros((len(sets), width), np.float32)
        table[rows[span], shingle[span] - low] = 1
        out += table[: len(x)] @ table[len(x) :].T  # whole numbers below 2^24 are exact
    return out.astype(np.int64)


def _block_links(x: dict, y: dict, percent: int) -> list[tuple[int, int]]:
    """Links between members of two blocks (or of one) that hold their components together."""
    both = common_shingles(x["sets"], y["sets"])
    union = x["n"][:, None] + y["n"][None] - both
    linked = (both > 0) & (100 * both >= percent * union) & (x["label"][:, None] != y["label"][None])
    i, j = np.nonzero(linked)
    if not len(i):
        return []
    labels, flat = np.unique(np.concatenate([x["label"][i], y["label"][j]]), return_inverse=True)
    p, q = flat[: len(i)], flat[len(i) :]
    table = np.zeros((len(labels), len(labels)), bool)
    table[p, q] = table[q, p] = True
    pair_of = dict(zip(zip(np.minimum(p, q).tolist(), np.maximum(p, q).tolist()), zip(i.tolist(), j.tolist())))
    found = [pair_of[min(e), max(e)] for e in spanning(table)]
    return [(int(x["id"][a]), int(y["id"][b])) for a, b in found]


def _bucket_links(members: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of each bucket, from rows (key, id, n, label).

    Buckets are dealt into blocks, and blocks of one bucket meet each other.  A pair of
    blocks compares all its sets and sends out fewer links than it has members.
    """
    totals = join_side(members, ["key"], F.count(F.lit(1)).alias("count"), F.sum("n").alias("mass"))
    blocks = F.ceil(F.greatest(F.col("count") / _BLOCK_MEMBERS, F.col("mass") / _BLOCK_SHINGLES))
    rows = members.join(totals, "key").withColumn("block", F.pmod(F.xxhash64("id"), blocks)).join(known, "id")
    blocks = rows.groupBy("key", "block").agg(F.collect_list(F.struct("id", "label", "shingles")).alias("rows"))
    blocks = settle(blocks)
    left = blocks.select("key", F.col("block").alias("block_a"), F.col("rows").alias("rows_a"))
    met = blocks.join(left, "key").filter("block_a <= block")
    met = met.select((F.col("block_a") == F.col("block")).alias("same"), "rows_a", F.expr("if(block_a = block, null, rows)").alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for i in range(batch.num_rows):
                x = _columns(batch.column("rows_a")[i].values)
                y = x if batch.column("same")[i].as_py() else _columns(batch.column("rows")[i].values)
                links += _block_links(x, y, percent)
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def _columns(rows: pa.StructArray) -> dict:
    out = {c: rows.field(c).to_numpy() for c in ("id", "label")}
    sets = [np.frombuffer(b, np.uint64) for b in rows.field("shingles").to_pylist()]
    return out | {"sets": sets, "n": np.array([len(s) for s in sets], np.int64)}


def near_duplicates(docs: DataFrame, spec: NearDupSpec = NearDupSpec()) -> DataFrame:
    """Columns doc_id, n_shingles, component_id, kept (doc_id = component_id): one row per input row."""
    table = settle(_featured(docs, spec))
    nodes = table.filter("doc_id is not null and n_shingles > 0")
    digest = ["set_a", "set_b"]
    classes = settle(
        join_side(nodes, digest, F.min("doc_id").alias("id"), F.max("doc_id").alias("last"), F.first("n_shingles").alias("n"))
    )
    leaders = classes.select(F.col("id").alias("doc_id"), *digest)
    leading = nodes.join(leaders, ["doc_id", *digest], "left_semi")
    # of an id with several sets the sketch of one says nothing
    sketches = leading.groupBy(F.col("doc_id").alias("id")).agg(
        F.first("sketch").alias("sketch"), (F.count(F.lit(1)) > 1).alias("several")
    )
    sketches = settle(sketches)  # met several times below

    # rows of one doc_id with different sets join their classes
    several = nodes.groupBy("doc_id").agg(F.min("set_a").alias("x"), F.max("set_a").alias("y")).filter("x <> y")
    again = nodes.join(several.select("doc_id"), "doc_id").join(classes.select("id", *digest), digest)
    same_id = again.filter("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))

    members = leading.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    buckets = join_side(members, ["key"], F.min("id").alias("first"), F.max("id").alias("other"))
    buckets = buckets.filter("first < other").drop("other")
    members = settle(members.join(buckets, "key"))

    cache: dict[str, DataFrame] = {}

    def sets(ids: DataFrame) -> DataFrame:
        """Sets of the documents in ``ids`` at least; those read before are kept."""
        if "sets" not in cache:
            cache["sets"] = settle(_sets_of(docs, ids, spec))
        else:
            more = settle(ids.join(cache["sets"], "id", "left_anti"))
            if not more.isEmpty():
                cache["sets"] = cache["sets"].unionAll(settle(_sets_of(docs, more, spec)))
        return cache["sets"]

    candidates = members.filter("id > first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    edges = settle(same_id.unionAll(_linked(candidates, sketches, sets, spec)))
    stars = components(edges)

    # all pairs with the smallest member are done; what else of a bucket may be linked?
    rest = members.filter("id > first").select("key", "id", "n").distinct()
    rest = rest.join(stars.select(F.col("u").alias("id"), "m"), "id", "left")
    rest = rest.withColumn("label", F.coalesce("m", "id")).drop("m")
    apart = join_side(
        rest,
        ["key"],
        F.min("label").alias("x"),
        F.max("label").alias("y"),
        *[F.bit_xor(F.xxhash64("id", F.lit(seed))).alias(f"members_{seed}") for seed in (1, 2)],
    ).filter("x <> y")
    # buckets with the same members are one
    apart = apart.groupBy("members_1", "members_2").agg(F.min("key").alias("key"))
    rest = settle(rest.join(apart.select("key"), "key"))
    if not rest.isEmpty():
        known = sets(rest.select("id").distinct())
        more = settle(_bucket_links(rest, known, spec.percent).distinct())
        if not more.isEmpty():
            stars = components(stars.select(F.col("u").alias("a"), F.col("m").alias("b")).unionAll(more))

    named = classes.join(stars.select(F.col("u").alias("id"), "m"), "id", "left")
    named = settle(named.select(*digest, F.coalesce("m", "id").alias("m"), "last").filter("m < last").drop("last"))
    placed = table.join(named, digest, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("m", "doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, spec: NearDupSpec = NearDupSpec()) -> DataFrame:
    """Stage: the documents of ``docs`` without near duplicates, one of each component.

    Rows without doc_id all stay; of rows that share the doc_id that stays, one does (the
    one whose text sorts first).
    """
    kept_id, row = fresh(docs, "kept_id", "row")
    kept = near_duplicates(docs, spec).filter("kept and doc_id is not null")
    kept = kept.select(F.col("doc_id").alias(kept_id)).distinct()
    stays = docs.join(kept, F.col("doc_id") == F.col(kept_id), "left_semi")
    # a doc_id that occurs once, the rule, is alone in its group
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    stays = stays.withColumn(row, F.row_number().over(one)).filter(F.col(row) == 1).drop(row)
    return stays.unionByName(docs.filter("doc_id is null"))
