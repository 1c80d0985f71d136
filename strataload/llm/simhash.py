"""Near-duplicate documents by SimHash, candidates pruned by pigeonring filtering.

A fingerprint has 64 bits: bit b is set if more than half of the XXH64 hashes of a
text's shingles, repeats included, have it.  Two texts are linked when their fingerprints
differ in at most ``distance`` bits.

The pigeonring principle: cut the 64 bits into m segments on a ring.  If two fingerprints
differ in at most t bits, there is a segment from which on every chain of the next i
segments holds at most floor(i * t / m) differences, for all i up to m.  With m = t + 1
segments the budgets are 0, 1, 2, ... t.  It is used twice:

- *Index.*  The chains of the first ``chain`` segments give the keys: the first segment is
  equal, the second has one difference at most, and so on.  Every later segment is cut in
  ``parts`` and the parts that may differ are left out of the key, one key for each way to
  spend the budget.  A pair within the distance shares a key; two segments give 15 keys of
  about 21 bits, three give 60 of about 30 bits.
- *Filter.*  Pairs of a bucket must keep to the budget of every longer chain in turn
  before the full distance is taken.

Equal fingerprints are one row first, so copies cost nothing.  A bucket above ``block``
members is dealt into blocks, and each pair of blocks is a cell of its own, so no task
holds a whole large bucket.  A cell sends out only the links that join two of its
components, and a pair counts only in the first bucket that it shares: the rows grow with
the members of a bucket, not with its pairs.  Links are contracted to components.

Defined cases: NULL, empty and wordless texts have fingerprint zero and are linked like
any other; a text with fewer words than a shingle is one shingle; rows that share a
doc_id are one node; rows without doc_id get a fingerprint, are linked with nothing, and
have component_id NULL; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.common import append, lower_words, settle, spanning
from strataload.llm.minhash import components
from strataload.operators.skew import join_side

BITS = 64


@dataclass(frozen=True)
class SimHashSpec:
    """``distance``: most differing bits of a link.  ``chain``: segments that the keys
    cover; None takes three where two would leave more than eight chance members a bucket.
    ``block``: members of a bucket that meet in one cell."""

    shingle: int = 4
    seed: int = 42
    distance: int = 4
    chain: int | None = None
    parts: int = 3
    block: int = 1024

    @property
    def segments(self) -> int:
        return self.distance + 1

    def budget(self, length: int) -> int:
        """Most differences in a chain of ``length`` segments."""
        return length * self.distance // self.segments


def fingerprint(text: str | None, spec: SimHashSpec = SimHashSpec()) -> int:
    """The fingerprint of a text as an unsigned number; zero for a text without words."""
    words = lower_words(text)
    if not words:
        return 0
    joined, size = b" ".join(words), min(spec.shingle, len(words))
    after = np.cumsum([len(w) + 1 for w in words])  # where the next word starts
    ends = (after[size - 1 :] - 1).tolist()
    starts = [0, *after[: len(words) - size].tolist()]
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 8192):
        spans = zip(starts[at : at + 8192], ends[at : at + 8192])
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], spec.seed) for s, e in spans], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * set_bits > len(starts), bitorder="little").view("<u8")[0])


def _cut(bits: list[int], pieces: int) -> list[list[int]]:
    return [a.tolist() for a in np.array_split(np.array(bits, int), pieces)]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def segment_masks(spec: SimHashSpec) -> list[int]:
    return [_mask(s) for s in _cut(list(range(BITS)), spec.segments)]


def key_masks(spec: SimHashSpec, chain: int) -> list[tuple[int, int]]:
    """(start, mask) of every key: the bits that stay when a chain's budget is spent in one way."""
    ring = _cut(list(range(BITS)), spec.segments)
    out = []
    for start in range(spec.segments):
        later = [_cut(ring[(start + i) % spec.segments], spec.parts) for i in range(1, chain)]
        for spent in itertools.product(range(spec.parts), repeat=chain - 1):
            used = list(itertools.accumulate(spent))
            if any(u > spec.budget(i + 2) for i, u in enumerate(used)) or sum(spent) != spec.budget(chain):
                continue
            for left_out in itertools.product(*(itertools.combinations(range(spec.parts), n) for n in spent)):
                kept = [b for parts, gone in zip(later, left_out) for i, p in enumerate(parts) if i not in gone for b in p]
                out.append((start, _mask(ring[start] + kept)))
    return out


def chain_length(spec: SimHashSpec, distinct: int) -> int:
    """Segments in the keys for so many distinct fingerprints."""
    if spec.chain is not None:
        return min(spec.chain, spec.segments)
    longest = min(3, spec.segments)
    for length in range(min(2, longest), longest):
        least_bits = min(mask.bit_count() for _, mask in key_masks(spec, length))
        if distinct <= 8 << least_bits:
            return length
    return longest


class Cell:
    """Links among fingerprints that share a key."""

    def __init__(self, spec: SimHashSpec, keys: list[tuple[int, int]]):
        self.spec, self.starts = spec, [s for s, _ in keys]
        self.keys = np.array([m for _, m in keys], np.uint64)
        self.ring = np.array(segment_masks(spec), np.uint64)

    def linked(self, key: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Which differences ``x`` of pairs that share the key number ``key`` are links that
        are found there first."""
        spec, alive = self.spec, np.arange(len(x))
        start = np.array(self.starts)[key]
        chain = np.zeros(len(x), np.int64)
        for length in range(1, spec.segments):
            segment = self.ring[(start[alive] + length - 1) % spec.segments]
            chain[alive] += np.bitwise_count(x[alive] & segment)
            alive = alive[chain[alive] <= spec.budget(length)]
        alive = alive[np.bitwise_count(x[alive]) <= spec.distance]
        shares = (x[alive, None] & self.keys[None]) == 0
        shares &= self.chains_hold(x[alive])[:, self.starts]  # elsewhere the chain rules it out
        alive = alive[shares.argmax(axis=1) == key[alive]]
        found = np.zeros(len(x), bool)
        found[alive] = True
        return found

    def chains_hold(self, x: np.ndarray) -> np.ndarray:
        """For each difference and each start, whether all chains keep to their budgets."""
        spec = self.spec
        counts = np.bitwise_count(x[:, None] & self.ring[None]).astype(np.int64)
        budgets = np.array([spec.budget(i) for i in range(1, spec.segments + 1)])
        turned = [np.roll(counts, -start, axis=1).cumsum(axis=1) <= budgets for start in range(spec.segments)]
        return np.stack([t.all(axis=1) for t in turned], axis=1)

    def spanning(self, key: int, prints: np.ndarray) -> list[tuple[int, int]]:
        """Links that hold the components of the members together: fewer than members."""
        a, b = np.triu_indices(len(prints), 1)
        near = self.linked(np.full(len(a), key), prints[a] ^ prints[b])
        table = np.zeros((len(prints), len(prints)), bool)
        table[a[near], b[near]] = table[b[near], a[near]] = True
        return spanning(table)


def _links(cells: DataFrame, spec: SimHashSpec, keys: list[tuple[int, int]]) -> DataFrame:
    """Rows (a, b) of ids from rows (key, prints, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = Cell(spec, keys)
        for batch in batches:
            key = batch.column("key").to_numpy()
            lists = batch.column("prints")
            first = lists.offsets.to_numpy()
            prints = lists.values.to_numpy().view(np.uint64)
            ids = batch.column("ids").values.to_numpy()[batch.column("ids").offsets[0].as_py() :]
            first, prints = first - first[0], prints[first[0] :]
            size = np.diff(first)
            two = np.nonzero(size == 2)[0]  # nearly all cells: taken together
            at = first[two]
            at = at[cell.linked(key[two], prints[at] ^ prints[at + 1])]
            a, b = [ids[at]], [ids[at + 1]]
            for row in np.nonzero(size > 2)[0].tolist():
                found = cell.spanning(key[row], prints[first[row] : first[row + 1]])
                if found:
                    pairs = np.array(found) + first[row]
                    a.append(ids[pairs[:, 0]])
                    b.append(ids[pairs[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return cells.mapInArrow(run, "a long, b long")


def links(classes: DataFrame, spec: SimHashSpec) -> DataFrame:
    """Links (a, b) that join the components of ``classes`` (print, id), distinct prints."""
    keys = key_masks(spec, chain_length(spec, classes.count()))
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for _, m in keys]
    each = F.array(*[F.struct(F.lit(i).alias("key"), F.col("print").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(signed)])
    rows = classes.select("print", "id", F.explode(each).alias("k")).select("k.*", "print", "id")
    sizes = join_side(rows, ["key", "part"], F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / spec.block).cast("int")
    block = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("x"), F.greatest("block", j).alias("y")))
    dealt = rows.join(sizes, ["key", "part"]).withColumn("blocks", blocks).withColumn("block", block)
    dealt = dealt.select("key", "part", "print", "id", F.explode(cells).alias("cell"))
    met = dealt.groupBy("key", "part", "cell").agg(F.collect_list(F.struct("print", "id")).alias("rows"))
    met = met.select("key", F.col("rows.print").alias("prints"), F.col("rows.id").alias("ids")).filter("size(ids) > 1")
    return _links(met, spec, keys)


def near_duplicates(docs: DataFrame, spec: SimHashSpec = SimHashSpec()) -> DataFrame:
    """Columns doc_id, fingerprint (16 hexadecimal digits), component_id: one row per input row."""
    assert math.comb(spec.parts, spec.parts // 2) < 100, "too many keys"

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        prints = [np.uint64(fingerprint(text, spec)).astype(np.int64) for text in batch.text]
        return pd.DataFrame({"print": pd.Series(prints, dtype=object)})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = settle(append(texts, ["text"], run, T.StructType().add("print", "long")).drop("text"))
    nodes = table.filter("doc_id is not null")
    classes = settle(join_side(nodes, ["print"], F.min("doc_id").alias("id")))

    # rows of one doc_id with different fingerprints join their classes
    several = nodes.groupBy("doc_id").agg(F.min("print").alias("x"), F.max("print").alias("y")).filter("x <> y")
    again = nodes.join(several.select("doc_id"), "doc_id").join(classes, "print").filter("doc_id <> id")
    edges = links(classes, spec).unionAll(again.select(F.col("doc_id").alias("a"), F.col("id").alias("b")))

    stars = components(edges)
    named = classes.join(stars.select(F.col("u").alias("id"), "m"), "id", "left")
    named = named.select("print", F.coalesce("m", "id").alias("m"))
    return table.join(named, "print", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("m")).alias("component_id"),
    )
