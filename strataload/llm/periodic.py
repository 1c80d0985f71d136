"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q in which words q apart are
identical, at least ``times`` * q and ``least`` words long, that no neighbouring word
extends.  The dictionary gives every factor of 2^k words a name; two factors are equal
when their names are.

1. *Names.*  The names of level k + 1 are the pairs of names of level k that lie 2^k
   apart.  A factor that occurs once in its text cannot be part of an equal longer one, so
   only positions whose factor repeats go up a level, and the dictionary ends where none
   does.
2. *Proposals.*  On a level of factors of L words, every occurrence has a successor, the
   next occurrence of its name.  Occurrences i, i + p, i + 2p with L/2 < p <= L, each
   reaching less than 2L further, are an arithmetic progression and propose the period p.
   A run of at least 4q words with L/2 < q <= L holds, from its first word on, such a
   progression, and within it no factor of L >= q words occurs at a smaller distance,
   because its root is primitive: the successor is exactly q away, and no multiple or
   divisor is proposed.
3. *Extension.*  Longest common extensions to both sides are read from the dictionary by
   falling powers of two, for all proposals of a level at once.
4. Runs found more than once are one.

The texts of an Arrow batch are worked on as one sequence: names are never shared between
texts, so no run crosses from one to the next.  Memory is one integer per word and level.

Defined cases: NULL, empty and wordless texts have no words and no runs; a NULL doc_id
leaves its text as it is; rows are independent, so repeated rows give repeated results; an
empty table gives an empty result; added columns replace clashing ones, others pass.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.common import append


@dataclass(frozen=True)
class RunSpec:
    """Least length of a run in words, and in periods (4 or more)."""

    least: int = 6
    times: int = 4

    def __post_init__(self):
        if self.times < 4:
            raise ValueError("progressions are only sure to show runs of four periods")


class Dictionary:
    """Names of the basic factors of several sequences laid end to end."""

    def __init__(self, names: np.ndarray):
        """``names``: a number per word; equal within a text for equal words, and never
        equal between texts."""
        self.size = len(names)
        self.levels: list[np.ndarray] = []
        self.repeated: list[np.ndarray] = []  # positions whose factor occurs again, by name, then place
        self.same_as_next: list[np.ndarray] = []
        self._add(names.astype(np.int64), np.arange(self.size))
        while len(self.repeated[-1]):
            below, width = self.levels[-1], 1 << (len(self.levels) - 1)
            at = np.sort(self.repeated[-1])
            at = at[at + width < self.size]
            at = at[below[at + width] >= 0]
            self._add(below[at] * (self.size + 1) + below[at + width], at)

    def _add(self, values: np.ndarray, at: np.ndarray) -> None:
        """A level: the values at the positions ``at``; those that occur once get no name."""
        order = np.argsort(values, kind="stable")
        values, at = values[order], at[order]
        as_next = np.zeros(len(values), bool)
        as_next[:-1] = values[1:] == values[:-1]
        again = as_next.copy()
        again[1:] |= as_next[:-1]
        names = np.full(self.size, -1, np.int64)
        number = np.cumsum(np.concatenate([[False], ~as_next[:-1]])) if len(values) else np.empty(0, np.int64)
        names[at[again]] = number[again]
        self.levels.append(names)
        self.repeated.append(at[again])
        self.same_as_next.append(as_next[again])

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on are the same (a < b)."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a + length, b + length
            fits = y < self.size
            fits[fits] &= (self.levels[k][x[fits]] >= 0) & (self.levels[k][x[fits]] == self.levels[k][y[fits]])
            length[fits] += 1 << k
        return length

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b are the same (a < b)."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = a - length - (1 << k), b - length - (1 << k)
            fits = x >= 0
            fits[fits] &= (self.levels[k][x[fits]] >= 0) & (self.levels[k][x[fits]] == self.levels[k][y[fits]])
            length[fits] += 1 << k
        return length

    def proposals(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(position, period) of level ``k``, where the position before proposes another."""
        width = 1 << k
        at, next_ = self.repeated[k], np.nonzero(self.same_as_next[k])[0]
        gap = np.zeros(self.size, np.int64)
        gap[at[next_]] = at[next_ + 1] - at[next_]
        i = np.nonzero((gap > width // 2) & (gap <= width))[0]
        i = i[gap[i + gap[i]] == gap[i]]
        first = np.ones(len(i), bool)
        first[1:] = (np.diff(i) != 1) | (np.diff(gap[i]) != 0)
        return i[first], gap[i[first]]


def runs(names: np.ndarray, spec: RunSpec = RunSpec()) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period."""
    dictionary = Dictionary(names)
    found = [np.empty((0, 3), np.int64)]
    for k in range(len(dictionary.levels)):
        at, period = dictionary.proposals(k)
        before = dictionary.backward(at, at + period)
        length = before + dictionary.forward(at, at + period) + period
        long = length >= np.maximum(spec.least, spec.times * period)
        found.append(np.stack([at - before, length, period], axis=1)[long])
    every = np.unique(np.concatenate(found), axis=0)
    return every[np.lexsort([every[:, 2], every[:, 0]])]


def text_names(texts: list[list]) -> np.ndarray:
    """Numbers for the words of texts laid end to end, not shared between texts."""
    out: list[int] = []
    used = 0
    for words in texts:
        seen = {word: number for number, word in enumerate(dict.fromkeys(words), used)}
        out += map(seen.__getitem__, words)
        used += len(seen)
    return np.array(out, np.int64)


def seeded(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of the contract: for a tenth of all ids a periodic tail, by a hash of the id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


_ADDED = (
    T.StructType()
    .add("n_runs", "long")
    .add("start", "long")
    .add("length", "long")
    .add("period", "long")
    .add("exponent_milli", "long")
    .add("runs_sha256", "string")
    .add("collapsed_sha256", "string")
)


def greatest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    best = None
    for run in found:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    start, length, period = np.array(found).T
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return [words[i] for i in np.nonzero(np.cumsum(depth[:-1]) == 0)[0].tolist()]


def periodic_runs(texts: list[list[bytes]], spec: RunSpec = RunSpec()) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, word numbers counted from its start."""
    offsets = np.cumsum([0, *map(len, texts)])
    found = runs(text_names(texts), spec)
    owner = np.searchsorted(offsets, found[:, 0], "right") - 1
    found[:, 0] -= offsets[owner]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, run in zip(owner.tolist(), map(tuple, found.tolist())):
        out[text].append(run)
    return out


def described(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """The columns that are added for one text."""
    best = greatest(found)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (
        len(found),
        *(best or (None, None, None)),
        best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
    )


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def find_runs(docs: DataFrame, spec: RunSpec = RunSpec(), seed_tails: bool = False) -> DataFrame:
    """``docs`` with what the runs of each text are; ``seed_tails`` applies ``seeded`` first."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        texts = [words_of(text) for text in batch.text]
        if seed_tails:
            texts = [seeded(words, doc_id) for words, doc_id in zip(texts, batch.doc_id)]
        rows = [described(words, found) for words, found in zip(texts, periodic_runs(texts, spec))]
        return pd.DataFrame(rows, columns=_ADDED.names, dtype=object)

    return append(docs, ["doc_id", "text"], run, _ADDED)


def without_repeats(docs: DataFrame, spec: RunSpec = RunSpec()) -> DataFrame:
    """``docs`` with every run of a text cut to its first period, words joined by one space.

    Texts without a run stay as they are.
    """

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        texts = [words_of(text) for text in batch.text]
        cut = []
        for text, words, found in zip(batch.text, texts, periodic_runs(texts, spec)):
            cut.append(b" ".join(collapsed(words, found)).decode("utf-8", "surrogatepass") if found else text)
        return pd.DataFrame({"text": pd.Series(cut, dtype=object)})

    return append(docs, ["text"], run, T.StructType().add("text", "string")).select(*docs.columns)
