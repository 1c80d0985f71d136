"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins at quantiles of the sample; the model is a table of
additions per feature, and a table per chosen pair of features.  The tables are learned
by cyclic boosting: round after round each feature in turn gets a tree of a few leaves
fitted to the current residuals, with a small step, and its leaves are added to its
table.  Pairs are chosen by how much a small tree over both explains of what the
single tables leave.  Scoring looks up one number per table and adds.

Features are computed from the whole text in tasks.  Fitting uses at most
``sample_rows`` labelled rows, chosen by a hash of doc_id, so the driver holds a bounded
matrix.

Defined cases: a NULL, empty or wordless text has features 0 and a score like any other
(``empty`` is a feature); labels that are NULL and labels of unknown documents are not
learned from; a doc_id with several labels is learned from with each; without labels of
both kinds the score is 0 or 1, and without any 0.5; repeated rows are scored alike; an
empty table gives an empty result; extra columns pass through :func:`score`.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.common import append, sample_ids, settle


@dataclass(frozen=True)
class GamSpec:
    sample_rows: int = 20_000
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 8
    rounds: int = 200
    pair_rounds: int = 60
    step: float = 0.1
    leaves: int = 4
    smoothing: float = 4.0  # rows' worth of pull of a leaf towards 0


FEATURES = (
    "empty",
    "log_words",
    "mean_word_chars",
    "long_word_share",
    "distinct_word_share",
    "repeat_share",
    "top_word_share",
    "neighbour_repeat_share",
    "letter_share",
    "upper_share",
    "upper_word_share",
    "digit_share",
    "symbol_share",
    "pipe_share",
    "exclamation_share",
    "stop_share",
    "symbol_word_share",
    "duplicate_line_share",
    "mean_line_words",
    "bare_word_share",
)

_SYMBOLS = re.compile(r"[#*$%&|<>=_^~{}\[\]\\]")
_ODD = re.compile(r"[^\W_][#*$%&|<>!]+(?:\s|$)")
_BARE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")
_UPPER_WORD = re.compile(r"(?<!\w)[A-ZÀ-ÖØ-Þ]{2,}(?!\w)")


def features_of(text: str | None) -> list[float]:
    """One number per feature of a whole text."""
    words = (text or "").split()
    if not words:
        return [1.0] + [0.0] * (len(FEATURES) - 1)
    n, size = len(words), len(text)
    lower = [w.lower() for w in words]
    counts = pd.Index(lower).value_counts(sort=False).to_numpy()
    chars = sum(map(len, words))
    lines = [line for line in text.split("\n") if line.strip()]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    plain = points[points < 128]
    ascii_counts = np.bincount(plain, minlength=128)
    upper = int(ascii_counts[65:91].sum())
    letters = upper + int(ascii_counts[97:123].sum()) + int((points >= 0xAA).sum())
    stops = int(ascii_counts[46] + ascii_counts[63] + ascii_counts[33])
    repeats = sum(a == b for a, b in zip(lower, lower[1:]))
    return [
        0.0,
        float(np.log1p(n)),
        chars / n,
        sum(len(w) > 15 for w in words) / n,
        len(counts) / n,
        float(counts[counts > 1].sum()) / n,
        float(counts.max()) / n,
        repeats / n,
        letters / size,
        upper / size,
        len(_UPPER_WORD.findall(text)) / n,
        int(ascii_counts[48:58].sum()) / size,
        len(_SYMBOLS.findall(text)) / n,
        int(ascii_counts[124]) / n,
        int(ascii_counts[33]) / n,
        stops / n,
        len(_ODD.findall(text)) / n,
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        len(_BARE.findall(text)) / n,
    ]


@dataclass
class GamModel:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)  # upper bounds of the bins of a feature
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # pair bin of each bin of a feature
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Additions of the bins' numbers, through the logistic function."""
        total = np.full(len(x), self.base)
        if self.edges and len(x):
            at = self.binned(x)
            for j, table in enumerate(self.tables):
                total += table[at[:, j]]
            for (i, j), table in zip(self.pairs, self.pair_tables):
                total += table[self.coarse[i][at[:, i]], self.coarse[j][at[:, j]]]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _leaves(gradient: np.ndarray, weight: np.ndarray, spec: GamSpec) -> np.ndarray:
    """Additions per bin of a tree over one ordered feature with a few leaves.

    ``gradient`` and ``weight`` are sums per bin.  The segment whose best cut gains most
    is cut until there are enough leaves.
    """
    g, h = np.r_[0, np.cumsum(gradient)], np.r_[0, np.cumsum(weight)]

    def gain_of(lo: int, hi: int) -> float:
        return (g[hi] - g[lo]) ** 2 / (h[hi] - h[lo] + spec.smoothing)

    def best_cut(lo: int, hi: int):
        if hi - lo < 2:
            return 0.0, None
        cuts = np.arange(lo + 1, hi)
        left = (g[cuts] - g[lo]) ** 2 / (h[cuts] - h[lo] + spec.smoothing)
        right = (g[hi] - g[cuts]) ** 2 / (h[hi] - h[cuts] + spec.smoothing)
        k = int(np.argmax(left + right))
        return float(left[k] + right[k]) - gain_of(lo, hi), int(cuts[k])

    segments = [(0, len(gradient))]
    while len(segments) < spec.leaves:
        gains = [best_cut(lo, hi) for lo, hi in segments]
        k = max(range(len(segments)), key=lambda i: gains[i][0])
        if gains[k][0] <= 1e-9:
            break
        lo, hi = segments[k]
        segments[k : k + 1] = [(lo, gains[k][1]), (gains[k][1], hi)]
    out = np.zeros(len(gradient))
    for lo, hi in segments:
        out[lo:hi] = (g[hi] - g[lo]) / (h[hi] - h[lo] + spec.smoothing)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray, spec: GamSpec) -> tuple[np.ndarray, float]:
    """A tree over two features: one cut on the first, one on the second in each half.

    Returns the additions per cell and the gain of the tree.
    """
    best, found = 0.0, np.zeros_like(gradient)
    total = gradient.sum() ** 2 / (weight.sum() + spec.smoothing)
    for turned in (False, True):
        g, h = (gradient.T, weight.T) if turned else (gradient, weight)
        for cut in range(1, len(g)):
            table, gain = np.zeros_like(g), -total
            for half in (slice(0, cut), slice(cut, len(g))):
                gs, hs = np.cumsum(g[half].sum(axis=0)), np.cumsum(h[half].sum(axis=0))
                left = gs[:-1] ** 2 / (hs[:-1] + spec.smoothing)
                right = (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + spec.smoothing)
                if not len(left):
                    gain += gs[-1] ** 2 / (hs[-1] + spec.smoothing)
                    table[half] = gs[-1] / (hs[-1] + spec.smoothing)
                    continue
                k = int(np.argmax(left + right))
                gain += left[k] + right[k]
                table[half, : k + 1] = gs[k] / (hs[k] + spec.smoothing)
                table[half, k + 1 :] = (gs[-1] - gs[k]) / (hs[-1] - hs[k] + spec.smoothing)
            if gain > best + 1e-12:
                best, found = gain, table.T if turned else table
    return found, best


def boost(x: np.ndarray, y: np.ndarray, spec: GamSpec) -> GamModel:
    """Cyclic boosting with logistic loss; the same model on every run."""
    if not len(y):
        return GamModel(base=0.0)
    share = float(y.mean())
    if not 0 < share < 1:
        return GamModel(base=30.0 if share else -30.0)
    model = GamModel(base=float(np.log(share / (1 - share))))
    for j in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, j], np.linspace(0, 1, spec.bins + 1)[1:-1], method="lower"))
        model.edges.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
        model.coarse.append(np.arange(len(cuts) + 1) * min(spec.pair_bins, len(cuts) + 1) // (len(cuts) + 1))
    at = model.binned(x)
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(spec.rounds):
        for j, table in enumerate(model.tables):
            if len(table) < 2:
                continue
            g, h = slopes()
            add = spec.step * _leaves(
                np.bincount(at[:, j], g, len(table)), np.bincount(at[:, j], h, len(table)), spec
            )
            table += add
            total += add[at[:, j]]

    def cells(i: int, j: int) -> tuple[np.ndarray, tuple[int, int]]:
        shape = int(model.coarse[i][-1]) + 1, int(model.coarse[j][-1]) + 1
        return model.coarse[i][at[:, i]] * shape[1] + model.coarse[j][at[:, j]], shape

    def sums(cell: np.ndarray, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        size = shape[0] * shape[1]
        return np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape)

    gains = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            cell, shape = cells(i, j)
            if min(shape) > 1:
                gains.append((-_quadrants(*sums(cell, shape), spec)[1], i, j))
    chosen = [(i, j, *cells(i, j)) for _, i, j in sorted(gains)[: spec.pairs]]
    model.pairs = [(i, j) for i, j, _, _ in chosen]
    model.pair_tables = [np.zeros(shape) for _, _, _, shape in chosen]
    for _ in range(spec.pair_rounds):
        for table, (_, _, cell, shape) in zip(model.pair_tables, chosen):
            add = spec.step * _quadrants(*sums(cell, shape), spec)[0]
            table += add
            total += add.ravel()[cell]
    return model


def fit(docs: DataFrame, labels: DataFrame, spec: GamSpec = GamSpec()) -> GamModel:
    """Learn from ``labels`` (doc_id, label 0/1) of ``docs`` (doc_id, text)."""
    sample = labels.filter("label is not null and doc_id is not null").select("doc_id", F.col("label").cast("double").alias("label"))
    sample = settle(sample_ids(sample, [], spec.sample_rows, "quality"))
    rows = docs.select("doc_id", "text").join(sample, "doc_id")
    made = append(
        rows,
        ["text"],
        lambda batch: pd.DataFrame({"x": [features_of(t) for t in batch.text]}),
        T.StructType().add("x", T.ArrayType(T.DoubleType())),
    )
    # bounded by the sample; ordered here, as sums of floats depend on the order
    learned = sorted(made.select("doc_id", "label", "x").collect())
    x = np.array([r["x"] for r in learned], float).reshape(-1, len(FEATURES))
    return boost(x, np.array([r["label"] for r in learned], float), spec)


def score(docs: DataFrame, model: GamModel, least: float = 0.3) -> DataFrame:
    """``docs`` with score and predicted (1 if score >= ``least``), in place of columns of those names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        x = np.array([features_of(t) for t in batch.text], float).reshape(-1, len(FEATURES))
        found = sent.value.score(x)
        return pd.DataFrame({"score": found, "predicted": (found >= least).astype("int32")})

    return append(docs, ["text"], run, T.StructType().add("score", "double").add("predicted", "integer"))
