"""Toxicity of texts behind leetspeak, spacing and repetition.

Disguised words go through a noisy channel: what is seen is a lattice of the letters it
may stand for (``1`` for i or l, ``$`` for s or nothing, a run of letters for one or
two, a Cyrillic look-alike for a Latin letter, letters apart for one word or several),
and the best path under a character trigram model, found by Viterbi search, is the
restored word.  The model counts the letters of all scripts in all documents, in tables of
a fixed size by hash, and backs off from trigrams to pairs to letters.

Restored texts are scored by logistic regression on the number of their distinct words
that hold a character n-gram, up to ``most_hits``.  N-grams and weights are learned from at most ``toxic_rows``
and ``clean_rows`` labelled documents, chosen by a hash of doc_id.

Defined cases: a NULL, empty or wordless text has no n-grams and the score of that; a
doc_id with several labels is learned from with each, NULL labels are not; without
toxic labels every score is 0; repeated rows are scored alike; an empty table gives an
empty result; extra columns pass through :func:`score`.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.common import append, sample_ids, settle


@dataclass(frozen=True)
class ToxicSpec:
    toxic_rows: int = 2_000
    clean_rows: int = 8_000
    sizes: tuple[int, ...] = (3, 4, 5, 6)  # of n-grams; a word has a blank on both sides
    least_share: float = 0.01  # of toxic documents that hold an n-gram
    least_odds: float = 1.5  # log odds ratio of an n-gram
    most_grams: int = 600
    most_hits: int = 4  # distinct words of a document that count for an n-gram
    pull: float = 0.02  # L2 regularisation


# Signs and the letters they stand for in disguised words.
LEET = {
    "0": "ou", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "*": "aeiou", "€": "e", "(": "c", "<": "c",
}
_LOG_NOTHING = -2.0  # a sign that stands for no letter
_LOG_SIGN = -1.0  # a sign that stands for one of its letters
_LOG_REPEAT = -0.7  # a long run of a letter that stands for two of it
_LOG_DOUBLED = -6.0  # a letter typed twice that stands for one
_LOG_LOOK = -0.5  # a look-alike that stands for the Latin letter
_LOG_BREAK = -1.0  # letters apart: a new word starts
_LOG_STUCK = -6.0  # the same in front of a letter, where it is no punctuation
_OUTER = ".,;:?\"')[]{}«»„“”‚‘’…"  # punctuation that stands for no letter
_OPENING, _CLOSING = "(|<*+@", "!|(*+"  # signs that are as well punctuation before or after a word

# Cyrillic and Greek letters and the Latin ones that they look like.
LOOK = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "һ": "h",
    "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "ο": "o", "α": "a", "ν": "v", "ρ": "p", "τ": "t", "κ": "k", "ι": "i",
}

_RUN = re.compile(r"(\w)\1\1")
_TWICE = re.compile(r"([^\W\d_])\1")
_LATIN = re.compile("[a-z]")
_SPACED = re.compile(r"(?<![^\s\"'\[{«„“‚‘])(?:[\w@$!|+€(<][ .\-_*]{1,2}){2,}[\w@$!|+€(<](?=[^\w\s]*(?:\s|\Z))")
_NUMBER = re.compile(r"\A(?=.*\d)[\d\W_]+\Z", re.S)
_PARTS = re.compile(r"(.)\1*", re.S)


def folded(text: str) -> str:
    """Lower case; full-width and other compatibility forms as plain letters."""
    text = text.lower()
    return text if text.isascii() or unicodedata.is_normalized("NFKC", text) else unicodedata.normalize("NFKC", text).lower()


# Slots of the hashed counts: trigrams, their first two letters, their last two, their middle, their last.
_SLOTS = (1 << 21, 1 << 18, 1 << 18, 1 << 16, 1 << 16)
_FIRST = tuple(sum(_SLOTS[:i]) for i in range(5))
_ALL = sum(_SLOTS)
_KEEP = (1 << 64) - 1


def _slot(key, table: int):
    """The place of a key, a number or an array of them, among all slots."""
    if isinstance(key, np.ndarray):
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(40)).astype(np.int64) % _SLOTS[table] + _FIRST[table]
    mixed = key * 0x9E3779B97F4A7C15 & _KEEP
    mixed = (mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 & _KEEP
    return (mixed >> 40) % _SLOTS[table] + _FIRST[table]


def _slots(a, b, c) -> list:
    """The slots of the trigram of code points a, b, c; 0 is the word boundary."""
    return [_slot((a << 42) + (b << 21) + c, 0), _slot((a << 21) + b, 1), _slot((b << 21) + c, 2), _slot(b, 3), _slot(c, 4)]


class CharModel:
    """Interpolated character trigrams of all letters; code point 0 is the word boundary."""

    def __init__(self, alphabet: str, counts: np.ndarray):
        """``counts`` of the trigrams of an alphabet, place 0 the boundary."""
        points = np.array([0, *map(ord, alphabet)], np.int64)
        codes, size = np.flatnonzero(counts), len(points)
        triple = points[codes // size**2], points[codes // size % size], points[codes % size]
        total = np.zeros(_ALL)
        for slots in _slots(*triple):
            np.add.at(total, slots, counts[codes])
        self._take(total)

    @classmethod
    def of(cls, total: np.ndarray) -> CharModel:
        """From the counts by slot."""
        made = cls.__new__(cls)
        made._take(total)
        return made

    def _take(self, total: np.ndarray) -> None:
        self.total = total.astype(np.float32)
        ends = total[_FIRST[4] :]
        self.letters, self.known = int(np.count_nonzero(ends)) + 1, {}
        self.sum = float(ends.sum())

    def log(self, a: int, b: int, c: int) -> float:
        """The log probability of c behind a and b."""
        found = self.known.get((a, b, c))
        if found is None:
            three, first, last, middle, one = (float(self.total[i]) for i in _slots(a, b, c))
            p = (one + 1) / (self.sum + self.letters)
            p = (last + 5 * p) / (middle + 5)
            p = (three + 5 * p) / (first + 5)
            if len(self.known) > 1_000_000:
                self.known.clear()
            found = self.known[a, b, c] = math.log(p)
        return found

    def score(self, word: str) -> float:
        """The log probability of a word."""
        points = [0, 0, *map(ord, word), 0]
        return sum(map(self.log, points, points[1:], points[2:]))

    def choices(self, sign: str, run: int, first: bool, last: bool, spaced: bool, every: bool, long: bool, next_: str) -> list:
        """(log probability, letters) of what a run of a sign may stand for."""
        if sign in LEET:
            out = [(_LOG_SIGN, c) for c in LEET[sign]] if run != 2 or not every else []
            if run == 2:
                out += [(_LOG_SIGN, c + c) for c in LEET[sign]]
            if not spaced and (first and sign in _OPENING or last and sign in _CLOSING):
                return [(0.0, ""), *(out if not (first and last) else [])]
            if not every:
                stuck = first and sign in "!$" and next_.isalpha()
                out.append((_LOG_STUCK if stuck else _LOG_NOTHING * min(run, 3), ""))
            return out
        if not sign.isalpha():
            return [(0.0, "")]
        letters = [(0.0, sign)] + ([(_LOG_LOOK, LOOK[sign])] if sign in LOOK else [])
        if run == 1:
            return letters
        once, twice = (0.0, _LOG_REPEAT) if run > 2 else (_LOG_REPEAT if long else _LOG_DOUBLED, 0.0)
        return [(cost + once, c) for cost, c in letters] + [(cost + twice, c + c) for cost, c in letters]

    def decode(self, seen: str, spaced: bool = False) -> str:
        """The most probable word behind a lower-cased disguised one.

        In a spaced word and in one without a letter every sign stands for a letter, except
        punctuation at the ends of the latter.
        """
        every = spaced or not any(c.isalpha() for c in seen)
        long = _RUN.search(seen) is not None
        best = {(0, 0): (0.0, "")}  # last two letters -> (log probability, word)
        for part in _PARTS.finditer(seen):
            first, last = part.start() == 0, part.end() == len(seen)
            choices = self.choices(part.group(1), len(part.group()), first, last, spaced, every, long, seen[part.end() : part.end() + 1])
            if spaced and not first:
                choices += [(cost + _LOG_BREAK, " " + letters) for cost, letters in choices if letters]
            after: dict = {}
            for (a, b), (value, word) in best.items():
                for cost, letters in choices:
                    x, y, total = a, b, value + cost
                    for c in letters:
                        z = 0 if c == " " else ord(c)
                        total += self.log(x, y, z)
                        x, y = (0, 0) if z == 0 else (y, z)
                    if (x, y) not in after or total > after[x, y][0]:
                        after[x, y] = (total, word + letters)
            best = after
        ended = ((value + self.log(a, b, 0), word) for (a, b), (value, word) in best.items())
        return max(ended)[1]


class Restorer:
    """Distinct restored words of texts; decoded words are remembered up to a bound."""

    def __init__(self, model: CharModel, most: int = 200_000):
        self.model, self.most, self.known, self.plain = model, most, {}, {}

    def word(self, seen: str, spaced: bool = False) -> str:
        key = (seen, spaced)
        if key not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[key] = self.model.decode(seen, spaced)
        return self.known[key]

    def typed_twice(self, word: str) -> bool:
        """Whether a word with a doubled letter is far less probable than with one of it."""
        if not _TWICE.search(word):
            return False
        once = _TWICE.sub(r"\1", word)
        return self.model.score(once) + _LOG_DOUBLED > self.model.score(word)

    def pairs(self, text: str | None) -> dict[str, str]:
        """Every distinct word of a text, without outer punctuation, and what it is restored to."""
        if not text:
            return {}
        text = folded(text)
        words = text.split()
        look = not text.isascii() and not LOOK.keys().isdisjoint(text)
        out: dict[str, str] = {}
        for raw in set(words):
            word = raw.strip(_OUTER)
            known = self.plain.get(word)
            if known is not None:
                out[word] = known
            elif word.isalpha():
                mixed = look and _LATIN.search(word) and not LOOK.keys().isdisjoint(word)
                if len(self.plain) >= self.most:
                    self.plain.clear()
                out[word] = self.plain[word] = self.word(word) if mixed or self.typed_twice(word) else word
            elif any(c.isalpha() or c in LEET for c in word):
                out[word] = self.word(word)
        for found in [w for w in out if _RUN.search(w)] if _RUN.search(text) else ():
            out[found] = self.word(found)
        for found in _SPACED.finditer(text):
            out[found.group()] = self.word(re.sub(r"[ .\-_*]", "", found.group()), spaced=True)
        return out

    def text(self, text: str | None) -> str | None:
        """The text, lower-cased, with disguised words restored; numbers stay as they are."""
        changed = {seen: word for seen, word in self.pairs(text).items() if word not in (seen, "") and not _NUMBER.search(seen)}
        if not changed:
            return folded(text) if text else text
        pattern = "|".join(re.escape(seen) for seen in sorted(changed, key=len, reverse=True))
        return re.sub(rf"(?<!\w)(?:{pattern})(?!\w)", lambda m: changed[m.group()], folded(text))

    def line(self, text: str | None) -> str:
        """Distinct restored words between blanks, in order."""
        return f" {'  '.join(sorted(set(self.pairs(text).values()) - {''}))} "


_AT_ONCE = 1 << 21  # letters that are counted at a time


def char_model(docs: DataFrame) -> CharModel:
    """Trigram counts of all letters of all ``docs``.

    Every task sends the sums of its own rows by slot, so the driver gets one table of a
    fixed size whatever scripts and rare letters the documents have.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letter = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
        total, waiting, size = np.zeros(_ALL, np.int64), [], 0

        def count() -> None:
            points = np.frombuffer(f"  {'  '.join(waiting)}  ".encode("utf-32-le", "surrogatepass"), np.uint32)
            waiting.clear()
            # the letters of these texts get small numbers, so only distinct trigrams are hashed
            own = np.flatnonzero(np.bincount(points, minlength=0x110000)[:0x110000] * letter)
            number = np.zeros(0x110000, np.int64)
            number[own] = np.arange(1, len(own) + 1)
            own, place, wide = np.r_[0, own], number[points], len(own) + 1
            # a word starts from two boundaries: the letter before the boundary does not count
            before = np.where(place[1:-1] == 0, 0, place[:-2])
            codes = (before * wide + place[1:-1]) * wide + place[2:]
            if wide <= 128:
                counts = np.bincount(codes, minlength=wide**3)
                codes = np.flatnonzero(counts)
                counts = counts[codes]
            else:
                codes, counts = np.unique(codes, return_counts=True)
            codes, counts = codes[codes >= 1], counts[codes >= 1]  # without three boundaries
            for slots in _slots(own[codes // wide**2], own[codes // wide % wide], own[codes % wide]):
                np.add.at(total, slots, counts)

        for batch in batches:
            for text in batch.text:
                if text:
                    waiting.append(folded(text))
                    size += len(text)
                if size >= _AT_ONCE:
                    count()
                    size = 0
        count()
        found = np.flatnonzero(total)
        yield pd.DataFrame({"slot": found, "n": total[found]})

    rows = docs.select("text").mapInPandas(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(_ALL)
    total[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return CharModel.of(total)


@dataclass
class ToxicModel:
    chars: CharModel
    grams: list[str]
    weights: np.ndarray
    base: float
    most_hits: int = 4


def _matcher(grams: list[str]):
    found = ahocorasick.Automaton()
    for i, gram in enumerate(grams):
        found.add_word(gram, i)
    if grams:
        found.make_automaton()
    return found


def _hits(matcher, line: str, most: int) -> list[int]:
    """N-grams of a line, each as often as it occurs but at most ``most`` times."""
    counts = Counter(i for _, i in matcher.iter(line)) if len(matcher) else {}
    return sorted(i for i, n in counts.items() for _ in range(min(n, most)))


def _grams_of(line: str, sizes: tuple[int, ...]) -> set[str]:
    out = set()
    for word in line.split("  "):
        word = f" {word.strip()} "
        for n in sizes:
            out.update(word[i : i + n] for i in range(len(word) - n + 1))
    return out


def _regression(hits: list[list[int]], y: np.ndarray, size: int, pull: float) -> tuple[np.ndarray, float]:
    """Logistic regression with weights >= 0: an n-gram can only speak for toxicity.

    Accelerated projected gradient steps; the last column of ``x`` is the constant, which
    may have either sign and is not pulled towards 0.
    """
    x = np.zeros((len(y), size + 1), np.float32)
    for i, found in enumerate(hits):
        np.add.at(x[i], found, 1)
    x[:, size] = 1
    v = np.ones(size + 1, np.float32)
    for _ in range(30):  # largest eigenvalue, which bounds the curvature
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v)
    step = 1.0 / (0.25 * 1.05 * float(np.linalg.norm(x @ v)) ** 2 + pull)
    pulls = np.r_[np.full(size, pull), 0.0]
    weights = np.zeros(size + 1)
    weights[size] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    ahead, t = weights.copy(), 1.0
    for _ in range(1500):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead.astype(np.float32), -30, 30)))
        new = ahead - step * (x.T @ (p - y).astype(np.float32) + pulls * ahead)
        new[:size] = np.maximum(0, new[:size])
        faster = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, weights, t = new + (t - 1) / faster * (new - weights), new, faster
    return weights[:size], float(weights[size])


def fit(docs: DataFrame, labels: DataFrame, spec: ToxicSpec = ToxicSpec()) -> ToxicModel:
    """Learn from ``labels`` (doc_id, label 0/1) of ``docs`` (doc_id, text)."""
    named = labels.filter("label is not null and doc_id is not null").select("doc_id", F.col("label").cast("int").alias("label"))
    toxic = sample_ids(named.filter("label = 1"), ["label"], spec.toxic_rows, "toxic")
    clean = sample_ids(named.filter("label = 0"), ["label"], spec.clean_rows, "toxic")
    chosen = settle(toxic.unionAll(clean))
    sample = settle(docs.select("doc_id", "text").join(chosen, "doc_id"))
    chars = char_model(docs)
    sizes, most = spec.sizes, spec.most_hits

    def lines(batch: pd.DataFrame) -> pd.DataFrame:
        restore = Restorer(chars)
        return pd.DataFrame({"line": [restore.line(t) for t in batch.text]})

    read = settle(append(sample, ["text"], lines, T.StructType().add("line", "string")).select("doc_id", "label", "line"))
    totals = {r["label"]: r["n"] for r in read.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic:
        return ToxicModel(chars, [], np.zeros(0), -30.0)

    def toxic_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for line in batch.line:
                yield pd.DataFrame({"gram": sorted(_grams_of(line, sizes))}, dtype=object)

    least = max(2, int(np.ceil(spec.least_share * n_toxic)))
    held = read.filter("label = 1").select("line").mapInPandas(toxic_grams, "gram string")
    held = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    # a document holds few n-grams that a hundredth of all do, so this is bounded
    candidates = {r["gram"]: r["n"] for r in held.collect()}
    names = sorted(candidates)

    def clean_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher, total = _matcher(names), np.zeros(len(names), np.int64)
        for batch in batches:
            for line in batch.line:
                total[_hits(matcher, line, most)] += 1
        found = np.flatnonzero(total)
        yield pd.DataFrame({"gram": found, "n": total[found]})

    in_clean = np.zeros(len(names), np.int64)
    counted = read.filter("label = 0").select("line").mapInPandas(clean_counts, "gram long, n long")
    for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        in_clean[r["gram"]] = r["n"]
    in_toxic = np.array([candidates[g] for g in names], float)
    p, q = (in_toxic + 0.5) / (n_toxic + 1), (in_clean + 0.5) / (n_clean + 1)
    odds = np.log(p / (1 - p)) - np.log(q / (1 - q))
    value = np.where(odds >= spec.least_odds, odds * np.sqrt(in_toxic), 0)
    best = sorted(np.flatnonzero(value), key=lambda i: (-value[i], names[i]))[: spec.most_grams]
    grams = [names[i] for i in best]

    def found_grams(batch: pd.DataFrame) -> pd.DataFrame:
        matcher = _matcher(grams)
        return pd.DataFrame({"hits": [_hits(matcher, line, most) for line in batch.line]})

    seen = append(read, ["line"], found_grams, T.StructType().add("hits", T.ArrayType(T.IntegerType())))
    rows = sorted(seen.select("label", "hits").collect())  # bounded by the sample
    y = np.array([r["label"] for r in rows], float)
    weights, base = _regression([r["hits"] for r in rows], y, len(grams), spec.pull)
    return ToxicModel(chars, grams, weights, base, most)


def score(docs: DataFrame, model: ToxicModel, least: float = 0.7) -> DataFrame:
    """``docs`` with score, predicted (1 if score >= ``least``) and restored (disguised words
    that were restored), in place of columns of those names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of the sizes in the spec
    tools: list = []  # of one task

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        model = sent.value
        if not tools:
            tools.extend((_matcher(model.grams), Restorer(model.chars)))
        matcher, restore = tools
        scores, changed = [], []
        for text in batch.text:
            pairs = restore.pairs(text)
            line = f" {'  '.join(sorted(set(pairs.values()) - {''}))} "
            total = model.base + float(model.weights[_hits(matcher, line, model.most_hits)].sum())
            scores.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
            changed.append(sorted(f"{a}={b}" for a, b in pairs.items() if a != b and b))
        found = np.array(scores, float)
        return pd.DataFrame({"score": found, "predicted": (found >= least).astype("int32"), "restored": changed})

    added = T.StructType().add("score", "double").add("predicted", "integer").add("restored", T.ArrayType(T.StringType()))
    return append(docs, ["text"], run, added)
