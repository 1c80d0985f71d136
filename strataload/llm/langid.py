"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector of hashed character 1- to 3-grams; each
language has several centroids, the spherical k-means clusters of its own sample.  The
nearest centroid by cosine names the language.  A text is rejected if it is farther from
it than texts of its language and length are, or no nearer than foreign texts of its
length: those of the sample, compared with the other languages only.  Every length has
such a floor, since pieces of sample texts stand in for lengths that are rare.

Fitting uses at most ``per_language`` labelled texts of each language (chosen by a hash
of doc_id); weights and clusters are computed in tasks, and the driver holds one weight
vector and the centroids.

Defined cases: a NULL text or one without a letter is ``und`` with score 0 and is
rejected; texts of fewer than ``least_letters`` letters are never rejected otherwise; if
nothing was learned every text is ``und``; equal distances go to the language that sorts
first; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.llm.common import append, fold_of, keep_where, sample_ids, settle

UNKNOWN = "und"
_CLASSES = 18  # of length: powers of two, the last one is open


@dataclass(frozen=True)
class LanguageSpec:
    per_language: int = 400
    clusters: int = 3
    bits: int = 13
    sharpness: float = 25.0  # of the score, a softmax of cosines
    least_letters: int = 20
    deviations: float = 5.0  # below the mean cosine of its language and length a text is rejected
    foreign_deviations: float = 4.0  # above the median cosine of foreign texts of its length it is kept
    pieces: int = 20  # of each language and length class, for the floors


@dataclass
class LanguageModel:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray  # one row per centroid
    owner: np.ndarray  # index of its language
    floor: np.ndarray = field(default_factory=lambda: np.zeros((0, _CLASSES)))  # least cosine by language and length class


_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, bool)
        for point in range(0x20000):  # every script of the two planes in use
            table[point] = chr(point).isalpha()
        table[0x20000:0x323B0] = True  # ideographs
        _letters = table
    return _letters


def gram_counts(text: str | None, bits: int) -> tuple[np.ndarray, int]:
    """Counts of hashed 1- to 3-grams and the number of letters.

    Letters are lower-cased; any run of other characters is one blank, so grams see
    where words begin and end.  Blanks alone are not counted.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate([[0], points, [0]]).astype(np.uint32)
    letter = _letter_table()[points]
    points[~letter] = 0
    keep = letter | np.r_[True, letter[:-1]]
    chars, letter = points[keep], letter[keep]
    total = int(letter.sum())
    size = 1 << bits
    out = np.zeros(size, np.int64)
    if not total:
        return out, 0
    hashed = chars * np.uint32(0x85EBCA6B)
    hashed ^= hashed >> np.uint32(15)
    mixed = hashed
    for n in (1, 2, 3):
        if n > 1:
            if len(chars) < n:
                break
            mixed = mixed[:-1] * np.uint32(0x9E3779B1) + hashed[n - 1 :]
        ids = (mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)
        out += np.bincount(ids[letter] if n == 1 else ids, minlength=size)
    return out, total


def vectors(texts, bits: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vectors, and the letters of each text."""
    out = np.zeros((len(texts), 1 << bits), np.float32)
    letters = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        counts, letters[i] = gram_counts(text, bits)
        out[i] = np.log1p(counts)
    out *= idf
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1), letters


def cluster(points: np.ndarray, count: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; the same result on every run."""
    seeds = [points.mean(axis=0)]
    for _ in range(min(count, len(points)) - 1):
        nearest = np.max(points @ np.stack(seeds).T, axis=1)
        seeds.append(points[int(np.argmin(nearest))])
    centers = np.stack(seeds)
    for _ in range(rounds):
        centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
        own = np.argmax(points @ centers.T, axis=1)
        sizes = np.bincount(own, minlength=len(centers))
        # a cluster of a few texts is an accident of the sample, not a variety of the language
        live = np.flatnonzero(sizes >= max(1, len(points) // 20))
        centers = np.stack([points[own == k].mean(axis=0) for k in live])
    return centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)


def _length_class(letters: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(letters, 1)).astype(np.int64), _CLASSES - 1)


def pieces_of(texts: list[str], count: int) -> list[str]:
    """``count`` pieces of each length class, cut from all texts in a row; the longest go round."""
    line = " ".join(texts)
    share = sum(map(str.isalpha, line)) / max(1, len(line))
    if not share:
        return []
    out = []
    for size in range(_CLASSES):
        width = int(1.4 * 2**size / share) + 1
        ring = line + " " + line[:width] if width <= len(line) else (line + " ") * (width // len(line) + 2)
        out += [ring[at : at + width] for at in (len(line) * i // count for i in range(count))]
    return out


def floors(languages: list[str], seen: pd.DataFrame, spec: LanguageSpec) -> np.ndarray:
    """Least cosine by language and length class, from ``seen`` (lang, size, own, foreign).

    A class is looked at together with the next shorter and longer one.
    """
    out = np.full((len(languages), _CLASSES), -1.0)
    for size in range(_CLASSES):
        near = seen[(seen["size"] - size).abs() <= 1]
        # the median and the median deviation: a few texts of a sample bear the wrong label
        foreign = near.foreign[near.foreign > -1]
        middle = foreign.median()
        wide = max(1.4826 * (foreign - middle).abs().median(), 0.01) if len(foreign) else 0.0
        for k, language in enumerate(languages):
            here = seen[(seen.lang == language) & (seen["size"] == size)].own
            own = near.own[near.lang == language]
            if not len(own):
                continue
            mean = here.mean() if len(here) else own.mean()
            sd = max(own.std(ddof=0), 0.02)
            out[k, size] = mean - spec.deviations * sd
            if len(foreign):
                # where the two overlap, the point that is equally many deviations away from both
                between = (mean * wide + middle * sd) / (wide + sd)
                out[k, size] = max(out[k, size], min(middle + spec.foreign_deviations * wide, between))
    return out


def classify(model: LanguageModel, texts, spec: LanguageSpec) -> pd.DataFrame:
    """Columns lang_pred, score, cosine, rejected, letters."""
    points, letters = vectors(texts, spec.bits, model.idf)
    count = len(model.languages)
    cosine = np.full((len(texts), max(count, 1)), -1.0)
    if count:
        near = points @ model.centroids.T
        for k in range(count):
            cosine[:, k] = near[:, model.owner == k].max(axis=1)
    best = cosine.argmax(axis=1)
    top = cosine[np.arange(len(best)), best]
    weight = np.exp(spec.sharpness * (cosine - top[:, None]))
    known = (letters > 0) & (count > 0)
    least = model.floor[best, _length_class(letters)] if len(model.floor) else np.full(len(best), -1.0)
    return pd.DataFrame(
        {
            "lang_pred": np.where(known, np.array(model.languages or [UNKNOWN], object)[best], UNKNOWN),
            "score": np.where(known, 1.0 / weight.sum(axis=1), 0.0),
            "cosine": np.where(known, top, 0.0),
            "rejected": ~known | ((letters >= spec.least_letters) & (top < least)),
            "letters": letters,
        }
    )


def fit(docs: DataFrame, spec: LanguageSpec = LanguageSpec()) -> LanguageModel:
    """Learn from the rows of ``docs`` with text and lang."""
    named = docs.filter("lang is not null and text is not null and doc_id is not null")
    wanted = sample_ids(named.select("doc_id", "lang"), ["lang"], spec.per_language, "language")
    # written first: Spark knows the size of the ids and need not move texts to meet a few of them
    wanted = settle(wanted.distinct())
    sample = settle(named.select("doc_id", "lang", "text").join(wanted, ["doc_id", "lang"], "left_semi"))
    bits, clusters = spec.bits, spec.clusters

    def presence(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.text:
                counts, letters = gram_counts(text, bits)
                total += counts > 0
                rows += letters > 0
        found = np.flatnonzero(total)
        yield pd.DataFrame({"gram": np.r_[-1, found], "texts": np.r_[rows, total[found]]})

    df = {
        r["gram"]: r["texts"]
        for r in sample.mapInPandas(presence, "gram long, texts long").groupBy("gram").agg(F.sum("texts").alias("texts")).collect()
    }
    rows = df.pop(-1, 0)
    idf = np.full(1 << bits, np.log(1.0 + rows), np.float32)
    if df:
        idf[list(df)] = np.log((1.0 + rows) / (1.0 + np.array(list(df.values()))))
    idf += 1

    def clusters_of(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text"])
        points, letters = vectors(group.text.tolist(), bits, idf)
        points = points[letters > 0]
        centers = cluster(points, clusters) if len(points) else np.zeros((0, 1 << bits), np.float32)
        return pd.DataFrame(
            {"lang": group.lang.iloc[0], "center": [c.astype(np.float32).tobytes() for c in centers]},
            columns=["lang", "center"],
            dtype=object,
        )

    found = sorted(
        (r["lang"], bytes(r["center"]))
        for r in sample.groupBy("lang").applyInPandas(clusters_of, "lang string, center binary").collect()
    )
    languages = sorted({lang for lang, _ in found})
    centroids = np.array([np.frombuffer(c, np.float32) for _, c in found], np.float32).reshape(-1, 1 << bits)
    owner = np.array([languages.index(lang) for lang, _ in found], np.int64)
    model = LanguageModel(idf, languages, centroids, owner)

    def distances(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text"])
        name, texts = group.lang.iloc[0], group.text.tolist()
        own = model.owner == (languages.index(name) if name in languages else -1)
        out = []
        texts += pieces_of(texts, spec.pieces)
        for start in range(0, len(texts), 256):
            points, letters = vectors(texts[start : start + 256], bits, model.idf)
            near = points @ model.centroids.T
            out.append(
                pd.DataFrame(
                    {
                        "lang": name,
                        "size": _length_class(letters),
                        "own": near[:, own].max(axis=1, initial=-1.0).astype(float),
                        "foreign": near[:, ~own].max(axis=1, initial=-1.0).astype(float),
                    }
                )[letters > 0]
            )
        return pd.concat(out)

    if languages:  # a row for each text of the sample and each piece
        seen = sample.groupBy("lang").applyInPandas(distances, "lang string, size long, own double, foreign double")
        rows = sorted(tuple(r) for r in seen.collect())
        model.floor = floors(languages, pd.DataFrame(rows, columns=["lang", "size", "own", "foreign"]), spec)
    return model


def identify(docs: DataFrame, model: LanguageModel, spec: LanguageSpec = LanguageSpec()) -> DataFrame:
    """``docs`` with lang_pred, score, cosine and rejected, in place of columns of those names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x clusters vectors
    added = (
        T.StructType()
        .add("lang_pred", "string")
        .add("score", "double")
        .add("cosine", "double")
        .add("rejected", "boolean")
    )
    return append(docs, ["text"], lambda rows: classify(sent.value, rows.text.tolist(), spec), added)


def learning_rows(docs: DataFrame) -> DataFrame:
    """The rows a model may learn from: those outside the held-out fold."""
    return docs.filter(fold_of(F.col("doc_id"), 3) != 1)


def known_language(docs: DataFrame, spec: LanguageSpec = LanguageSpec()) -> DataFrame:
    """Stage: the rows of ``docs`` that are not rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(learning_rows(docs), spec))
    return keep_where(docs, ["text"], lambda rows: ~classify(sent.value, rows.text.tolist(), spec).rejected)
