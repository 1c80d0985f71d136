"""Joins beyond plain equality, planned as equi-joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.operators.skew import join_side
from strataload.session import durable


def null_safe_on(left: str, right: str, pairs: Mapping[str, str]) -> Column:
    """ON clause in which NULL equals NULL, still an equi-join."""
    tests = [F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}")) for a, b in pairs.items()]
    return reduce(Column.__and__, tests)


def null_safe_lookup(df: DataFrame, lookup: DataFrame, pairs: Mapping[str, str], outputs: Mapping[str, str]) -> DataFrame:
    """Left join in which NULL keys match NULL keys."""
    found = df.alias("d").join(lookup.alias("l"), null_safe_on("d", "l", pairs), "left")
    return found.select("d.*", *[F.col(f"l.{c}").alias(name) for c, name in outputs.items()])


def filtered_lookup(
    df: DataFrame, lookup: DataFrame, on: tuple[str, str], output: str, name: str, where: str | None = None
) -> DataFrame:
    """One column from the filtered rows of a lookup table."""
    ours, theirs = on
    side = lookup if where is None else lookup.filter(where)
    side = side.select(F.col(theirs).alias("_key"), F.col(output).alias(name))
    return df.join(side, df[ours] == side["_key"], "left").drop("_key")


def validity_join(
    facts: DataFrame,
    versions: DataFrame,
    on: Mapping[str, str],
    at: str = "add_date",
    valid: tuple[str, str] = ("add_date", "delete_date"),
    outputs: Mapping[str, str] | None = None,
    how: str = "left",
) -> DataFrame:
    """The version that is valid at the fact's date (closed interval).

    Hash-partitioned on the equality keys with the interval as a residual test
    inside the join; AQE splits a hot key on the fact side.  A history table has at
    most one version of a key per load, so each fact is tested against a number of
    versions that does not grow with the facts.
    """
    tests = [F.col(f"f.{a}") == F.col(f"v.{b}") for a, b in on.items()]
    inside = F.col(f"f.{at}").between(F.col(f"v.{valid[0]}"), F.col(f"v.{valid[1]}"))
    joined = facts.alias("f").join(versions.alias("v"), reduce(Column.__and__, [*tests, inside]), how)
    named = outputs or {c: c for c in versions.columns if c not in on.values() and c not in facts.columns}
    return joined.select("f.*", *[F.col(f"v.{c}").alias(name) for c, name in named.items()])


def active_join(
    facts: DataFrame, versions: DataFrame, on: Mapping[str, str], outputs: Mapping[str, str], how: str = "left"
) -> DataFrame:
    """Join with the current version only; the filter reaches the scan."""
    current = versions.filter(F.col("is_active") == 1).select(
        *[F.col(b).alias(f"_k{i}") for i, b in enumerate(on.values())],
        *[F.col(c).alias(name) for c, name in outputs.items()],
    )
    tests = [F.col(a) == F.col(f"_k{i}") for i, a in enumerate(on)]
    keys = [f"_k{i}" for i in range(len(on))]
    return facts.join(current, reduce(Column.__and__, tests), how).drop(*keys)


def _lengths(df: DataFrame, length: Column) -> list[int]:
    """Distinct pattern lengths: a handful of integers, never longer than the
    longest pattern text."""
    return sorted(r[0] for r in df.select(length.alias("n")).distinct().collect())


def prefix_lookup(values: DataFrame, column: str, lookup: DataFrame, pattern: str, sep: str | None = None) -> DataFrame:
    """Rows of ``lookup`` for every distinct value its pattern covers.

    A pattern with ``*`` covers values that start with the rest of it, another
    one covers its own text.  Each value is cut to every prefix length that
    occurs among the patterns and joined by equality, so there is no loop over
    value-pattern pairs.  The pattern column holds the value in the result.
    With ``sep`` the column is a list of values.
    """
    source = F.col(column).cast("string")
    if sep is not None:
        source = F.explode(F.split(source, "\\Q" + sep + "\\E", -1))
    distinct = values.select(source.alias("_value")).filter(F.col("_value").isNotNull()).distinct()
    star = F.contains(F.col(pattern), F.lit("*"))
    stem = F.when(star, F.replace(F.col(pattern), F.lit("*"), F.lit(""))).otherwise(F.col(pattern))
    others = [c for c in lookup.columns if c != pattern]
    rules = lookup.filter(F.col(pattern).isNotNull()).select(
        F.when(star, F.length(stem)).otherwise(F.lit(-1)).alias("_len"), stem.alias("_stem"), *others
    )
    cuts = [
        F.when(F.length("_value") >= n, F.struct(F.lit(n).alias("_len"), F.substring("_value", 1, n).alias("_stem")))
        for n in _lengths(rules, F.col("_len"))
        if n >= 0
    ]
    cuts.append(F.struct(F.lit(-1).alias("_len"), F.col("_value").alias("_stem")))
    pieces = distinct.select("_value", F.explode(F.array_compact(F.array(*cuts))).alias("_p")).select("_value", "_p.*")
    hits = pieces.join(rules, ["_len", "_stem"])
    return hits.select(F.col("_value").alias(pattern), *others).distinct()


#: Places of a piece that are compared with the characters patterns have there, characters
#: that come to the driver for one place, and stretches of characters that they become.
_PLACES, _CHARACTERS, _STRETCHES = 16, 1000, 32


def _any_of(characters: Sequence[str]) -> str:
    """A regular expression for these characters; those beyond Latin-1 as a few stretches that hold them."""
    codes = sorted(map(ord, characters))
    parts = [f"\\x{{{c:x}}}" for c in codes if c < 0x100]
    # no stretch holds surrogates, so nothing starts or ends in the middle of a character
    for far in ([c for c in codes if 0x100 <= c < 0xD800], [c for c in codes if c > 0xDFFF]):
        gaps = sorted(range(1, len(far)), key=lambda i: far[i - 1] - far[i])[: _STRETCHES - 1]
        cuts = [0, *sorted(gaps), len(far)] if far else []
        parts += [f"\\x{{{far[i]:x}}}-\\x{{{far[k - 1]:x}}}" for i, k in zip(cuts, cuts[1:])]
    return f"[{''.join(parts)}]"


def _piece_finders(pieces: DataFrame, piece: str) -> list[str]:
    """A regular expression per length of the texts in ``piece`` (not empty), that captures
    wherever each character can be one that some text of this length has at this place.

    A place with many characters, or far behind, takes any character: what is captured has
    to be compared in full.
    """
    letters = F.regexp_extract_all(F.substring(piece, 1, _PLACES), F.lit("(?s)."), 0)
    marks = pieces.select(F.length(piece).alias("n"), F.posexplode(letters).alias("at", "c"))
    found = marks.distinct().groupBy("n", "at").agg(F.collect_set("c").alias("all"))
    rows = found.select("n", "at", F.when(F.size("all") <= _CHARACTERS, F.col("all")).alias("all")).collect()
    lists = {(r["n"], r["at"]): r["all"] for r in rows}

    def one(n: int, at: int) -> str:
        known = lists[n, at]
        return _any_of(known) if known else r"[^\p{Cs}]"

    places = {n: [one(n, at) for at in range(min(n, _PLACES))] for n in sorted({n for n, _ in lists})}
    return [f"(?s)(?=({''.join(p)}.{{{n - len(p)}}}))" for n, p in places.items()]


def contains_lookup(
    names: DataFrame,
    name: str,
    patterns: DataFrame,
    pattern: str,
    match_type: str,
    priority: str,
) -> DataFrame:
    """The best pattern row for every distinct name that has one.

    ``pattern`` rows match names that contain their text (any case), ``exact``
    rows equal names; the lowest priority wins, NULL last, then the pattern
    text.  Regular expressions cut the pieces out of a name that have the characters of
    patterns at every place, one pass per occurring pattern length, so the work is linear in
    the length of a name; they are joined by equality with one row per pattern text, so only
    real hits come out, and a partial aggregate keeps the best.  Patterns are plain text:
    ``%`` and ``_`` stand for themselves.
    """
    others = patterns.columns
    best = F.struct(
        F.col(priority).isNull().alias("_last"),
        F.col(priority).alias("_priority"),
        F.col(pattern).alias("_text"),
        F.struct(*others).alias("_row"),
    )
    kind = F.lower(F.trim(F.col(match_type)))
    texts = patterns.filter(kind.isin("pattern", "exact") & F.col(pattern).isNotNull()).select(
        (kind == "pattern").alias("_part"),
        F.when(kind == "pattern", F.lower(F.col(pattern))).otherwise(F.col(pattern)).alias("_piece"),
        best.alias("_best"),
    )
    rules = join_side(texts, ["_part", "_piece"], F.min("_best").alias("_best"))
    # read up to three times below, so it is computed once
    distinct = names.select(F.col(name).cast("string").alias("_name")).filter(F.col("_name").isNotNull()).distinct()
    distinct = durable(distinct.withColumn("_key", F.md5("_name")))
    whole = rules.filter(~F.col("_part")).select(F.md5("_piece").alias("_key"), "_best")
    hits = distinct.select("_key").join(whole, "_key")
    parts = rules.filter("_part").select("_piece", "_best")
    finders = _piece_finders(texts.filter("_part and _piece <> ''"), "_piece")
    if finders:
        # distinct pieces of a name; only a digest of the name goes with them
        lows = distinct.select("_key", F.lower("_name").alias("_low"))
        pieces = F.array_distinct(F.concat(*[F.regexp_extract_all("_low", F.lit(f), 1) for f in finders]))
        cut = lows.select("_key", F.explode(pieces).alias("_piece"))
        hits = hits.unionByName(cut.join(parts, "_piece").select("_key", "_best"))
    if not texts.filter("_part and _piece = ''").isEmpty():  # the empty text is in every name: one row, as a scalar
        best_empty = parts.filter("_piece = ''").select("_best").scalar()
        hits = hits.unionByName(distinct.select("_key", best_empty.alias("_best")))
    hits = hits.groupBy("_key").agg(F.min("_best").alias("_best"))
    named = distinct.join(hits, "_key")
    return named.select(F.col("_name").alias(name), "_best._row.*")



def assign_from_lookups(
    df: DataFrame, lookups: Mapping[str, DataFrame], specs: Sequence[tuple[str, Mapping[str, str], str, str]]
) -> DataFrame:
    """Columns from lookups; specs that share table and condition share one join.

    A spec is (lookup, {column: lookup column}, output column, new name).
    """
    joins: dict[tuple, list[tuple[str, str]]] = {}
    for table, on, output, name in specs:
        joins.setdefault((table, tuple(on.items())), []).append((output, name))
    out = df.drop(*[name for *_, name in specs])
    for i, ((table, on), outputs) in enumerate(joins.items()):
        keys = {theirs: f"_j{i}_{k}" for k, (_, theirs) in enumerate(on)}
        side = lookups[table].select(
            *[F.col(theirs).alias(key) for theirs, key in keys.items()],
            *[F.col(o).alias(n) for o, n in outputs],
        )
        test = reduce(Column.__and__, [F.col(ours) == F.col(keys[theirs]) for ours, theirs in on])
        out = out.join(side, test, "left").drop(*keys.values())
    return out
