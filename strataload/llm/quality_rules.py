"""Quality rules and a hashed n-gram likelihood ratio, in SQL functions only.

Base rules count words, characters and repeats of each whole text.  The method's verdict
compares two multinomials over hashed word 1- and 2-grams: one of the trusted target
documents, one of the whole corpus.  A document's score is the mean over its n-grams of
log p_target - log p_raw, so length does not matter, and every document is kept or not
by the same threshold.

Both counts are sums over all documents of their kind, combined on the map side into one
row per bucket.  To learn which documents are trusted, the texts are shuffled once by
doc_id, at every size.  The table of log ratios has a fixed number of buckets and reaches
the texts as one value, a scalar subquery; words, windows and sums are array functions.

Defined cases: a NULL or wordless text has 0 in every count and fails the base rules
(score NULL); a line of white space is no line with a word; a doc_id that is NULL is not
in the target; repeated rows are judged alike; without target documents the ratio is 0
everywhere; empty tables give an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.llm.common import WORD, settle


@dataclass(frozen=True)
class RuleSpec:
    """``buckets`` of the hash; a bucket starts as if ``prior`` target n-grams agreed with the corpus."""

    buckets: int = 1 << 15
    prior: float = 1.0
    least: float = -0.1
    least_words: int = 20
    most_repeated: int = 30  # per cent of words in repeated windows
    window: int = 8


_SPACE = r"[\\x20\\x09-\\x0D]+"


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``value``, computed once, under ``name``: a transform of one element."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _words(text: str) -> str:
    """SQL for the words of a text."""
    return f"array_remove(split({text}, '{_SPACE}'), '')"


def _paired(items: str, offset: int) -> str:
    """SQL for a hash of every item with the one ``offset`` places later."""
    rest = f"greatest(0, size(v) - {offset})"
    return _let(items, "v", f"zip_with(slice(v, 1, {rest}), slice(v, {offset + 1}, {rest}), (x, y) -> xxhash64(x, y))")


def _with_grams(text: str, body: str) -> str:
    """SQL for ``body`` with the hashes of the 1-grams and 2-grams of a lower-cased text as ``h`` and ``p``."""
    return _let(f"transform({_words(f'lower({text})')}, w -> xxhash64(w))", "h", _let(_paired("h", 1), "p", body))


def log_ratios(docs: DataFrame, target_ids: DataFrame, spec: RuleSpec = RuleSpec()) -> DataFrame:
    """One row with ``ratios``: log p_target - log p_raw of every bucket.

    ``target_ids``: doc_id of the trusted documents.
    """
    trusted = target_ids.select(F.col("doc_id").alias("_trusted")).dropna().distinct()
    # the ids are the hashed side, so texts are shuffled but not sorted; read from files, the
    # ids have their shuffle right below the join, and AQE can split a partition of texts
    ids = settle(trusted).hint("shuffle_hash")
    marked = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_trusted"), "left")
    grams = marked.select(
        F.col("_trusted").isNotNull().cast("long").alias("in_target"),
        F.explode(F.expr(_with_grams("coalesce(text, '')", "concat(h, p)"))).alias("_gram"),
    ).select("in_target", F.expr(f"cast(pmod(_gram, {spec.buckets}) + 1 as int)").alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("in_target").alias("target"))
    every = docs.sparkSession.range(1, spec.buckets + 1, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").fillna(0, ["raw", "target"])
    # fixed number of rows from here on
    table = full.agg(F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("rows"))
    kappa = spec.prior * spec.buckets
    return table.select(
        F.expr(
            _let(
                "struct(aggregate(rows, 0L, (a, r) -> a + r.raw) as n_raw, aggregate(rows, 0L, (a, r) -> a + r.target) as n_target)",
                "n",
                f"""transform(rows, r -> if(r.raw = 0 or n.n_target = 0, 0D,
                    ln((r.target + {kappa} * r.raw / n.n_raw) / (n.n_target + {kappa})) - ln(r.raw / n.n_raw)))""",
            )
        ).alias("ratios")
    )


def base_counts(docs: DataFrame, spec: RuleSpec = RuleSpec()) -> DataFrame:
    """``docs`` (doc_id, text) with the base counts of each text."""
    size, width, halves = spec.window, 1, "_words"
    # hashes of stretches of 1, 2, 4, ... words, each from two of the former; two that overlap
    # or meet make a window.  A window can only come twice if its first half does, so most
    # texts need no windows; 64 bits tell the stretches of one text apart
    while 2 * width < size:
        halves, width = _paired(halves, width), 2 * width
    # sort (window, position), keep windows equal to a neighbour, and add up from left to
    # right the positions that they cover
    twice = """sort_array(transform(filter(transform(s, (e, k) -> struct(
        (k > 0 and e.x = s[k - 1].x) or (k + 1 < size(s) and e.x = s[k + 1].x) as twice, e.i as i)),
        e -> e.twice), e -> e.i))"""
    covered = f"""aggregate({twice}, struct(0L as words, 0 as upto),
        (a, i) -> struct(a.words + {size} - greatest(0, a.upto - i) as words, i + {size} as upto), a -> a.words)"""
    placed = "sort_array(transform(z, (x, i) -> struct(x as x, i as i)))"
    among = f"case when size(array_distinct(z)) = size(z) then 0L else {_let(placed, 's', covered)} end"
    repeated = f"case when size(array_distinct(_halves)) = size(_halves) then 0L else {_let(_paired('_halves', size - width), 'z', among)} end"
    lines = "filter(split(_text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    return (
        docs.select("doc_id", "text", F.coalesce("text", F.lit("")).alias("_text"))
        .withColumn("_words", F.expr(_words("_text")))
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("_halves", F.expr(halves))
        .withColumn("_lines", F.expr(lines))
        .select(
            "doc_id",
            "text",
            "n_words",
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            F.expr("size(split(_text, '[#*$%&|<>]')) - 1").cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.expr(repeated).cast("long").alias("n_repeat_words"),
        )
    )


def judge(docs: DataFrame, target_ids: DataFrame, spec: RuleSpec = RuleSpec()) -> DataFrame:
    """Base counts of every document, base_failed, score (mean log ratio) and kept."""
    ratios = settle(log_ratios(docs, target_ids, spec)).scalar()
    failed = (F.col("n_words") < spec.least_words) | (
        100 * F.col("n_repeat_words") > spec.most_repeated * F.col("n_words")
    )
    counted = base_counts(docs, spec).withColumn("base_failed", failed).withColumn("_ratios", ratios)
    # the 1-grams in order, then the 2-grams
    add = f"(a, g) -> a + _ratios[pmod(g, {spec.buckets})]"
    total = f"aggregate(p, aggregate(h, 0D, {add}), {add}, a -> a / nullif(size(h) + size(p), 0))"
    mean = _with_grams("coalesce(text, '')", total)
    return counted.withColumn("score", F.expr(mean)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("score") >= spec.least, F.lit(False))).alias("kept"),
        "score",
    )
