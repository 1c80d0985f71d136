"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, twice over.  A copy
finishes at the virtual time (words its source has sent so far, itself included) /
(the source's target).  All copies are put in order of virtual finish time and the
stream is cut where it reaches the total budget, so at any moment each source has
sent its share.  Only columns of a few bytes move; texts never do.

Running sums over a hot source or over the whole stream are taken in two steps:
sums of small ranges first (combined on the map side), then inside a range.

Defined cases: a NULL text has size 0; documents of size 0 are never in the stream
(taken 0); a NULL source is a source of its own, sorted last; a NULL doc_id is
shuffled like any other value; repeated rows are documents of their own, and equal
rows are interchangeable; an empty table gives an empty result.  Extra columns of
the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.llm.common import WORD, fresh, settle

_LOT_DIGITS = 3  # hex digits of the shuffle hash that name a lot: 4096 lots a source
_RANGES = 4096  # ranges of virtual time per unit, and again inside the last range


@dataclass(frozen=True)
class MixSpec:
    """Weights go round the sources in code-point order; epochs bound the repeats."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    epochs: int = 2
    seed: str = "mix"


def _source_targets(sizes: DataFrame, spec: MixSpec) -> DataFrame:
    """One row per source: its size and target.

    Sources whose share would exceed ``epochs`` times their size stop there and the
    rest share the remainder by weight.  In order of size / weight the capped sources
    come first, so the level is found with running sums.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in spec.weights])
    ranked = sizes.withColumn(
        "weight", F.element_at(weights, ((F.row_number().over(by_name) - 1) % len(spec.weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * spec.epochs)
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    budget = F.sum("source_size").over(every).cast("double") * F.lit(spec.share)
    level = (budget - capped.cast("double")) / weight_left.cast("double")
    ratio = F.col("cap").cast("double") / F.col("weight").cast("double")
    leveled = ranked.withColumn("level", F.when(level <= ratio, level))
    found = F.max("level").over(every)
    cap = F.col("cap").cast("double")
    return leveled.select(
        "source",
        "source_size",
        F.least(cap, F.coalesce(found * F.col("weight").cast("double"), cap)).alias("target"),
    )


def _null_safe_key(source: str = "source") -> list[Column]:
    return [F.coalesce(F.col(source), F.lit("")).alias("source_key"), F.col(source).isNull().alias("no_source")]


def queue(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """Each document with its place in its source's shuffled queue.

    Columns: doc_id, source, size, source_size, target, sent (words of the source up to
    and with this document in one epoch).
    """
    order = F.md5(
        F.concat(F.lit(f"{spec.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).cast("binary")
    )
    sized = settle(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            order.alias("place"),
            *_null_safe_key(),
        ).withColumn("lot", F.substring("place", 1, _LOT_DIGITS))
    )
    keys = ["source_key", "no_source"]
    lots = sized.groupBy(*keys, "lot").agg(F.sum("size").alias("lot_size"))
    earlier = Window.partitionBy(*keys).orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = _source_targets(sizes, spec).select(*_null_safe_key(), "source_size", "target")
    starts = lots.select(*keys, "lot", F.coalesce(F.sum("lot_size").over(earlier), F.lit(0)).alias("start"))
    starts = starts.join(targets, keys)
    inside = Window.partitionBy(*keys, "lot").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return sized.join(starts, [*keys, "lot"]).withColumn("sent", F.col("start") + F.sum("size").over(inside))


def _copies(queued: DataFrame, spec: MixSpec) -> DataFrame:
    """A row per copy with its virtual finish time; documents without words have none."""
    return queued.filter("size > 0").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(spec.epochs - 1))).alias("epoch")
    ).withColumn("finish", _finish(F.col("epoch")))


def _finish(epoch: Column) -> Column:
    return (F.col("sent") + epoch * F.col("source_size")).cast("double") / F.col("target")


def _order(finish: Column) -> Column:
    """The total order of copies: a source and a place in it are met once."""
    return F.struct(finish.alias("finish"), F.col("no_source"), F.col("source_key"), F.col("sent"))


def _last_taken(copies: DataFrame, budget: float):
    """Sort key of the last copy inside the budget, None if there is none.

    The stream is cut into ranges of virtual time, the range in which the budget ends
    is cut into ranges again, and only what is left is sorted and summed copy by copy.
    """
    low, width, before = 0.0, 1.0 / _RANGES, 0
    rest = copies
    for _ in range(2):
        part = F.least(F.floor((F.col("finish") - F.lit(low)) / F.lit(width)), F.lit(2 * _RANGES)).cast("long")
        sums = rest.groupBy(part.alias("part")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.orderBy("part"))
        over = (
            sums.withColumn("running", running)
            .filter(F.col("running") > F.lit(budget - before))
            .orderBy("part")
            .select("part", F.col("running") - F.col("words"))
            .first()
        )
        if over is None:  # every copy fits
            return copies.agg(F.max(_order(F.col("finish")))).first()[0]
        rest = rest.filter(part == over[0])
        before += over[1]
        if over[0] >= 2 * _RANGES:  # the open range at the end cannot be cut again
            break
        low, width = low + over[0] * width, width / _RANGES
    key = _order(F.col("finish"))
    running = F.sum("size").over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    inside = rest.withColumn("running", running).filter(F.col("running") <= F.lit(budget - before))
    last = inside.agg(F.max(key)).first()[0]
    if last is None and before:
        # the budget ends with the copy before this range
        last = copies.filter(F.col("finish") < F.lit(rest.agg(F.min("finish")).first()[0])).agg(F.max(key)).first()[0]
    return last


def mix(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """Documents with their share of the mix.

    Columns: doc_id, source, size, source_size, target, copies (times the document is in
    the mix), taken (words that it gives), first_finish (virtual time of its first copy).
    """
    queued = settle(queue(docs, spec))
    total = queued.agg(F.sum("size")).first()[0] or 0
    last = _last_taken(_copies(queued, spec), total * spec.share) if total else None
    copies = F.lit(0)
    if last is not None:
        cut = F.struct(
            F.lit(last["finish"]).alias("finish"),
            F.lit(last["no_source"]).alias("no_source"),
            F.lit(last["source_key"]).alias("source_key"),
            F.lit(last["sent"]).alias("sent"),
        )
        for epoch in range(spec.epochs):
            copies = copies + (_order(_finish(F.lit(epoch))) <= cut).cast("int")
        copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0))
    return queued.withColumn("copies", copies).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        F.col("target"),
        "copies",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.when(F.col("size") > 0, _finish(F.lit(0))).alias("first_finish"),
    )


def schedule(mixed: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The stream itself: a row per copy taken, range-sorted by virtual finish time."""
    return (
        mixed.filter("copies > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"))
        .withColumn("finish", F.col("first_finish") + F.col("epoch") * F.col("source_size") / F.col("target"))
        .repartitionByRange("finish", F.col("source").asc_nulls_last(), "doc_id")
        .sortWithinPartitions("finish", F.col("source").asc_nulls_last(), "doc_id")
    )


def mixed_documents(docs: DataFrame, spec: MixSpec = MixSpec()) -> DataFrame:
    """The documents of the mix with columns copies and taken; those not taken are left out.

    Rows that share doc_id, source and size are numbered on both sides, so each gets
    the share of exactly one of them.
    """
    docs = docs.drop("copies", "taken")
    at, size = fresh(docs, "at", "size")
    same = Window.partitionBy("doc_id", "source", size).orderBy("doc_id")
    left = docs.withColumn(size, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    left = left.withColumn(at, F.row_number().over(same))
    among = Window.partitionBy("doc_id", "source", "size").orderBy(F.desc("copies"))
    plan = mix(docs, spec).withColumn("at", F.row_number().over(among)).filter("copies > 0")
    met = F.lit(True)
    for mine, theirs in (("doc_id", "doc_id"), ("source", "source"), (size, "size"), (at, "at")):
        met = met & F.col(f"d.{mine}").eqNullSafe(F.col(f"p.{theirs}"))
    return left.alias("d").join(plan.alias("p"), met).select(*[f"d.{c}" for c in docs.columns], "p.copies", "p.taken")
