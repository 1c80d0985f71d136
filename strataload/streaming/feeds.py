"""Incremental loads as the body of a stream.

A streaming file source hands over each new delivery as a batch with a number, and the
batch is loaded like any other feed.  The numbers of loaded batches are a ledger in the
manifest of the table's version: rows and number are committed together, so a batch that
is handed over again, after a crash between load and checkpoint or with a lost
checkpoint, changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strataload.audit import AuditSpec
from strataload.plans.touched import load_touched_files
from strataload.sources.versions import version

LEDGER = "batches"


def ledger(spark: SparkSession, path: str) -> dict[str, int]:
    """The last loaded batch number of every stream into a table."""
    at = version(spark, path)
    return dict(at.details.get(LEDGER, {})) if at else {}


def load_batch(
    batch: DataFrame,
    number: int,
    path: str,
    stream: str,
    prepare: Callable[[DataFrame, AuditSpec], DataFrame],
    audit: AuditSpec,
    strategy: str,
    **args,
) -> bool:
    """Load one batch unless the ledger has it; whether the table changed.

    A batch without rows is passed by: with most strategies it would close the table.
    """
    spark = batch.sparkSession
    done = ledger(spark, path)
    if number <= done.get(stream, -1) or batch.isEmpty():
        return False
    rows = prepare(batch, audit)
    load_touched_files(spark, rows, path, strategy=strategy, audit=audit, details={LEDGER: {**done, stream: number}}, **args)
    return True


def start_loading(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    stream: str,
    prepare: Callable[[DataFrame, AuditSpec], DataFrame],
    audit_of: Callable[[int], AuditSpec],
    strategy: str,
    **args,
) -> StreamingQuery:
    """Load everything that a streaming source has now, batch by batch, and stop.

    ``prepare`` maps and stamps a batch; ``audit_of`` gives the dates of a batch number, so
    that a repeated batch would be stamped alike.
    """

    def body(batch: DataFrame, number: int) -> None:
        load_batch(batch, number, path, stream, prepare, audit_of(number), strategy, **args)

    writer = feed.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
