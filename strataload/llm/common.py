"""Shared helpers of the corpus operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strataload.session import tune
from strataload.sources.sink import scratch_folder

# A word is a run of characters other than space and the five ASCII controls 09-0D.
WORD = r"[^\x20\x09-\x0D]+"

# Rows handed to Python at a time: texts are long, so a batch stays small.
BATCH_ROWS = "256"

# Functions of this package travel to the tasks whole, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the corpus operators are written for."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def settle(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it again.

    The plan behind it is cut: a lost executor costs a reread of files that every
    executor sees, never another pass over the texts.
    """
    spark = df.sparkSession
    path = f"{folder or scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (-1 for a NULL id, which is in no fold)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``df`` has them."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def sample_ids(rows: DataFrame, per: Sequence[str], limit: int, seed: str) -> DataFrame:
    """At most ``limit`` rows for each value of ``per`` (not NULL), chosen by a hash of doc_id.

    The same rows on every run.  The values are counted first, and only rows whose hash is
    below the share of its value that is wanted, and a little more, are ranked: a task
    gets about ``limit`` rows of a value, however many the table has.  One count per value
    comes to the driver.
    """
    mixed = F.xxhash64(F.lit(seed), "doc_id")
    total, rank = fresh(rows, "total", "rank")
    counts = rows.groupBy(*per).agg(F.count(F.lit(1)).alias(total)).collect()
    schema = T.StructType([*[rows.schema[c] for c in per], T.StructField(total, T.LongType())])
    known = F.broadcast(rows.sparkSession.createDataFrame(counts, schema))
    names = rows.columns
    rows = rows.join(known, list(per)) if per else rows.withColumn(total, F.lit(counts[0][0]))
    enough = limit + 8 * limit**0.5 + 50  # a hash share below it leaves out too much once in 10^15
    rows = rows.filter((mixed / F.lit(2.0**64) + 0.5) * F.col(total) < enough).select(*names)
    order = Window.partitionBy(*per).orderBy(mixed, *names)
    return rows.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= limit).drop(rank)


class WordHashes(dict):
    """64-bit hashes of words, remembered while there are fewer than ``most``."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of ``size`` word hashes, in order."""
    count = len(words) - size + 1
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out ^= out >> np.uint64(29)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[i : i + count]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; none for NULL.

    Splitting bytes on ASCII white space is the word rule above.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _frame(batch: pa.RecordBatch, columns: Sequence[str]) -> pd.DataFrame:
    """Plain Python values, with None for NULL."""
    return pd.DataFrame({c: pd.Series(batch.column(c).to_pylist(), dtype=object) for c in columns})


def append(df: DataFrame, columns: Sequence[str], fn, added: T.StructType) -> DataFrame:
    """``df`` with the columns ``added``, which ``fn`` makes from a pandas frame of ``columns``.

    Other columns pass through as they are; columns that have an added name, in whatever
    case, are replaced.
    """
    replaced = {name.lower() for name in added.names}
    kept = [f for f in df.schema.fields if f.name.lower() not in replaced]
    arrow_types = to_arrow_schema(added)
    out_schema = T.StructType([*kept, *added.fields])
    columns = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(_frame(batch, columns))
            new = [pa.array(made[f.name].tolist(), type=f.type, from_pandas=True) for f in arrow_types]
            old = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*old, *new], names=out_schema.names)

    return df.mapInArrow(run, out_schema)


def keep_where(df: DataFrame, columns: Sequence[str], fn) -> DataFrame:
    """The rows of ``df`` for which ``fn``, given a pandas frame of ``columns``, is true."""
    columns = list(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(np.asarray(fn(_frame(batch, columns)), bool)))

    return df.mapInArrow(run, df.schema)


def spanning(table: np.ndarray) -> list[tuple[int, int]]:
    """Links that hold the components of a symmetric table of links together: a forest."""
    unseen, out = table.any(axis=1), []
    for root in np.nonzero(unseen)[0].tolist():
        waiting, unseen[root] = [root] if unseen[root] else [], False
        while waiting:
            at = waiting.pop()
            new = np.nonzero(table[at] & unseen)[0]
            unseen[new] = False
            out += [(at, n) for n in new.tolist()]
            waiting += new.tolist()
    return out
