"""Registration of queries with their SQL counterpart."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataload.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` it is checked by tests only."""

    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(tune(spark), sf_dir))

        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


class Tables:
    """The test tables of one scale folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def __getattr__(self, table: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(table))
        setattr(self, table, df)  # the footer is read once per query
        return df
