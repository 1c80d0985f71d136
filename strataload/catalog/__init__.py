"""Queries over the test tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from strataload.catalog.registry import ORACLES, QUERIES

MODULES = ("loads", "scans", "shaping", "lookups", "identity", "publishing", "quality")

for _name in MODULES:
    import_module(f"strataload.catalog.{_name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
