"""Functions that configuration chooses by name.

Four registries: ``COLUMNS`` (arguments -> column), ``BEFORE`` and ``AFTER`` (frame ->
frame, around a load), and ``CHECKS`` (frame -> check_name, passed).  A configuration
names a function and its arguments as ``name`` or ``name(argument, ...)``, arguments being
plain texts; several are separated by ``;`` and applied in order.
"""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.functions.scalar import has_long_value, month_text, split_list
from strataload.operators.quality import check_deact_feed
from strataload.schema import config_constants, drop_excluded, snake_columns

_CALL = re.compile(r"\s*(\w+)\s*(?:\(([^()]*)\))?\s*")


class Registry(dict):
    """Functions by name; a name is registered once."""

    def __init__(self, kind: str):
        super().__init__()
        self.kind = kind

    def register(self, name: str) -> Callable:
        def keep(fn: Callable) -> Callable:
            if name in self:
                raise KeyError(f"{self.kind} function {name!r} is registered twice")
            self[name] = fn
            return fn

        return keep

    def calls(self, text: str) -> list[tuple[Callable, list[str]]]:
        """The functions that a configuration names, with their arguments."""
        out = []
        for part in filter(str.strip, text.split(";")):
            call = _CALL.fullmatch(part)
            if not call or call.group(1) not in self:
                raise LookupError(f"no {self.kind} function {part.strip()!r}; there are {sorted(self)}")
            given = [a.strip() for a in call.group(2).split(",")] if call.group(2) and call.group(2).strip() else []
            fn = self[call.group(1)]
            try:
                inspect.signature(fn).bind(*([None] if self.kind != "column" else []), *given)
            except TypeError as error:
                raise LookupError(f"{self.kind} function {part.strip()!r}: {error}") from None
            out.append((fn, given))
        return out


COLUMNS, BEFORE, AFTER, CHECKS = (Registry(kind) for kind in ("column", "before", "after", "check"))


def column(text: str) -> Column:
    """The column of one named function."""
    calls = COLUMNS.calls(text)
    if len(calls) != 1:
        raise LookupError(f"one column function expected: {text!r}")
    fn, given = calls[0]
    return fn(*given)


def with_columns(df: DataFrame, named: dict[str, str]) -> DataFrame:
    """``df`` with columns by name of their function."""
    return df.withColumns({name: column(text) for name, text in named.items()})


def processed(df: DataFrame, registry: Registry, text: str) -> DataFrame:
    """``df`` through the named functions of ``BEFORE`` or ``AFTER``, in order."""
    for fn, given in registry.calls(text):
        df = fn(df, *given)
    return df


def checks(text: str) -> list[Callable[[DataFrame], DataFrame]]:
    """The named checks, as a staging job takes them."""
    return [lambda feed, fn=fn, given=given: fn(feed, *given) for fn, given in CHECKS.calls(text)]


@COLUMNS.register("month_text")
def _month_text(name: str) -> Column:
    return month_text(F.col(name))


@COLUMNS.register("has_long_value")
def _has_long_value(name: str, length: str, separator: str = "^") -> Column:
    return has_long_value(split_list(F.col(name), separator), int(length))


@COLUMNS.register("trimmed")
def _trimmed(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


BEFORE.register("snake_columns")(snake_columns)
BEFORE.register("drop_excluded")(drop_excluded)


@BEFORE.register("distinct")
def _distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


@BEFORE.register("without_nulls")
def _without_nulls(df: DataFrame, *names: str) -> DataFrame:
    return df.dropna(subset=list(names) or None)


@AFTER.register("constant")
def _constant(df: DataFrame, name: str, value: str) -> DataFrame:
    return config_constants(df, {name: value})


@AFTER.register("drop")
def _drop(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


@CHECKS.register("deact_feed")
def _deact_feed(df: DataFrame, load_type: str) -> DataFrame:
    return check_deact_feed(df, load_type)


@CHECKS.register("unique")
def _unique(df: DataFrame, *names: str) -> DataFrame:
    """No two rows share the values of the columns."""
    repeated = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    return repeated.agg(F.lit(f"unique {','.join(names)}").alias("check_name"), (F.coalesce(F.max("n"), F.lit(1)) == 1).alias("passed"))


@CHECKS.register("present")
def _present(df: DataFrame, *names: str) -> DataFrame:
    """No row lacks a value in one of the columns."""
    missing = [F.count_if(F.col(n).isNull() | (F.trim(F.col(n).cast("string")) == "")) for n in names]
    total = missing[0]
    for more in missing[1:]:
        total = total + more
    return df.agg(F.lit(f"present {','.join(names)}").alias("check_name"), (total == 0).alias("passed"))


def run_named(df: DataFrame, registry: Registry, texts: Sequence[str]) -> DataFrame:
    """As :func:`processed`, for a list of configuration lines."""
    return processed(df, registry, ";".join(texts))
