"""Post-load patching and snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.plans.mapping import run_steps
from strataload.schema import union_bag
from strataload.sources.scan import active_rows


def patch(df: DataFrame, fixes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Columns of ``fixes`` replace those of ``df`` by key.

    A row without a fix gets NULL in those columns, not its old value.
    """
    new = [c for c in fixes.columns if c not in keys]
    kept = [c for c in df.columns if c not in new]
    return df.select(*kept).join(fixes.select(*keys, *new), list(keys), "left").select(*kept, *new)


def dedupe_patch(
    table: DataFrame, name: str, scripts: Sequence[Mapping[str, str]], keys: Sequence[str],
    others: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Fix the active rows of a table by scripts over active tables.

    Every script is a chain of SQL steps; the results together are the fixes.
    All other rows, NULL in ``is_active`` included, come back unchanged.  The table itself is not replaced.
    """
    active = {n: active_rows(d) for n, d in {**(others or {}), name: table}.items()}
    fixes = union_bag([run_steps(active, steps) for steps in scripts])
    fixed = patch(active[name], fixes, keys)
    inactive = table.filter(~F.col("is_active").eqNullSafe(1))
    return union_bag([fixed, inactive])


def snapshot_steps(
    inputs: Mapping[str, DataFrame], steps: Mapping[str, str | Mapping[str, object]], outputs: Sequence[str]
) -> DataFrame:
    """Ordered steps, each SQL or constants for the step before; the listed
    outputs are united."""
    spark = next(iter(inputs.values())).sparkSession
    frames = dict(inputs)
    last = None
    for name, step in steps.items():
        if isinstance(step, str):
            used = {k: v for k, v in frames.items() if f"{{{k}}}" in step}
            frames[name], last = spark.sql(step, **used), name
        else:
            frames[last] = frames[last].withColumns({c.strip().lower(): F.lit(v) for c, v in step.items()})
    return union_bag([frames[n] for n in outputs])
