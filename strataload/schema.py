"""Column alignment, unions and set operations over differently shaped tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names accepted in configuration and their Spark types.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "bit": T.BooleanType(),
    "binary": T.BinaryType(),
    "short": T.ShortType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "decimal": T.DecimalType(10, 0),
    "byte": T.ByteType(),
    "null": T.NullType(),
}


class SchemaDrift(ValueError):
    """A column of the target is missing from the source."""


def spark_type(name: str) -> T.DataType:
    """Type for a configured name; unknown names are strings."""
    return TYPE_NAMES.get(name.strip().lower(), T.StringType())


def empty_table(spark, columns: Mapping[str, str]) -> DataFrame:
    """Typed empty table for a target that does not exist yet."""
    fields = [T.StructField(name, spark_type(kind)) for name, kind in columns.items()]
    return spark.createDataFrame([], T.StructType(fields))


def merged_types(dfs: Sequence[DataFrame]) -> dict[str, T.DataType]:
    """Superset of columns; a string type wins, otherwise the last type seen."""
    types: dict[str, T.DataType] = {}
    for df in dfs:
        for field in df.schema.fields:
            known = types.get(field.name)
            if not isinstance(known, T.StringType):
                types[field.name] = field.dataType
    return types


def conform(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Project ``df`` on exactly ``types``: cast what is there, NULL for the rest.

    A text that is no value of the type gives NULL.
    """
    have = {f.name: f.dataType for f in df.schema.fields}

    def one(name: str, kind: T.DataType) -> Column:
        if name not in have:
            return F.lit(None).cast(kind).alias(name)
        return F.col(f"`{name}`") if have[name] == kind else F.col(f"`{name}`").try_cast(kind).alias(name)

    return df.select(*[one(name, kind) for name, kind in types.items()])


def align_schema(dfs: Sequence[DataFrame]) -> list[DataFrame]:
    types = merged_types(dfs)
    return [conform(df, types) for df in dfs]


def align_to_source(df: DataFrame, source_schema: T.StructType, on_dropped: str = "error") -> DataFrame:
    """Shape a target table like the source feed.

    Columns only the source has are added as NULL.  Columns only the target has
    raise, or are dropped with ``on_dropped="drop"``.
    """
    dropped = sorted(set(df.columns) - set(source_schema.names))
    if dropped and on_dropped == "error":
        raise SchemaDrift(f"columns {dropped} present in target but not in source")
    return conform(df, {f.name: f.dataType for f in source_schema.fields})


def union_bag(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL over the merged column set, types unified first."""
    return reduce(DataFrame.unionByName, align_schema(dfs))


def union_set(dfs: Sequence[DataFrame]) -> DataFrame:
    """Distinct union over the sorted column superset; one DISTINCT at the end."""
    types = merged_types(dfs)
    ordered = {name: types[name] for name in sorted(types)}
    return reduce(DataFrame.unionByName, [conform(df, ordered) for df in dfs]).distinct()


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Whole-row EXCEPT over the merged columns; also removes repeats on the left.

    One aggregate over both sides instead of an anti join and a distinct: rows are
    combined on the map side and shuffled once, and NULLs compare as equal.
    """
    types = merged_types([left, right])
    ordered = {name: types[name] for name in sorted(types)}
    ours = conform(left, ordered).withColumn("_right", F.lit(False))
    theirs = conform(right, ordered).withColumn("_right", F.lit(True))
    rows = ours.unionByName(theirs).groupBy(*ordered).agg(F.bool_or("_right").alias("_right"))
    return rows.filter(~F.col("_right")).drop("_right")


def distinct_values(df: DataFrame, columns: Sequence[str], out: str = "name") -> DataFrame:
    """UNION (distinct) of several columns of one table, in a single scan."""
    values = F.array(*[F.col(c).cast("string") for c in columns])
    return df.select(F.explode(values).alias(out)).distinct()


def snake_columns(df: DataFrame) -> DataFrame:
    """Whitespace in column names becomes ``_``."""
    return df.toDF(*[re.sub(r"\s+", "_", name.strip()) for name in df.columns])


def standard_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename to standard names; a blank standard name keeps the column's own."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if new.strip()})


def config_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def reorder(df: DataFrame, first: Iterable[str], last: Iterable[str] = ()) -> DataFrame:
    """Mapped columns first, then the others, then ``last`` (audit columns)."""
    head = [c for c in dict.fromkeys(first) if c in df.columns]
    tail = [c for c in dict.fromkeys(last) if c in df.columns and c not in head]
    middle = [c for c in df.columns if c not in head and c not in tail]
    return df.select(*head, *middle, *tail)


# Fixed value: name of the exclusion flag.
EXCLUSION_FLAG = "exclude_per_did"


def drop_excluded(df: DataFrame, flag: str = EXCLUSION_FLAG) -> DataFrame:
    """Remove rows flagged 1, only when the flag column exists (any case)."""
    found = [c for c in df.columns if c.lower() == flag.lower()]
    if not found:
        return df
    return df.filter(F.coalesce(F.col(found[0]).cast("int"), F.lit(0)) != 1)


def unpivot_numbered(df: DataFrame, keys: Sequence[str], stems: Sequence[str], instance: str = "instance") -> DataFrame:
    """Numbered columns (``name1, name2 ...``) become one child row per number."""
    numbers = sorted(
        {int(m.group(1)) for c in df.columns for s in stems if (m := re.fullmatch(rf"{re.escape(s)}_?(\d+)", c))}
    )

    def block(number: int) -> Column:
        parts = [F.lit(number).alias(instance)]
        for stem in stems:
            found = [c for c in df.columns if re.fullmatch(rf"{re.escape(stem)}_?{number}", c)]
            parts.append((F.col(found[0]) if found else F.lit(None).cast("string")).alias(stem))
        return F.struct(*parts)

    rows = df.select(*keys, F.explode(F.array(*[block(n) for n in numbers])).alias("_b"))
    return rows.select(*keys, "_b.*")
