"""The table jobs: from sources to one published table.

Each job builds one lazy plan and ends in a single :func:`publish`.  There are no
intermediate tables and no counting passes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataload.audit import AuditSpec, hash_columns, row_hash, stamp
from strataload.functions.scalar import decrypt_text
from strataload.operators import incremental, mastering
from strataload.operators.dedupe import dedupe_patch, snapshot_steps
from strataload.operators.identity import (
    all_ids,
    backfill_ids,
    dense_ids,
    id_map_insert,
    id_map_update,
    max_id,
    new_rows,
    shuffled_ids,
)
from strataload.operators.lookup import assign_from_lookups, filtered_lookup
from strataload.operators.quality import run_validations
from strataload.plans.extract import (
    ExtractSpec,
    build_extract,
    collect_summaries,
    control_totals,
    data_dictionary,
    file_control,
)
from strataload.plans.mapping import (
    MappingRow,
    apply_all_rules,
    apply_per_source,
    distinct_rows,
    primary_keys,
    tracked_columns,
)
from strataload.plans.rules import Rule, RuleClass, apply_rules
from strataload.schema import config_constants, snake_columns, standard_names, union_bag
from strataload.session import durable
from strataload.sources.headers import read_by_header
from strataload.sources.metrics import Metrics
from strataload.sources.scan import read_delimited, read_parquet, read_scope, read_staging, select_feed_files
from strataload.sources.sink import export_delimited, export_parquet, publish


@dataclass(frozen=True)
class Target:
    """Where a table lives and how new rows get into it."""

    path: str
    strategy: str = "overwrite"
    args: Mapping[str, object] = field(default_factory=dict)
    partition_by: str | Sequence[str] = ()
    allowed_modes: Sequence[str] = incremental.LOAD_MODES


def load_table(
    spark: SparkSession,
    rows: DataFrame,
    target: Target,
    mode: str,
    audit: AuditSpec,
    metrics: Metrics | None = None,
    guards: Sequence[Callable[[DataFrame], None]] = (),
) -> DataFrame:
    """Load stamped rows into the target and publish it; returns the new table.

    One write and no counting job: an empty source is refused by the metrics of the
    write, before the swap, as is whatever ``guards`` refuse.
    """
    metrics = metrics or Metrics()
    existing = None if mode == "full" else read_parquet(spark, target.path)
    out = incremental.metered_load(
        rows,
        existing,
        metrics,
        mode=mode,
        strategy=target.strategy,
        audit=audit,
        allowed_modes=target.allowed_modes,
        **target.args,
    )
    refused = metrics.not_empty("source", incremental.REFUSED.format(target.strategy))
    publish(out, target.path, target.partition_by, guards=[refused, *guards])
    return spark.read.parquet(target.path)


def stage_feed(
    spark: SparkSession,
    listing: DataFrame,
    table: str,
    target: Target,
    constants: Mapping[str, object],
    checks: Sequence[Callable[[DataFrame], DataFrame]] = (),
    kind: str = "delimited",
    sep: str = ",",
    quote: str = '"',
    header: bool = True,
    **selection: str,
) -> DataFrame:
    """Pick the feed's files from a listing, read them as strings, check, publish.

    The selected file names go to the reader through the driver; rows do not.
    Every check gets the feed and gives check_name and passed; the feed is parsed once,
    checks read what was written, before it replaces the table.
    """
    chosen = select_feed_files(listing, table, **selection).select("path")
    files = [r["path"] for r in chosen.collect()]
    feed = snake_columns(read_staging(spark, files, kind, sep, quote, header))

    def checked(written: DataFrame) -> None:
        rows = written.select(*feed.columns)
        run_validations({str(i): lambda c=check: c(rows) for i, check in enumerate(checks)})

    publish(config_constants(feed, constants), target.path, target.partition_by, guards=[checked] if checks else [])
    return spark.read.parquet(target.path)


def ingest_table(
    spark: SparkSession,
    sources: Mapping[str, Mapping[str, DataFrame]],
    rows: Sequence[MappingRow],
    constants: Mapping[str, Mapping[str, object]],
    target: Target,
    audit: AuditSpec,
    mode: str = "active",
    steps: Mapping[str, str] | None = None,
    name: str = "src",
    before: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Typed mapping of every source, row-reducing steps, hash and audit, load."""
    df = apply_per_source(sources, rows, constants, mode)
    if steps:
        df = distinct_rows(df, name, steps)
    if before is not None:
        df = before(df)
    stamped = stamp(df, audit, hash_cols=hash_columns(df, tracked_columns(rows)))
    return load_table(spark, stamped, target, mode, audit)


def cleanse_table(
    spark: SparkSession,
    table: DataFrame,
    name: str,
    rules: Sequence[Rule],
    lookups: Mapping[str, DataFrame],
    target: Target,
    mode: str,
    classes: Sequence[RuleClass] = (),
    distinct: bool = False,
    names: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
    source: str = "",
) -> DataFrame:
    """Rules over the rows in scope; without rules the rows pass through."""
    rows = read_scope(table, mode, "driving", keys)
    if rules:
        rows = apply_rules(rows, rules, lookups, name, classes, mode, distinct, names, source)
    elif names:
        rows = standard_names(rows, names)
    publish(rows, target.path, target.partition_by)
    return spark.read.parquet(target.path)


def integrate_table(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    rows: Sequence[MappingRow],
    target: Target,
    audit: AuditSpec,
    mode: str = "active",
    driving: str = "",
    masters: Sequence[str] = (),
    lookups: Sequence[tuple[str, tuple[str, str], str, str, str | None]] = (),
    ids: Sequence[tuple[str, Mapping[str, str], str, str]] = (),
    steps: Mapping[str, str] | None = None,
) -> DataFrame:
    """Tables in scope, untyped mapping, lookups and common ids, hash, load.

    A lookup is (table, (column, key), output, name, filter); an id is
    (table, {column: key}, output, name).  In a full load these tables come with their
    latest row per key, so several versions of a key do not multiply rows.
    """
    keys_of = {table: [on[1]] for table, on, *_ in lookups} | {table: list(on.values()) for table, on, *_ in ids}

    def scoped(name: str) -> DataFrame:
        role = "master" if name in masters else "driving" if name == driving else "other"
        keys = keys_of.get(name, ()) if "add_date" in tables[name].columns else ()
        return read_scope(tables[name], mode, role, keys, ties=sorted(set(tables[name].columns) - {"add_date"}))

    inputs = {name: scoped(name) for name in tables}
    df = apply_all_rules(inputs, rows, mode, typed=False)
    for table, on, output, name, where in lookups:
        df = filtered_lookup(df, inputs[table], on, output, name, where)
    if ids:
        df = assign_from_lookups(df, inputs, ids)
    if steps:
        df = distinct_rows(df, "src", steps)
    hashed = hash_columns(df, tracked_columns(rows))
    if mode == "full":  # the rows bring their own history
        stamped = df.distinct().withColumns({"hashkey": row_hash(hashed), "last_modified_date": audit.now()})
    else:
        stamped = stamp(df, audit, hashed)
    return load_table(spark, stamped, target, mode, audit)


def build_masters(
    df: DataFrame,
    masters: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    source_col: str,
    views: Mapping[str, Callable[[DataFrame], Mapping[str, DataFrame]]],
    update_columns: Sequence[str],
) -> DataFrame:
    """Create and complete each master in turn; later masters see the rows of earlier ones.

    A master refers to its input several times, so the plan is cut after each: it grows
    with the number of masters and does not double with each.
    """
    for master, children in masters.items():
        updates = views[master](df) if master in views else {}
        df = durable(mastering.with_masters(df, master, children, keys, source_col, updates, keys, update_columns))
    return df


def master_table(
    spark: SparkSession,
    frames: Sequence[DataFrame],
    masters: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    source_col: str,
    views: Mapping[str, Callable[[DataFrame], Mapping[str, DataFrame]]],
    update_columns: Sequence[str],
    flags: Sequence[str],
    target: Target,
    audit: AuditSpec,
    mode: str = "active",
) -> DataFrame:
    """Combine sources, create and complete each master, list and flag sources.

    ``views`` gives, per master, a function from the combined rows to its ordered
    update views.  Later masters see the rows of earlier ones.
    """
    df = build_masters(mastering.combine_sources(frames), masters, keys, source_col, views, update_columns)
    df = mastering.source_list(df, keys, source_col)
    df = mastering.source_flags(df, flags, masters, source_col)
    final = mastering.master_final(df, list(masters), source_col, audit)
    return load_table(spark, final, target, mode, audit)


def dedupe_table(
    spark: SparkSession,
    table: DataFrame,
    name: str,
    scripts: Sequence[Mapping[str, str]],
    keys: Sequence[str],
    folder: str,
    others: Mapping[str, DataFrame] | None = None,
    prefix: str = "dedup_",
    partition_by: str | Sequence[str] = (),
) -> DataFrame:
    """Post-load fixes, published beside the table under a prefixed name; the table stays."""
    path = f"{folder.rstrip('/')}/{prefix}{name}"
    publish(dedupe_patch(table, name, scripts, keys, others), path, partition_by)
    return spark.read.parquet(path)


def snapshot_table(
    spark: SparkSession,
    inputs: Mapping[str, DataFrame],
    steps: Mapping[str, str | Mapping[str, object]],
    outputs: Sequence[str],
    path: str,
    partition_by: str | Sequence[str],
) -> DataFrame:
    """Snapshot steps into a table by partition.

    The first run writes the table; later runs replace the partitions that they have
    rows for and leave the others.
    """
    known = read_parquet(spark, path) is not None
    publish(snapshot_steps(inputs, steps, outputs), path, partition_by, mode="dynamic" if known else "swap")
    return spark.read.parquet(path)


@dataclass(frozen=True)
class Delivery:
    """An extract that was written, and what goes with it."""

    rows: DataFrame
    files: DataFrame
    totals: DataFrame
    dictionary: DataFrame


def deliver_extract(
    spark: SparkSession,
    spec: ExtractSpec,
    tables: Mapping[str, DataFrame],
    load_type: str,
    folder: str,
    export_date: str,
    sep: str | None = None,
    files: int | None = None,
) -> Delivery:
    """Run an extract, write it once, and describe the files that were written.

    ``sep`` makes it a delimited gzip extract, otherwise it is parquet.  The control
    tables read what was written, not the extract again.
    """
    path = f"{folder.rstrip('/')}/{spec.table}"
    rows = build_extract(spark, spec, tables, load_type, export_date)
    if sep is None:
        export_parquet(rows, path, files)
        written, kind = spark.read.parquet(path), "parquet"
    else:
        export_delimited(rows, path, sep, files)
        written, kind = read_delimited(spark, path, sep=sep), "delimited"
    lines = file_control(spark, path, spec.table, export_date, kind, sep or ",")
    return Delivery(written, lines, control_totals(lines), data_dictionary(rows, spec.table))


def id_map_table(
    spark: SparkSession,
    ids: Sequence[DataFrame],
    keys: Sequence[str],
    id_col: str,
    path: str,
    stamp_text: str,
    updates: Sequence[tuple[Mapping[str, DataFrame], Sequence[str], Sequence[str]]] = (),
    seed: int = 0,
) -> DataFrame:
    """Insert unseen ids into the id map at ``path``, apply ordered updates, publish.

    The map may not exist yet.  An update is (views, keys, columns); one that would
    change the number of entries fails the job before anything is published.
    """
    stamped = F.lit(stamp_text)
    out = id_map_insert(read_parquet(spark, path), all_ids(ids), keys, id_col, stamped, seed)
    for views, on, columns in updates:
        out = id_map_update(out, views, on, columns, stamped)
    publish(out, path)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class IdColumn:
    """A surrogate id: ``seed`` for the first id less one while the table has none.

    ``salt`` numbers keys in an order that does not show them; without it in key order.
    """

    name: str
    seed: int = 0
    salt: str | None = None


def external_ids_table(
    spark: SparkSession,
    incoming: DataFrame,
    keys: Sequence[str],
    ids: Sequence[IdColumn],
    path: str,
    stamp_text: str,
    where: str | None = None,
) -> tuple[DataFrame, int]:
    """Give every key that the table at ``path`` does not have its ids, and append it.

    Incoming rows (filtered) are reduced to distinct rows; rows of one key get the same
    ids, going on from the highest of each id column.  Columns that either side lacks are
    merged; rows without a value in an id column, because the column is new, are numbered
    after the new ones.  Keys are compared null-safe, so a NULL key comes in once.
    Without new rows and new columns nothing is written.  Returns the table and the
    number of new rows.
    """
    table = read_parquet(spark, path)
    rows = incoming if where is None else incoming.filter(where)
    fresh = durable(new_rows(rows.distinct(), table, keys, null_safe=True))
    count = fresh.count()  # of the rows that were just cut, not of their plan
    known = set() if table is None else {c.lower() for c in table.columns}
    added = [c for c in (*incoming.columns, *(i.name for i in ids)) if c.lower() not in known]
    if table is not None and not count and not added:
        return table, 0
    for column in ids:
        seed = column.seed if table is None or column.name not in table.columns else max_id(table, column.name, column.seed)
        if column.salt is None:
            fresh = dense_ids(fresh, keys, seed, column.name)
        else:
            fresh = shuffled_ids(fresh, keys, seed, column.name, column.salt)
    fresh = fresh.withColumn("insert_ts", F.lit(stamp_text))
    out = fresh if table is None else union_bag([table, fresh])
    for column in ids:
        if table is not None and (column.name in added or not table.filter(F.col(column.name).isNull()).isEmpty()):
            out = backfill_ids(durable(out), keys, column.name, column.seed)
    publish(out, path)
    return spark.read.parquet(path), count


def decrypt_feed(
    spark: SparkSession, files: Sequence[str], path: str, key: Column, columns: Sequence[str] = (), sep: str = "|"
) -> DataFrame:
    """Delimited files with encrypted columns (by default the first), decrypted under the same header.

    A text that the key does not open fails the job.
    """
    feed = read_by_header(spark, files, sep)
    secret = list(columns) or feed.columns[:1]
    plain = feed.withColumns({c: decrypt_text(F.col(f"`{c}`"), key) for c in secret})
    export_delimited(plain, path, sep, compression="none")
    return read_delimited(spark, path, sep=sep)


def collect_summaries_table(
    spark: SparkSession,
    files: str | Sequence[str],
    path: str,
    sep: str = ",",
    path_column: str = "Path",
    missing: str = "NA",
    out_sep: str = "|",
) -> DataFrame:
    """The summary files of many extracts as one delimited summary; their headers may differ."""
    rows = collect_summaries([read_by_header(spark, files, sep)], path_column, missing)
    export_delimited(rows, path, out_sep, files=1, compression="none")
    return read_delimited(spark, path, sep=out_sep)


def mapped_keys(rows: Sequence[MappingRow]) -> dict[str, list[str]]:
    """Key argument of the key-based strategies, from the mapping's primary rows."""
    return {"keys": primary_keys(rows)}
