"""Scans, feed selection and read scopes."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataload.catalog.frames import ORDERS_CTE, orders_tgt
from strataload.catalog.registry import Tables, query
from strataload.sources import scan, sink

TGT_COLUMNS = (
    "order_id, cust_id, status, total, order_date, hashkey, add_date, delete_date, last_modified_date, "
    "is_active, is_incremental"
)


@query("scan_parquet", "select * from orders union all select * from orders")
def scan_parquet(t: Tables):
    path = t.path("orders")
    return scan.read_parquet(t.spark, [path, path + ".missing", path])


@query(
    "scan_csv_roundtrip",
    "select cast(p_partkey as varchar) as p_partkey, p_name, p_brand, p_type, cast(p_size as varchar) as p_size from part",
)
def scan_csv_roundtrip(t: Tables):
    folder = sink.scratch_folder(t.spark)
    rows = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    sink.export_delimited(rows, folder, sep="|")
    return scan.read_delimited(t.spark, folder, sep="|")


@query("master_feed_distinct", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def master_feed_distinct(t: Tables):
    folder = sink.scratch_folder(t.spark)
    sink.export_delimited(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber"), folder)
    return scan.master_feed(t.spark, folder, infer=True)


@query("scan_active", f"with {ORDERS_CTE} select {TGT_COLUMNS} from orders_tgt where is_active = 1")
def scan_active(t: Tables):
    folder = sink.scratch_folder(t.spark)
    sink.publish(orders_tgt(t), folder, "is_active")
    return scan.active_rows(t.spark.read.parquet(folder))


@query(
    "scan_incremental",
    """select event_id, user_id, event_type, case when event_type = 'purchase' then 1 else 0 end as is_incremental
from events where event_type = 'purchase'""",
)
def scan_incremental(t: Tables):
    changed = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    return scan.incremental_rows(t.events.select("event_id", "user_id", "event_type", changed.alias("is_incremental")))


LATEST_SQL = """select user_id, event_type, event_id, add_date from (
  select user_id, event_type, event_id, ts as add_date,
         row_number() over (partition by user_id, event_type order by ts desc nulls last, event_id desc) as rn
  from events) x where rn = 1"""


def _events(t: Tables):
    return t.events.select("user_id", "event_type", "event_id", F.col("ts").alias("add_date"))


@query("scan_latest_per_key", LATEST_SQL)
def scan_latest_per_key(t: Tables):
    return scan.latest_per_key(_events(t), ["user_id", "event_type"], ties=["event_id"])


@query(
    "staging_all_string",
    """select cast(r_regionkey as varchar) as r_regionkey, r_name, cast(n_nationkey as varchar) as n_nationkey, n_name,
cast(c_custkey as varchar) as c_custkey from customer join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey""",
)
def staging_all_string(t: Tables):
    folder = sink.scratch_folder(t.spark)
    regions = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = regions.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"))
    columns = ["r_regionkey", "r_name", "n_nationkey", "n_name", "c_custkey"]
    sink.export_parquet(rows.select(*columns), f"{folder}/one")
    return scan.read_staging(t.spark, [f"{folder}/one"], kind="parquet")


@query(
    "scan_glob",
    """select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus from orders
union all select cast(o_orderkey as varchar), o_orderstatus from orders""",
)
def scan_glob(t: Tables):
    folder = sink.scratch_folder(t.spark)
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    for name in ("feed_2023", "feed_2024"):
        sink.publish(rows, f"{folder}/{name}")
    return scan.read_like(t.spark, folder, "feed_2024.parquet")


@query(
    "staging_mixed_headers",
    """select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
  null::varchar as o_orderpriority from orders where o_orderstatus = 'F'
union all select cast(o_orderkey as varchar), cast(o_custkey as varchar), o_orderstatus, null from orders where o_orderstatus = 'O'
union all select cast(o_orderkey as varchar), null, o_orderstatus, o_orderpriority from orders where o_orderstatus = 'P'""",
)
def staging_mixed_headers(t: Tables):
    """Three deliveries of one feed: as agreed, with columns in another order, with one left out and one added."""
    folder = sink.scratch_folder(t.spark)
    deliveries = {
        "F": ["o_orderkey", "o_custkey", "o_orderstatus"],
        "O": ["O_ORDERSTATUS", "o_custkey", "o_orderkey"],
        "P": ["o_orderpriority", "o_orderkey", "o_orderstatus"],
    }
    for status, columns in deliveries.items():
        rows = t.orders.filter(F.col("o_orderstatus") == status).select(*[F.col(c).alias(c) for c in columns])
        sink.export_delimited(rows, f"{folder}/{status}", sep="|", files=2)
    files = [r.path for r in scan.list_files(t.spark, folder).filter("path like '%.csv.gz'").select("path").collect()]
    return scan.read_staging(t.spark, files, sep="|")


@query(
    "select_feed_files",
    r"""with listing as (
  select concat('in/', replace(p_name, ' ', '__'), '_', cast(p_partkey as varchar), '.CSV') as path from part),
named as (
  select path, array_to_string(list_filter(string_split(regexp_replace(regexp_replace(
    lower(string_split(path, '/')[-1]), '\.csv$', ''), '\d', '', 'g'), '_'), lambda x: x <> ''), '_') as name from listing)
select path, 'fixed' as rule from named where name = 'red_ring'
union all select path, 'pattern' from named where contains(name, 'gear')""",
)
def select_feed_files(t: Tables):
    name = F.concat(
        F.lit("in/"), F.replace("p_name", F.lit(" "), F.lit("__")), F.lit("_"), F.col("p_partkey").cast("string"), F.lit(".CSV")
    )
    listing = t.part.select(name.alias("path"))
    fixed = scan.select_feed_files(listing, "Red_Ring2023", extension="csv", match="fixed")
    like = scan.select_feed_files(listing, "Gear", extension=".csv", match="pattern")
    return fixed.withColumn("rule", F.lit("fixed")).unionByName(like.withColumn("rule", F.lit("pattern")))


MANIFEST_CTE = """manifest as (
  select concat(' ', upper(c_mktsegment)) as src, case when c_nationkey < 12 then 'East ' else 'west' end as dataset,
         case when c_acctbal > 5000 then 'AC' else ' ai' end as data_source,
         case when c_acctbal > 0 then '1' else '0' end as is_file_available,
         concat('in/', cast(c_custkey as varchar)) as path
  from customer)"""


def _manifest(t: Tables):
    return t.customer.select(
        F.concat(F.lit(" "), F.upper("c_mktsegment")).alias("src"),
        F.when(F.col("c_nationkey") < 12, "East ").otherwise("west").alias("dataset"),
        F.when(F.col("c_acctbal") > 5000, "AC").otherwise(" ai").alias("data_source"),
        F.when(F.col("c_acctbal") > 0, "1").otherwise("0").alias("is_file_available"),
        F.concat(F.lit("in/"), F.col("c_custkey").cast("string")).alias("path"),
    )


@query(
    "required_inputs_missing",
    f"""with {MANIFEST_CTE}
select path, src, dataset, data_source, is_file_available from manifest m
where is_file_available = '1' and not exists (
  select 1 from orders where o_orderstatus = 'P' and o_orderpriority = '1-URGENT'
  and concat('in/', cast(o_custkey as varchar)) = m.path)""",
)
def required_inputs_missing(t: Tables):
    listing = t.orders.filter("o_orderstatus = 'P' and o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("in/"), F.col("o_custkey").cast("string")).alias("path")
    )
    return scan.required_missing(_manifest(t), listing)


@query(
    "manifest_filter",
    f"""with {MANIFEST_CTE}
select * from manifest where lower(trim(src)) = 'building' and lower(trim(dataset)) = 'east'
and lower(trim(data_source)) = 'ai'""",
)
def manifest_filter(t: Tables):
    return scan.manifest_filter(_manifest(t), "Building ", "EAST", "AI")


@query(
    "read_scope_full",
    f"""with {ORDERS_CTE},
latest as (select *, row_number() over (partition by cust_id order by add_date desc nulls last, order_id desc) as rn
           from orders_tgt)
select 'driving' as role, order_id, cust_id, is_active from orders_tgt
union all select 'other', order_id, cust_id, is_active from latest where rn = 1
union all select 'plain', order_id, cust_id, is_active from orders_tgt""",
)
def read_scope_full(t: Tables):
    tgt = orders_tgt(t)
    frames = {
        "driving": scan.read_scope(tgt, "full", "driving"),
        "other": scan.read_scope(tgt, "full", "other", keys=["cust_id"], ties=["order_id"]),
        "plain": scan.read_scope(tgt, "full", "other"),
    }
    return _roles(frames)


@query(
    "read_scope_incremental",
    f"""with {ORDERS_CTE}
select 'driving' as role, order_id, cust_id, is_active from orders_tgt where is_incremental = 1
union all select 'other', order_id, cust_id, is_active from orders_tgt where is_active = 1
union all select 'master', order_id, cust_id, is_active from orders_tgt""",
)
def read_scope_incremental(t: Tables):
    tgt = orders_tgt(t)
    roles = ("driving", "other", "master")
    return _roles({role: scan.read_scope(tgt, "incremental", role) for role in roles})


def _roles(frames):
    out = None
    for role, df in frames.items():
        part = df.select(F.lit(role).alias("role"), "order_id", "cust_id", "is_active")
        out = part if out is None else out.unionByName(part)
    return out
