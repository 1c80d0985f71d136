"""Published tables, extracts, patches, snapshots and control tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataload.catalog.frames import ORDERS_CTE, orders_src, orders_tgt
from strataload.catalog.registry import Tables, query
from strataload.functions.scalar import encrypt_text
from strataload.operators import dedupe
from strataload.plans import extract, jobs
from strataload.plans.extract import ExtractField, ExtractSpec
from strataload.sources import cluster, scan, sink, versions

DAY = "2024-02-01"


@query(
    "partitioned_write",
    """select o_orderkey, o_custkey, case when o_orderstatus = 'F' then 'new' else 'old' end as state, o_orderstatus
from orders""",
)
def partitioned_write(t: Tables):
    folder = sink.scratch_folder(t.spark)
    rows = t.orders.select("o_orderkey", "o_custkey", F.lit("old").alias("state"), "o_orderstatus")
    sink.publish(rows, folder, "o_orderstatus, not_there")
    changed = rows.filter("o_orderstatus = 'F'").withColumn("state", F.lit("new"))
    sink.publish(changed, folder, "o_orderstatus", mode="dynamic")
    return t.spark.read.parquet(folder)


@query(
    "partition_restore",
    """select o_orderkey, case when o_orderstatus = 'P' then 1 else 2 end as version, o_orderstatus from orders""",
)
def partition_restore(t: Tables):
    folder = sink.scratch_folder(t.spark)
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    sink.publish(rows.withColumn("version", F.lit(1)), f"{folder}/backup", "o_orderstatus")
    sink.publish(rows.withColumn("version", F.lit(2)), f"{folder}/live", "o_orderstatus")
    sink.restore_partition(t.spark, f"{folder}/backup", f"{folder}/live", "o_orderstatus", "P")
    return t.spark.read.parquet(f"{folder}/live")


@query(
    "extract_delimited_roundtrip",
    """select cast(event_id as varchar) as event_id, event_type, props, strftime(ts, '%Y-%m-%d') as day from events""",
)
def extract_delimited_roundtrip(t: Tables):
    folder = sink.scratch_folder(t.spark)
    rows = t.events.select("event_id", "event_type", "props", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    sink.export_delimited(rows, f"{folder}/csv", sep="|", files=3)
    sink.delimited_to_parquet(t.spark, f"{folder}/csv", f"{folder}/parquet", sep="|")
    return t.spark.read.parquet(f"{folder}/parquet")


@query(
    "snapshot_key_export",
    """select cast(l_orderkey as varchar) as ORDER_ID, cast(l_linenumber as varchar) as LINE from lineitem
where cast(l_shipdate as date) = (select max(cast(l_shipdate as date)) from lineitem)""",
)
def snapshot_key_export(t: Tables):
    folder = sink.scratch_folder(t.spark)
    rows = t.lineitem.withColumn("snapshot_date", F.col("l_shipdate").cast("date"))
    last = rows.agg(F.max("snapshot_date")).first()[0]
    columns = {"l_orderkey": "ORDER_ID", "l_linenumber": "LINE"}
    sink.export_snapshot(rows, folder, columns, "snapshot_date", last)
    return scan.read_delimited(t.spark, folder)


@query(
    "dedupe_patch",
    f"""with {ORDERS_CTE}, marked as (select * replace (case when total < 60000 then null else is_active end as is_active) from orders_tgt),
act as (select * from marked where is_active = 1),
fixes as (select order_id, 'D' as status, first_date as order_date from (
    select order_id, cust_id, min(order_date) over (partition by cust_id) as first_date, status from act) x where status = 'X'
  union all select order_id, 'E', date '2000-01-01' from act where status = 'F')
select a.order_id, a.cust_id, a.total, a.hashkey, a.add_date, a.delete_date, a.last_modified_date, a.is_active,
  a.is_incremental, f.status, f.order_date from act a left join fixes f on a.order_id = f.order_id
union all select order_id, cust_id, total, hashkey, add_date, delete_date, last_modified_date, is_active,
  is_incremental, status, order_date from marked where is_active = 0 or is_active is null""",
)
def dedupe_patch(t: Tables):
    scripts = [
        {
            "firsts": "select cust_id, min(order_date) as first_date from {orders} group by cust_id",
            "fix": """select o.order_id, 'D' as status, f.first_date as order_date from {orders} o
                      join {firsts} f on o.cust_id = f.cust_id where o.status = 'X'""",
        },
        {"fix": "select order_id, 'E' as status, date '2000-01-01' as order_date from {orders} where status = 'F'"},
    ]
    unknown = F.when(F.col("total") < 60000, F.lit(None)).otherwise(F.col("is_active"))
    return dedupe.dedupe_patch(orders_tgt(t).withColumn("is_active", unknown), "orders", scripts, ["order_id"])


@query(
    "snapshot_steps",
    f"""with {ORDERS_CTE}
select cust_id, count(*) as n, 'open' as snapshot, '2024' as year from orders_src where status = 'O' group by cust_id
union all select cust_id, count(*), 'all', null from orders_src group by cust_id""",
)
def snapshot_steps(t: Tables):
    steps = {
        "open_orders": "select cust_id, count(*) as n from {orders} where status = 'O' group by cust_id",
        "upd_open": {"Snapshot": "open", "year": "2024"},
        "every": "select cust_id, count(*) as n from {orders} group by cust_id",
        "upd_every": {"snapshot": "all"},
    }
    return dedupe.snapshot_steps({"orders": orders_src(t)}, steps, ["open_orders", "every"])


SPEC = ExtractSpec(
    table="orders",
    alias="o",
    template=(
        "select <included_fields> from <extract_source_schema>.<table:$1> <table:$2> "
        "left join <extract_lookup_schema>.<source:$1>.customer c on o.cust_id = c.c_custkey\nWHERE\to.add_date <= <add_date>"
    ),
    fields=(
        ExtractField("status", "varchar", length="(1)", order=3),
        ExtractField("order_id", "bigint", "ORDER_NO", order=1),
        ExtractField("total", "decimal", length="(18,1)", order=2),
        ExtractField("c_name", sql="concat(c.c_mktsegment, ':', c.c_name)", new_name="member", order=4),
        ExtractField("order_date", "time", "order_month", format="yyyyMM", order=5),
        ExtractField("kind", sql="case when 'varchar' = concat('var', 'char') then 'varchar' end", order=6),
        ExtractField("short", sql="cast(o.status as varchar(20))", order=7),
    ),
    filter_full="o.status <> 'P'",
    filter_incremental="o.is_incremental = 1 and o.status = 'F'",
    sources=("crm",),
)


def _extract(t: Tables, load_type: str):
    flagged = orders_src(t).withColumn("EXCLUDE_PER_DID", F.when(F.col("total") < 20000, 1))
    return extract.build_extract(t.spark, SPEC, {"orders": flagged, "crm_customer": t.customer}, load_type, DAY)


EXTRACT_SQL = """with {cte}
select order_id as ORDER_NO, cast(total as decimal(18,1)) as total, status, c_mktsegment || ':' || c_name as member,
  strftime(order_date, '%Y%m') as order_month, 'varchar' as kind, status as short
from orders_src o left join customer c on o.cust_id = c.c_custkey where total >= 20000 and {where}"""


@query("extract_full", EXTRACT_SQL.format(cte=ORDERS_CTE, where="status <> 'P'"))
def extract_full(t: Tables):
    return _extract(t, "full")


@query("extract_incremental", EXTRACT_SQL.format(cte=ORDERS_CTE, where="is_incremental = 1 and status = 'F'"))
def extract_incremental(t: Tables):
    return _extract(t, "incremental")


@query(
    "job_extract",
    EXTRACT_SQL.format(cte=ORDERS_CTE, where="status <> 'P'")
    .replace("with ", "with rows_ as (with ", 1)
    + f""") select 'orders/' as Path, count(*) as Row_Count, '{DAY}' as Export_Date, cast(2 as bigint) as File_Count,
  7 as columns from rows_""",
)
def job_extract(t: Tables):
    flagged = orders_src(t).withColumn("EXCLUDE_PER_DID", F.when(F.col("total") < 20000, 1))
    tables = {"orders": flagged, "crm_customer": t.customer}
    out = jobs.deliver_extract(t.spark, SPEC, tables, "full", sink.scratch_folder(t.spark), DAY, sep="|", files=2)
    return out.totals.withColumn("columns", F.lit(len(out.rows.columns)))


@query(
    "job_snapshot",
    """select o_custkey as cust_id, o_orderstatus as status, count(*) as n,
  case when o_orderstatus = 'O' then 'second' else 'first' end as run from orders group by 1, 2""",
)
def job_snapshot(t: Tables):
    """Two runs: the second has rows for one partition only and leaves the others."""
    folder = sink.scratch_folder(t.spark)
    rows = orders_src(t)
    count = "select cust_id, status, count(*) as n from {orders} group by cust_id, status"
    for run, inputs in (("first", rows), ("second", rows.filter("status = 'O'"))):
        steps = {"counts": count, "mark": {"run": run}}
        out = jobs.snapshot_table(t.spark, {"orders": inputs}, steps, ["counts"], folder, "status")
    return out


@query(
    "job_dedupe",
    f"""with {ORDERS_CTE}, act as (select * from orders_tgt where is_active = 1)
select a.order_id, a.is_active, case when a.status = 'X' then 'D' end as status from act a
union all select order_id, is_active, status from orders_tgt where is_active = 0""",
)
def job_dedupe(t: Tables):
    scripts = [{"fix": "select order_id, 'D' as status from {orders} where status = 'X'"}]
    folder = sink.scratch_folder(t.spark)
    out = jobs.dedupe_table(t.spark, orders_tgt(t), "orders", scripts, ["order_id"], folder, partition_by="is_active")
    return out.select("order_id", "is_active", "status")


@query(
    "data_dictionary",
    """select * from (values ('orders_out/', 'ORDER_NO', 'bigint'), ('orders_out/', 'total', 'decimal(18,1)'),
  ('orders_out/', 'status', 'string'), ('orders_out/', 'member', 'string'), ('orders_out/', 'order_month', 'string'),
  ('orders_out/', 'kind', 'string'), ('orders_out/', 'short', 'string'))
  v(folder, field_name, data_type)""",
)
def data_dictionary(t: Tables):
    folder = sink.scratch_folder(t.spark)
    sink.export_parquet(_extract(t, "full"), folder)
    return extract.data_dictionary(t.spark.read.parquet(folder), "orders_out")


FILES = ("orders", "lineitem", "documents", "events")


def file_lines(t: Tables):
    """File control lines of the given tables."""
    out = None
    for name in FILES:
        lines = extract.file_control(t.spark, t.path(name), name, DAY)
        out = lines if out is None else out.unionByName(lines)
    return out


@query(
    "file_control_table",
    " union all ".join(
        f"select '{n}/' as Path, '{n}.parquet' as file_name, true as has_size, '{DAY}' as export_date, "
        f"count(*) as row_counts from {n}"
        for n in FILES
    ),
)
def file_control_table(t: Tables):
    return file_lines(t).withColumn("has_size", F.col("size_KB") > F.col("row_counts")).drop("size_KB")


def partitioned_lines(t: Tables):
    """File control lines of a table whose one writing task wrote a file into every partition."""
    folder = sink.scratch_folder(t.spark)
    sink.publish(t.orders.select("o_orderkey", "o_orderstatus"), folder, "o_orderstatus", files=1)
    return extract.file_control(t.spark, folder, "orders", DAY)


@query(
    "file_control_partitioned",
    f"""select 'orders/' as Path, 'o_orderstatus=' || o_orderstatus as folder, '{DAY}' as export_date,
  count(*) as row_counts from orders group by o_orderstatus""",
)
def file_control_partitioned(t: Tables):
    return partitioned_lines(t).select(
        "Path", F.substring_index("file_name", "/", 1).alias("folder"), "export_date", "row_counts"
    )


@query(
    "control_totals_partitioned",
    f"""select 'orders/' as Path, count(*) as Row_Count, '{DAY}' as Export_Date,
  count(distinct o_orderstatus) as File_Count from orders""",
)
def control_totals_partitioned(t: Tables):
    return extract.control_totals(partitioned_lines(t))


TOTALS_SQL = " union all ".join(
    f"select '{n}/' as Path, count(*) as Row_Count, '{DAY}' as Export_Date, cast(1 as bigint) as File_Count from {n}"
    for n in FILES
)


@query("control_totals", TOTALS_SQL)
def control_totals(t: Tables):
    return extract.control_totals(file_lines(t))


@query(
    "control_totals_v2",
    f"""select rtrim(Path, '/') as EXTRACT_TABLE_NAME, 'out/20240201/' as EXTRACT_FOLDER_PATH, Export_Date as EXPORT_DATE,
 File_Count as FILE_COUNT, Row_Count as RECORD_COUNT, '20240201' as DATA_VERSION, 'NA' as SCHEMA_NAME, 'full' as LOAD_TYPE,
 'NA' as LOAD_FUNCTION, 'order_id' as ZORDER_BY from ({TOTALS_SQL}) x""",
)
def control_totals_v2(t: Tables):
    return extract.control_totals_v2(file_lines(t), "out/20240201", "20240201", "full", zorder_by="order_id")


@query(
    "collect_summaries",
    f"""select rtrim(Path, '/') as Path, Row_Count, Export_Date, File_Count, 'NA' as note from ({TOTALS_SQL}) x
union all select 'labels', count(*), '{DAY}', 1, 'late' from labels""",
)
def collect_summaries(t: Tables):
    late = extract.control_totals(extract.file_control(t.spark, t.path("labels"), "labels", DAY))
    frames = [extract.control_totals(file_lines(t)), late.withColumn("note", F.lit("late"))]
    return extract.collect_summaries(frames, missing="NA")


@query("versioned_publish", "select o_orderkey, o_orderstatus, 1 as version from orders")
def versioned_publish(t: Tables):
    """The first of two versions, read after the second one was published."""
    path = sink.scratch_folder(t.spark)
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    versions.versioned_publish(rows.withColumn("version", F.lit(1)), path, "o_orderstatus")
    versions.versioned_publish(rows.filter("o_orderstatus = 'F'").withColumn("version", F.lit(2)), path, "o_orderstatus")
    return versions.read_version(t.spark, path, 1)


@query(
    "read_version",
    "select o_orderkey, o_orderstatus, case when o_orderstatus = 'P' then 1 else 2 end as version from orders",
)
def read_version(t: Tables):
    """The newest version after one partition was set back to an earlier one."""
    path = sink.scratch_folder(t.spark)
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    for number in (1, 2):
        versions.versioned_publish(rows.withColumn("version", F.lit(number)), path, "o_orderstatus")
    versions.restore_version(t.spark, path, 1, "o_orderstatus", "P")
    return versions.read_version(t.spark, path)


@query(
    "fixed_file_count",
    "select o_orderstatus, count(*) as n, 3 as files from orders group by o_orderstatus",
)
def fixed_file_count(t: Tables):
    path = sink.scratch_folder(t.spark)
    sink.publish(t.orders.select("o_orderkey", "o_orderstatus"), path, files=3)
    written = t.spark.read.parquet(path).withColumn("file", F.col("_metadata.file_name"))
    files = written.agg(F.countDistinct("file").alias("files")).scalar()
    return written.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("files", files.cast("int"))


@query("copy_table", "select o_orderkey, o_orderstatus, o_custkey from orders")
def copy_table(t: Tables):
    folder = sink.scratch_folder(t.spark)
    sink.publish(t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"), f"{folder}/one")
    sink.copy_table(t.spark, f"{folder}/one", f"{folder}/two", "o_orderstatus")
    return t.spark.read.parquet(f"{folder}/two")


@query(
    "cleanse_pass_through",
    f"""with {ORDERS_CTE} select order_id, cust_id as member, status, total, order_date, hashkey, add_date, delete_date,
  last_modified_date, is_active, is_incremental from orders_tgt where is_active = 1""",
)
def cleanse_pass_through(t: Tables):
    """A table without rules: its rows in scope under standard names."""
    target = jobs.Target(sink.scratch_folder(t.spark), partition_by="is_active")
    return jobs.cleanse_table(t.spark, orders_tgt(t), "orders", [], {}, target, "active", names={"cust_id": "member", "status": " "})


@query(
    "clustered_write",
    """select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem
where l_partkey between 10 and 40""",
)
def clustered_write(t: Tables):
    """Rows of one part of a table that was written in the order of two columns at once."""
    path = sink.scratch_folder(t.spark)
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    cluster.clustered_write(rows, path, ["l_orderkey", "l_partkey"], files=16)
    return cluster.read_clustered(t.spark, path, {"l_partkey": (10, 40)})


@query("decrypt_feed", "select c_name, cast(c_custkey as varchar) as c_custkey, c_mktsegment from customer")
def decrypt_feed(t: Tables):
    folder, key = sink.scratch_folder(t.spark), F.lit("example-key-0001")
    rows = t.customer.select(encrypt_text(F.col("c_name"), key).alias("c_name"), "c_custkey", "c_mktsegment")
    sink.export_delimited(rows, f"{folder}/raw", sep="|")
    return jobs.decrypt_feed(t.spark, [f"{folder}/raw"], f"{folder}/cur", key)


@query(
    "job_collect_summaries",
    """select o_orderstatus as "Table", cast(count(*) as varchar) as "Rows", concat('out/', o_orderstatus) as "Path", 'NA' as "Note"
from orders group by o_orderstatus
union all select c_mktsegment, cast(count(*) as varchar), 'NA', concat('n', max(c_nationkey)) from customer group by c_mktsegment""",
)
def job_collect_summaries(t: Tables):
    """Summaries of two extracts, one without a path and with a note."""
    folder, rows = sink.scratch_folder(t.spark), F.count(F.lit(1)).alias("Rows")
    path = F.concat(F.lit("out/"), F.max("o_orderstatus"), F.lit("//")).alias("Path")
    one = t.orders.groupBy(F.col("o_orderstatus").alias("Table")).agg(rows, path)
    two = t.customer.groupBy(F.col("c_mktsegment").alias("Table")).agg(F.concat(F.lit("n"), F.max("c_nationkey")).alias("Note"), rows)
    sink.export_delimited(one, f"{folder}/in/one", files=1)
    sink.export_delimited(two, f"{folder}/in/two", files=1)
    return jobs.collect_summaries_table(t.spark, f"{folder}/in/*/*.csv.gz", f"{folder}/out")
