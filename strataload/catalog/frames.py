"""Stand-ins for feeds and history tables, derived from the whole test tables.

Each frame has the same definition twice: as a DataFrame and as a SQL common
table expression.  Every row of the base table is used on both sides; the
difference between "yesterday" and "today" comes from attribute values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataload.audit import AuditSpec, row_hash
from strataload.catalog.registry import Tables

AUDIT = AuditSpec(batch_date=dt.date(2024, 2, 1), batch_ts=dt.datetime(2024, 2, 1))
ORDER_COLUMNS = ["order_id", "cust_id", "status", "total", "order_date"]
OPEN = dt.date(9999, 12, 31)

# --- two days of one table ---------------------------------------------------
# yesterday: low-priority orders had other numbers, high-priority ones status X,
# urgent ones a later date; status P is already closed history.

HASH_SQL = (
    "md5(concat_ws('-', coalesce(cast(cust_id as varchar),'-'), coalesce(cast(order_date as varchar),'-'), "
    "coalesce(cast(order_id as varchar),'-'), coalesce(status,'-'), coalesce(cast(total as varchar),'-')))"
)
ORDERS_CTE = f"""
orders_src as (
  select *, {HASH_SQL} as hashkey, date '2024-02-01' as add_date, date '9999-12-31' as delete_date,
         timestamp '2024-02-01 00:00:00' as last_modified_date, 1 as is_active, 1 as is_incremental
  from (select o_orderkey as order_id, o_custkey as cust_id, o_orderstatus as status,
               cast(o_totalprice as decimal(18,2)) as total, cast(o_orderdate as date) as order_date
        from orders) x),
orders_tgt as (
  select *, {HASH_SQL} as hashkey, date '2024-01-01' as add_date,
         case when old_status = 'P' then date '2024-01-15' else date '9999-12-31' end as delete_date,
         timestamp '2024-01-01 00:00:00' as last_modified_date,
         case when old_status = 'P' then 0 else 1 end as is_active, 1 as is_incremental
  from (select case when o_orderpriority = '5-LOW' then -1 - o_orderkey else o_orderkey end as order_id,
               o_custkey as cust_id,
               case when o_orderpriority = '2-HIGH' then 'X' else o_orderstatus end as status,
               cast(o_totalprice as decimal(18,2)) as total,
               cast(o_orderdate as date) + case when o_orderpriority = '1-URGENT' then 30 else 0 end as order_date,
               o_orderstatus as old_status
        from orders) x)"""


def _money(column: str):
    return F.col(column).cast("decimal(18,2)")


def orders_src(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        F.col("o_orderstatus").alias("status"),
        _money("o_totalprice").alias("total"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    return rows.withColumns(
        {
            "hashkey": row_hash(ORDER_COLUMNS),
            "add_date": F.lit(AUDIT.batch_date),
            "delete_date": F.lit(OPEN),
            "last_modified_date": AUDIT.now(),
            "is_active": F.lit(1),
            "is_incremental": F.lit(1),
        }
    )


def orders_tgt(t: Tables) -> DataFrame:
    priority, closed = F.col("o_orderpriority"), F.col("o_orderstatus") == "P"
    rows = t.orders.select(
        F.when(priority == "5-LOW", -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        F.when(priority == "2-HIGH", "X").otherwise(F.col("o_orderstatus")).alias("status"),
        _money("o_totalprice").alias("total"),
        F.date_add(F.col("o_orderdate").cast("date"), F.when(priority == "1-URGENT", 30).otherwise(0)).alias(
            "order_date"
        ),
        closed.alias("_closed_before"),
    )
    before = F.col("_closed_before")
    return rows.withColumns(
        {
            "hashkey": row_hash(ORDER_COLUMNS),
            "add_date": F.lit(dt.date(2024, 1, 1)),
            "delete_date": F.when(before, F.lit(dt.date(2024, 1, 15))).otherwise(F.lit(OPEN)),
            "last_modified_date": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
            "is_active": F.when(before, 0).otherwise(1),
            "is_incremental": F.lit(1),
        }
    ).drop("_closed_before")


# --- keys to deactivate, under other names -----------------------------------

DEACT_CTE = """
deact as (select l_orderkey as dk, lower(l_linestatus) as ds from lineitem where l_returnflag = 'A')"""


def deact_feed(t: Tables) -> DataFrame:
    return t.lineitem.filter("l_returnflag = 'A'").select(
        F.col("l_orderkey").alias("dk"), F.lower("l_linestatus").alias("ds")
    )


# --- validity intervals ------------------------------------------------------
# every customer has a first version; household customers have no current one.

CUST_CTE = """
cust_versions as (
  select c_custkey as cust_id, 1 as version, upper(c_mktsegment) as segment, date '1990-01-01' as add_date,
         date '1998-06-30' as delete_date, 0 as is_active from customer
  union all
  select c_custkey, 2, c_name, date '1998-07-01', date '9999-12-31', 1
  from customer where c_mktsegment <> 'HOUSEHOLD')"""


def cust_versions(t: Tables) -> DataFrame:
    def version(rows, number, segment, start, end, active):
        return rows.select(
            F.col("c_custkey").alias("cust_id"),
            F.lit(number).alias("version"),
            segment.alias("segment"),
            F.lit(start).alias("add_date"),
            F.lit(end).alias("delete_date"),
            F.lit(active).alias("is_active"),
        )

    first = version(t.customer, 1, F.upper("c_mktsegment"), dt.date(1990, 1, 1), dt.date(1998, 6, 30), 0)
    current = t.customer.filter("c_mktsegment <> 'HOUSEHOLD'")
    return first.unionByName(version(current, 2, F.col("c_name"), dt.date(1998, 7, 1), OPEN, 1))


# --- caret lists and wildcard codes ------------------------------------------

CODES_CTE = """
codes as (select p_partkey as row_id,
                 concat_ws('^', p_type, p_brand, case when p_size > 40 then null else p_name end) as code_list
          from part),
code_lookup as (select distinct concat(p_brand, '*') as pattern, 'brand' as kind from part where p_size > 45
                union
                select distinct concat(split_part(p_name, ' ', 1), '*'), 'name' from part where p_brand = 'Brand#7'
                union
                select distinct p_type, 'type' from part where p_type like '%O%')"""


def codes(t: Tables) -> DataFrame:
    name = F.when(F.col("p_size") > 40, None).otherwise(F.col("p_name"))
    return t.part.select(F.col("p_partkey").alias("row_id"), F.concat_ws("^", "p_type", "p_brand", name).alias("code_list"))


def code_lookup(t: Tables) -> DataFrame:
    def kind(rows, pattern, name):
        return rows.select(pattern.alias("pattern"), F.lit(name).alias("kind"))

    brands = kind(t.part.filter("p_size > 45"), F.concat("p_brand", F.lit("*")), "brand")
    names = kind(
        t.part.filter("p_brand = 'Brand#7'"), F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit("*")), "name"
    )
    types = kind(t.part.filter("p_type like '%O%'"), F.col("p_type"), "type")
    return brands.unionByName(names).unionByName(types).distinct()


# --- names with restricted patterns ------------------------------------------

NAMES_CTE = """
names as (select c_custkey as id, c_mktsegment as plan_name,
                 case when c_acctbal < 0 then null when c_acctbal > 9000 then ' ' else c_name end as payer_name
          from customer),
restricted as (select 'pattern' as match_type, concat(cast(n_nationkey as varchar), '7') as name_pattern,
                      n_regionkey + 10 as priority,
                      concat('PLAN ', n_name, ' <x>') as plan_name, concat('ORG ', n_name, ' <x>') as organization_name
               from nation
               union all
               select 'exact', 'BUILDING', 2, 'PLAN <x>', cast(null as varchar)
               union all
               select 'pattern', 'machin', 1, 'PLAN1 <x>', 'ORG1 <x>')"""


def names(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("plan_name"),
        F.when(balance < 0, None).when(balance > 9000, " ").otherwise(F.col("c_name")).alias("payer_name"),
    )


def restricted(t: Tables) -> DataFrame:
    by_nation = t.nation.select(
        F.lit("pattern").alias("match_type"),
        F.concat(F.col("n_nationkey").cast("string"), F.lit("7")).alias("name_pattern"),
        (F.col("n_regionkey") + 10).alias("priority"),
        F.concat(F.lit("PLAN "), "n_name", F.lit(" <x>")).alias("plan_name"),
        F.concat(F.lit("ORG "), "n_name", F.lit(" <x>")).alias("organization_name"),
    )
    fixed = t.spark.createDataFrame(
        [("exact", "BUILDING", 2, "PLAN <x>", None), ("pattern", "machin", 1, "PLAN1 <x>", "ORG1 <x>")],
        by_nation.schema,
    )
    return by_nation.unionByName(fixed)


# --- the same member in several sources --------------------------------------
# source = order status and first digit of the priority; O1 is the master.

SOURCES_CTE = """
multi_source as (select o_custkey as member_id, concat(o_orderstatus, substr(o_orderpriority, 1, 1)) as data_source_id,
                        min(cast(o_orderdate as date)) as first_date, cast(max(o_totalprice) as decimal(18,2)) as best
                 from orders group by 1, 2)"""


def multi_source(t: Tables) -> DataFrame:
    return t.orders.groupBy(
        F.col("o_custkey").alias("member_id"),
        F.concat("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("data_source_id"),
    ).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("first_date"),
        F.max("o_totalprice").cast("decimal(18,2)").alias("best"),
    )
