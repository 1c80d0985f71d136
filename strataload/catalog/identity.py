"""Surrogate ids, id maps and master records."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataload.catalog.frames import AUDIT, SOURCES_CTE, multi_source
from strataload.catalog.registry import Tables, query
from strataload.operators import identity, lookup, mastering, quality
from strataload.plans import jobs, mapping
from strataload.plans.jobs import IdColumn
from strataload.plans.mapping import MappingRow
from strataload.sources import sink

STAMP = "2024-02-01 00:00:00"


@query(
    "all_ids_union",
    f"""select *, '{STAMP}' as insert_ts from (
  select cast(o_custkey as varchar) as member, cast(null as varchar) as vendor from orders
  union select cast(c_custkey as varchar), null from customer
  union select null, cast(l_suppkey as varchar) from lineitem) x""",
)
def all_ids_union(t: Tables):
    def mapped(table: str, member: str = "", vendor: str = ""):
        rows = [MappingRow("member", table, member, datatype="varchar"), MappingRow("vendor", table, vendor)]
        return mapping.apply_mapping({table: getattr(t, table)}, rows)

    frames = [mapped("orders", "o_custkey"), mapped("customer", "c_custkey"), mapped("lineitem", vendor="l_suppkey")]
    return identity.all_ids(frames, F.lit(STAMP))


@query(
    "id_map_insert",
    f"""with id_map as (select c_custkey as member, c_custkey + 1000 as member_id, '2023' as insert_ts, '2023' as update_ts
                from customer where c_mktsegment <> 'BUILDING'),
incoming as (select distinct o_custkey as member from orders)
select * from id_map union all
select member, (select max(member_id) from id_map) + row_number() over (order by member), '{STAMP}', '{STAMP}'
from incoming i where not exists (select 1 from id_map m where m.member = i.member)""",
)
def id_map_insert(t: Tables):
    known = t.customer.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("member"),
        (F.col("c_custkey") + 1000).alias("member_id"),
        F.lit("2023").alias("insert_ts"),
        F.lit("2023").alias("update_ts"),
    )
    incoming = t.orders.select(F.col("o_custkey").alias("member"))
    return identity.id_map_insert(known, incoming, ["member"], "member_id", F.lit(STAMP))


@query(
    "surrogate_ids_append",
    """with dict as (select n_nationkey + 1 as id, n_name as name from nation
              union all select 100, p_name from part where p_size > 49 group by p_name),
incoming as (select distinct p_name as name from part union
             select case when c_acctbal < 0 then null else c_mktsegment end from customer)
select * from dict union all
select (select max(id) from dict) + row_number() over (order by name nulls first), name from incoming i
where not exists (select 1 from dict d where d.name is not distinct from i.name)""",
)
def surrogate_ids_append(t: Tables):
    large = t.part.filter("p_size > 49").select(F.lit(100).cast("long").alias("id"), F.col("p_name").alias("name"))
    known = t.nation.select((F.col("n_nationkey") + 1).cast("long").alias("id"), F.col("n_name").alias("name"))
    known = known.unionByName(large.distinct())
    segment = t.customer.select(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("name"))
    incoming = t.part.select(F.col("p_name").alias("name")).unionByName(segment).distinct()
    return identity.append_ids(known, incoming, ["name"], "id")


@query(
    "id_map_update",
    f"""with id_map as (
  select c_custkey as member, c_mktsegment as segment, c_name as label, c_nationkey as nation, '2023' as update_ts
  from customer),
late as (select o_custkey as member, max(o_orderpriority) as segment from orders where o_orderstatus = 'P' group by 1),
early as (select o_custkey as member, min(o_orderpriority) as segment, max(o_orderstatus) as label from orders group by 1)
select distinct m.member, coalesce(l.segment, e.segment, m.segment) as segment, coalesce(e.label, m.label) as label, nation,
  '{STAMP}' as update_ts
from id_map m left join late l on m.member = l.member left join early e on m.member = e.member""",
)
def id_map_update(t: Tables):
    known = t.customer.select(
        F.col("c_custkey").alias("member"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_name").alias("label"),
        F.col("c_nationkey").alias("nation"),
        F.lit("2023").alias("update_ts"),
    )
    by_member = F.col("o_custkey").alias("member")
    late = t.orders.filter("o_orderstatus = 'P'").groupBy(by_member).agg(F.max("o_orderpriority").alias("segment"))
    early = t.orders.groupBy(by_member).agg(
        F.min("o_orderpriority").alias("segment"), F.max("o_orderstatus").alias("label")
    )
    views = {"late": late, "early": early}
    return identity.id_map_update(known, views, ["member"], ["segment", "label"], F.lit(STAMP))


@query(
    "job_id_map",
    f"""with one as (select distinct cast(c_custkey as varchar) as member from customer where c_acctbal < 5000),
first as (select member, dense_rank() over (order by member) as id from one),
late as (select distinct cast(c_custkey as varchar) as member from customer
         where cast(c_custkey as varchar) not in (select member from one)),
both_ as (select member, id, 'day1' as insert_ts from first union all
  select member, (select count(*) from first) + dense_rank() over (order by member), 'day2' from late)
select b.member, b.id, b.insert_ts, 'day2' as update_ts from both_ b""",
)
def job_id_map(t: Tables):
    """Two days: the first makes the map, the second adds members and keeps every number."""
    path = sink.scratch_folder(t.spark)
    member = F.col("c_custkey").cast("string").alias("member")
    poor, every = t.customer.filter("c_acctbal < 5000").select(member), t.customer.select(member)
    jobs.id_map_table(t.spark, [poor], ["member"], "id", path, "day1")
    no_change = every.distinct().withColumn("id", F.lit(None).cast("long"))
    updates = [({"none": no_change}, ["member"], ["id"])]
    return jobs.id_map_table(t.spark, [every, poor], ["member"], "id", path, "day2", updates)


@query(
    "dense_surrogate_ids",
    """select event_id, event_type, user_id, 100 + dense_rank() over (order by event_type, user_id) as pair_id from events""",
)
def dense_surrogate_ids(t: Tables):
    return identity.dense_ids(t.events.select("event_id", "event_type", "user_id"), ["event_type", "user_id"], 100, "pair_id")


@query("shuffled_surrogate_ids")
def shuffled_surrogate_ids(t: Tables):
    rows = t.customer.select("c_custkey", "c_mktsegment")
    return identity.shuffled_ids(rows, ["c_custkey"], 0, "external_id", salt="strataload")


@query(
    "shuffled_ids_invariants",
    """select count(*) as n, count(distinct c_custkey) as members, count(distinct c_custkey) as ids, cast(1 as bigint) as low,
  count(distinct c_custkey) as high, true as mixed from customer""",
)
def shuffled_ids_invariants(t: Tables):
    """What holds for any order of the ids: no gap, no repeat, and not the order of the keys."""
    ids = shuffled_surrogate_ids(t)
    moved = F.count_if(F.col("external_id") != F.col("c_custkey"))
    return ids.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("c_custkey").alias("members"),
        F.count_distinct("external_id").alias("ids"),
        F.min("external_id").alias("low"),
        F.max("external_id").alias("high"),
        (moved * 2 > F.count(F.lit(1))).alias("mixed"),
    )


@query(
    "backfill_null_ids",
    """with base as (select c_custkey, c_name, case when c_acctbal > 0 then c_custkey + 10 end as ext from customer)
select c_custkey, c_name, ext from base where ext is not null union all
select c_custkey, c_name, (select max(ext) from base) + dense_rank() over (order by c_name) from base where ext is null""",
)
def backfill_null_ids(t: Tables):
    rows = t.customer.select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_custkey") + 10).alias("ext")
    )
    return identity.backfill_ids(rows, ["c_name"], "ext")


@query(
    "assign_common_ids",
    """select o_orderkey, o_custkey, c.c_name as member_name, c.c_mktsegment as member_segment, b.c_name as building_name
from orders o left join customer c on o.o_custkey = c.c_custkey
left join (select * from customer where c_mktsegment = 'BUILDING') b on o.o_custkey = b.c_custkey""",
)
def assign_common_ids(t: Tables):
    lookups = {"members": t.customer, "builders": t.customer.filter("c_mktsegment = 'BUILDING'")}
    on = {"o_custkey": "c_custkey"}
    specs = [
        ("members", on, "c_name", "member_name"),
        ("builders", on, "c_name", "building_name"),
        ("members", on, "c_mktsegment", "member_segment"),
    ]
    return lookup.assign_from_lookups(t.orders.select("o_orderkey", "o_custkey"), lookups, specs)


# --- master records ------------------------------------------------------------------

MASTER, CHILDREN = "O1", ["P1", "F3", "F1"]
CREATED_CTE = """
children as (select 'P1' as child, 1 as place union all select 'F3', 2 union all select 'F1', 3),
created as (select member_id, 'O1' as data_source_id, first_date, best from (
  select b.*, rank() over (partition by b.member_id order by c.place) as rk
  from multi_source b join children c on lower(b.data_source_id) = lower(c.child)
  where not exists (select 1 from multi_source m where lower(m.data_source_id) = 'o1' and m.member_id = b.member_id)) x
  where rk = 1),
combined as (select * from multi_source union select * from created)"""


@query("master_waterfall", f"with {SOURCES_CTE}, {CREATED_CTE} select * from combined")
def master_waterfall(t: Tables):
    return mastering.master_waterfall(multi_source(t), MASTER, CHILDREN, ["member_id"], "data_source_id")


UPDATE_CTE = """
v1 as (select member_id, min(best) as best from multi_source where data_source_id like 'P%' group by 1),
v2 as (select member_id, max(best) as best, min(first_date) as first_date from multi_source group by 1),
masters as (select b.member_id, b.data_source_id, coalesce(v2.first_date, b.first_date) as first_date,
                   coalesce(v1.best, v2.best, b.best) as best
            from combined b left join v1 on b.member_id = v1.member_id left join v2 on b.member_id = v2.member_id
            where lower(b.data_source_id) = 'o1')"""


def _views(t: Tables):
    base = multi_source(t)
    v1 = base.filter("data_source_id like 'P%'").groupBy("member_id").agg(F.min("best").alias("best"))
    v2 = base.groupBy("member_id").agg(F.max("best").alias("best"), F.min("first_date").alias("first_date"))
    return {"v1": v1, "v2": v2}


@query(
    "cross_update",
    f"""with {SOURCES_CTE}, {CREATED_CTE}, {UPDATE_CTE}
select * from masters union all select * from multi_source where lower(data_source_id) <> 'o1'""",
)
def cross_update(t: Tables):
    return mastering.with_masters(
        multi_source(t),
        MASTER,
        CHILDREN,
        ["member_id"],
        "data_source_id",
        _views(t),
        ["member_id"],
        ["best", "first_date"],
    )


LIST_SQL = """(select member_id, string_agg(data_source_id, ',' order by data_source_id) as data_source_id_list
  from combined group by member_id)"""


def _listed(t: Tables):
    combined = mastering.master_waterfall(multi_source(t), MASTER, CHILDREN, ["member_id"], "data_source_id")
    return mastering.source_list(combined, ["member_id"], "data_source_id")


@query(
    "source_id_list",
    f"""with {SOURCES_CTE}, {CREATED_CTE}
select c.*, l.data_source_id_list from combined c join {LIST_SQL} l on c.member_id = l.member_id""",
)
def source_id_list(t: Tables):
    return _listed(t)


@query(
    "source_list_repeats",
    """with rows as (select distinct user_id, event_type, cast(ts as date) as day from events)
select r.*, l.sources from rows r join (
  select user_id, string_agg(event_type, ',' order by event_type) as sources from rows group by user_id) l
on r.user_id = l.user_id""",
)
def source_list_repeats(t: Tables):
    """Several rows per key and source: a source is named once per row."""
    rows = t.events.select("user_id", "event_type", F.col("ts").cast("date").alias("day"))
    return mastering.source_list(rows, ["user_id"], "event_type", "sources")


@query(
    "master_chain",
    f"""with {SOURCES_CTE}, {CREATED_CTE}, {UPDATE_CTE},
first as (select * from masters union all select * from multi_source where lower(data_source_id) <> 'o1'),
children2 as (select 'O1' as child, 1 as place union all select 'F2', 2),
created2 as (select member_id, 'O2' as data_source_id, first_date, best from (
  select b.*, rank() over (partition by b.member_id order by c.place) as rk
  from first b join children2 c on lower(b.data_source_id) = lower(c.child)
  where not exists (select 1 from first m where lower(m.data_source_id) = 'o2' and m.member_id = b.member_id)) x
  where rk = 1),
both_ as (select * from first union select * from created2)
select * from both_ where lower(data_source_id) = 'o2'
union all select * from first where lower(data_source_id) <> 'o2'""",
)
def master_chain(t: Tables):
    """Two masters, the second built on the rows of the first."""
    views = {MASTER: lambda df: _views(t)}
    chain = {MASTER: CHILDREN, "O2": ["O1", "F2"]}
    return jobs.build_masters(multi_source(t), chain, ["member_id"], "data_source_id", views, ["best", "first_date"])


@query("distinct_sources", f"with {SOURCES_CTE} select distinct data_source_id from multi_source")
def distinct_sources(t: Tables):
    return mastering.distinct_sources(multi_source(t), "data_source_id")


FLAGS = ["P1", "F3", "F1", "O1", "O2"]
MASTERS = {"O1": CHILDREN, "O2": ["O1", "F2"]}
FLAG_SQL = ", ".join(
    f"case when list_contains(string_split(data_source_id_list, ','), '{s}') and data_source_id in ({inside}) "
    f"then 1 else 0 end as {s.lower()}"
    for s, inside in {
        "P1": "'P1', 'O1', 'O2'",
        "F3": "'F3', 'O1', 'O2'",
        "F1": "'F1', 'O1', 'O2'",
        "O1": "'O1', 'O2'",
        "O2": "'O2'",
    }.items()
)


@query(
    "source_flags",
    f"""with {SOURCES_CTE}, {CREATED_CTE}
select *, {FLAG_SQL} from (
  select c.*, l.data_source_id_list from combined c join {LIST_SQL} l on c.member_id = l.member_id) x""",
)
def source_flags(t: Tables):
    return mastering.source_flags(_listed(t), FLAGS, MASTERS, "data_source_id")


@query(
    "master_final",
    f"""with {SOURCES_CTE}, {CREATED_CTE}
select distinct *, md5(concat_ws('-', cast(best as varchar), data_source_id, cast(first_date as varchar),
   cast(member_id as varchar))) as hashkey,
 date '2024-02-01' as add_date, date '9999-12-31' as delete_date, timestamp '2024-02-01 00:00:00' as last_modified_date,
 1 as is_active, 1 as is_incremental
from combined where data_source_id in ('O1', 'O2')""",
)
def master_final(t: Tables):
    combined = mastering.master_waterfall(multi_source(t), MASTER, CHILDREN, ["member_id"], "data_source_id")
    return mastering.master_final(combined, list(MASTERS), "data_source_id", AUDIT)


@query(
    "combine_sources",
    """select distinct o_custkey as party, o_orderstatus as status, cast(null as integer) as nation from orders
union all select distinct c_custkey, null, c_nationkey from customer""",
)
def combine_sources(t: Tables):
    orders = [
        MappingRow("party", "orders", "o_custkey", datatype="bigint", rule_order=1),
        MappingRow("status", "orders", "o_orderstatus", rule_order=1),
    ]
    customers = [
        MappingRow("party", "customer", "c_custkey", datatype="bigint", rule_order=2),
        MappingRow("nation", "customer", "c_nationkey", datatype="integer", rule_order=2),
    ]
    tables = {"orders": t.orders, "customer": t.customer}
    frames = [mapping.apply_mapping(tables, group) for group in mapping.rule_groups(orders + customers)]
    return mastering.combine_sources(frames)


@query(
    "join_fanout_check",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
)
def join_fanout_check(t: Tables):
    return quality.fanout_check(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "job_external_ids",
    """with one as (select distinct c_custkey as member, c_mktsegment as segment from customer where c_mktsegment <> 'BUILDING'),
first as (select member, segment, dense_rank() over (order by member) as id from one),
late as (select distinct c_custkey as member, c_mktsegment as segment from customer where c_mktsegment = 'BUILDING'),
ids as (
  select member, segment, null as nation, id, 'day1' as insert_ts from first union all
  select l.member, l.segment, c_nationkey, (select max(id) from first) + dense_rank() over (order by l.member), 'day2'
  from late l join customer on c_custkey = l.member),
second as (
  select member, 500 + dense_rank() over (order by member) as code from late union all
  select member, 500 + (select count(*) from late) + dense_rank() over (order by member) from one)
select i.*, s.code from ids i join second s on i.member = s.member""",
)
def job_external_ids(t: Tables):
    """Two days: new members on the second, with one more attribute and one more id for all of them."""
    path = sink.scratch_folder(t.spark)
    rows = t.customer.select(F.col("c_custkey").alias("member"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    one = IdColumn("id")
    jobs.external_ids_table(t.spark, rows.drop("nation"), ["member"], [one], path, "day1", "segment <> 'BUILDING'")
    jobs.external_ids_table(t.spark, rows, ["member"], [one, IdColumn("code", 500)], path, "day2")
    table, new = jobs.external_ids_table(t.spark, rows, ["member"], [one, IdColumn("code", 500)], path, "day3")
    assert not new
    return table
