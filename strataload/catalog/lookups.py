"""Semi, anti, interval and pattern joins; recodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataload.catalog.frames import (
    CODES_CTE,
    CUST_CTE,
    NAMES_CTE,
    ORDERS_CTE,
    code_lookup,
    codes,
    cust_versions,
    names,
    orders_src,
    orders_tgt,
    restricted,
)
from strataload.catalog.registry import ORACLES, Tables, query
from strataload.operators import identity, lookup, recode, sweep
from strataload.plans import rules


@query(
    "semi_join_closed",
    """select distinct o_orderkey, o_orderstatus from orders o join lineitem l on o.o_orderkey = l.l_orderkey
where l.l_returnflag = 'A'""",
)
def semi_join_closed(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t.orders.select("o_orderkey", "o_orderstatus").join(returned, "o_orderkey", "left_semi").distinct()


@query(
    "anti_join_new_rows",
    """select d.doc_id, d.lang, d.source from documents d left join labels l on d.doc_id = l.doc_id
where l.doc_id is null""",
)
def anti_join_new_rows(t: Tables):
    return identity.new_rows(t.documents.select("doc_id", "lang", "source"), t.labels, ["doc_id"])


@query(
    "not_exists_new_keys",
    f"""with {ORDERS_CTE}
select order_id, cust_id, status from orders_src s where lower(status) <> 'p' and not exists (
  select 1 from orders_tgt t where t.order_id = s.order_id and t.cust_id = s.cust_id)""",
)
def not_exists_new_keys(t: Tables):
    fresh = identity.new_keys(orders_src(t), orders_tgt(t), ["order_id", "cust_id"], where="lower(status) <> 'p'")
    return fresh.select("order_id", "cust_id", "status")


def _dated_orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("add_date"))


@query(
    "asof_validity_join",
    f"""with {CUST_CTE}
select o_orderkey, o_custkey, cast(o_orderdate as date) as add_date, v.version, v.segment
from orders o left join cust_versions v on o.o_custkey = v.cust_id
and cast(o_orderdate as date) between v.add_date and v.delete_date""",
)
def asof_validity_join(t: Tables):
    outputs = {"version": "version", "segment": "segment"}
    return lookup.validity_join(_dated_orders(t), cust_versions(t), {"o_custkey": "cust_id"}, outputs=outputs)


@query(
    "active_dim_join",
    f"""with {CUST_CTE}
select o_orderkey, o_custkey, cast(o_orderdate as date) as add_date, v.segment as current_segment
from orders o left join cust_versions v on o.o_custkey = v.cust_id and v.is_active = 1""",
)
def active_dim_join(t: Tables):
    return lookup.active_join(
        _dated_orders(t), cust_versions(t), {"o_custkey": "cust_id"}, {"segment": "current_segment"}
    )


@query(
    "prefix_pattern_lookup",
    f"""with {CODES_CTE}, vals as (select distinct p_brand as v from part union select distinct p_name from part)
select distinct v as pattern, kind from vals join code_lookup
on (pattern like '%*' and starts_with(v, rtrim(pattern, '*'))) or (pattern not like '%*' and v = pattern)""",
)
def prefix_pattern_lookup(t: Tables):
    values = t.part.select(F.explode(F.array("p_brand", "p_name")).alias("v"))
    return lookup.prefix_lookup(values, "v", code_lookup(t), "pattern")


@query(
    "prefix_pattern_multi",
    f"""with {CODES_CTE}, vals as (select distinct unnest(string_split(code_list, '^')) as v from codes)
select distinct v as pattern, kind from vals join code_lookup
on (pattern like '%*' and starts_with(v, rtrim(pattern, '*'))) or (pattern not like '%*' and v = pattern)""",
)
def prefix_pattern_multi(t: Tables):
    return lookup.prefix_lookup(codes(t), "code_list", code_lookup(t), "pattern", sep="^")


BEST_CTE = """
best as (select name, match_type, name_pattern, priority, plan_name, organization_name from (
  select n.name, r.*, row_number() over (partition by n.name order by r.priority nulls last, r.name_pattern) as rn
  from all_names n join restricted r
    on (r.match_type = 'pattern' and contains(lower(n.name), lower(r.name_pattern)))
    or (r.match_type = 'exact' and n.name = r.name_pattern)) x where rn = 1)"""


@query(
    "contains_pattern_best",
    f"""with {NAMES_CTE},
all_names as (select distinct payer_name as name from names union select distinct plan_name from names), {BEST_CTE}
select * from best""",
)
def contains_pattern_best(t: Tables):
    found = names(t).select(F.explode(F.array("payer_name", "plan_name")).alias("name"))
    return lookup.contains_lookup(found, "name", restricted(t), "name_pattern", "match_type", "priority")


@query(
    "contains_pattern_long",
    f"""with {NAMES_CTE.replace("restricted as", "some_restricted as")},
restricted as (select * from some_restricted union all select 'pattern', '', 90, 'REST <x>', cast(null as varchar)
  union all select 'pattern', 'the', 95, 'THE <x>', cast(null as varchar)),
all_names as (select distinct text as name from documents), {BEST_CTE}
select md5(name) as name, match_type, name_pattern, priority, plan_name, organization_name from best where name is not null""",
)
def contains_pattern_long(t: Tables):
    """Whole documents as names, a pattern that hits often and an empty one that hits always."""
    rows = [("pattern", "", 90, "REST <x>", None), ("pattern", "the", 95, "THE <x>", None)]
    patterns = restricted(t).unionByName(t.spark.createDataFrame(rows, restricted(t).schema))
    found = lookup.contains_lookup(t.documents, "text", patterns, "name_pattern", "match_type", "priority")
    return found.select(F.md5("text").alias("name"), *patterns.columns)


@query(
    "null_safe_lookup",
    f"""with {NAMES_CTE}, side as (select payer_name, count(*) as uses from names group by payer_name)
select n.id, n.plan_name, n.payer_name, s.uses as uses
from names n left join side s on n.payer_name is not distinct from s.payer_name""",
)
def null_safe_lookup(t: Tables):
    side = names(t).groupBy("payer_name").agg(F.count(F.lit(1)).alias("uses"))
    return lookup.null_safe_lookup(names(t), side, {"payer_name": "payer_name"}, {"uses": "uses"})


@query(
    "filtered_lookup",
    """select o_orderkey, o_custkey, o_orderstatus, c.c_name as customer_name from orders o
left join (select c_custkey, c_name from customer where c_mktsegment = 'BUILDING') c on c.c_custkey = o.o_custkey""",
)
def filtered_lookup(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return lookup.filtered_lookup(
        rows, t.customer, ("o_custkey", "c_custkey"), "c_name", "customer_name", "c_mktsegment = 'BUILDING'"
    )


@query(
    "prepared_lookup",
    f"""with {ORDERS_CTE},
latest as (select *, row_number() over (partition by order_id order by add_date desc nulls last) as rn from orders_tgt)
select distinct 'latest' as kind, cust_id, status, null as add_date, null as delete_date from latest
  where rn = 1 and status <> 'X'
union all select distinct 'dated', cust_id, status, add_date, delete_date from orders_tgt where status <> 'X'
union all select distinct 'active', cust_id, status, null, null from orders_tgt where status <> 'X' and is_active = 1""",
)
def prepared_lookup(t: Tables):
    tgt = orders_tgt(t)
    args = {"where": "status <> 'X'", "columns": ["cust_id", "status"]}
    frames = {
        "latest": rules.prepared_lookup(tgt, "full", "latest_record", keys=["order_id"], **args),
        "dated": rules.prepared_lookup(tgt, "full", "date_based", **args),
        "active": rules.prepared_lookup(tgt, "incremental", "date_based", **args).select("cust_id", "status").distinct(),
    }
    out = None
    for kind, df in frames.items():
        part = df.withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


@query(
    "recode_multi_value",
    f"""with {CODES_CTE},
hidden as (select distinct p_brand as code from part where p_size < 20 and p_brand like '%2%'
           union select 'ECONOMY' union select distinct p_name from part where p_name like '%ring')
select row_id, case when trim(code_list) = '' then null else code_list end as code_list from (
  select c.row_id, string_agg(i.item, '^' order by i.at_place) as code_list
  from codes c left join (
    select row_id, item, at_place from (
      select row_id, unnest(string_split(code_list, '^')) as item,
             generate_subscripts(string_split(code_list, '^'), 1) as at_place from codes) u
    where item not in (select code from hidden)) i on c.row_id = i.row_id
  group by c.row_id) x""",
)
def recode_multi_value(t: Tables):
    brands = t.part.filter("p_size < 20 and p_brand like '%2%'").select(F.col("p_brand").alias("code"))
    rings = t.part.filter("p_name like '%ring'").select("p_name")
    economy = t.part.filter("p_type = 'ECONOMY'").select("p_type")
    return recode.recode_multi_value(codes(t), "code_list", brands.union(rings).union(economy), "code")


@query(
    "restricted_name_recode",
    f"""with {NAMES_CTE},
all_names as (select plan_name as name from names union select payer_name from names), {BEST_CTE},
dict as (select row_number() over (order by a.name nulls first) as id, a.name, b.name_pattern, b.plan_name,
                b.organization_name
         from all_names a left join best b on a.name = b.name),
flagged as (select n.id, n.plan_name, n.payer_name, d1.id as id1, d2.id as id2,
                   d1.plan_name as own1, d2.organization_name as own2,
                   upper(coalesce(d1.name_pattern, d2.name_pattern)) as hit
            from names n left join dict d1 on n.plan_name is not distinct from d1.name
            left join dict d2 on n.payer_name is not distinct from d2.name),
defaults as (select * from (select upper(name_pattern) as hit, plan_name as def1, organization_name as def2,
             row_number() over (partition by upper(name_pattern) order by priority, name_pattern) as rn from restricted) x
             where rn = 1)
select f.id,
  case when f.hit is null or plan_name is null or trim(plan_name) = '' then plan_name
       else replace(coalesce(own1, def1), '<x>', cast(id1 as varchar)) end as plan_name,
  case when f.hit is null or payer_name is null or trim(payer_name) = '' then payer_name
       else replace(coalesce(own2, def2), '<x>', cast(id2 as varchar)) end as payer_name,
  case when f.hit is null then 0 else 1 end as recoded
from flagged f left join defaults d on f.hit = d.hit""",
)
def restricted_name_recode(t: Tables):
    rows, patterns = names(t), restricted(t)
    dictionary = recode.update_name_dictionary(rows, ["plan_name", "payer_name"], patterns, None)
    columns = {"plan_name": "plan_name", "payer_name": "organization_name"}
    return recode.recode_restricted(rows, columns, patterns, dictionary, "recoded")


def _cust_outputs():
    return {"version": "version", "segment": "segment"}


@query("asof_sweep", ORACLES["asof_validity_join"])
def asof_sweep(t: Tables):
    return sweep.asof_sweep(_dated_orders(t), cust_versions(t), {"o_custkey": "cust_id"}, outputs=_cust_outputs(), stream_rows=5_000)


# every order opens a version of its customer for 200 days: many versions per key, most of them overlapping
PERIODS_CTE = """
periods as (
  select o_custkey as cust_id, o_orderkey as version, cast(o_orderdate as date) as add_date,
         cast(cast(o_orderdate as date) + interval 200 day as date) as delete_date from orders)"""


def _periods(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        F.col("o_custkey").alias("cust_id"), F.col("o_orderkey").alias("version"), day.alias("add_date"), F.date_add(day, 200).alias("delete_date")
    )


@query(
    "asof_sweep_overlaps",
    f"""with {PERIODS_CTE}
select o_orderkey, o_custkey, cast(o_orderdate as date) as add_date, p.version from orders o
left join periods p on o.o_custkey = p.cust_id and cast(o_orderdate as date) between p.add_date and p.delete_date""",
)
def asof_sweep_overlaps(t: Tables):
    return sweep.asof_sweep(_dated_orders(t), _periods(t), {"o_custkey": "cust_id"}, outputs={"version": "version"})


@query(
    "overlapping_versions",
    f"""with {PERIODS_CTE}
select cust_id, version, add_date, delete_date from (
  select *, max(delete_date) over (partition by cust_id order by add_date, delete_date, version
                                   rows between unbounded preceding and 1 preceding) as before from periods) x
where add_date <= before""",
)
def overlapping_versions(t: Tables):
    return sweep.overlapping_versions(_periods(t), ["cust_id"])
