"""Projections, unions, scalar functions, mappings and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataload import schema
from strataload.catalog.frames import CODES_CTE, CUST_CTE, codes, cust_versions
from strataload.catalog.registry import Tables, query
from strataload.functions import scalar
from strataload.operators import quality
from strataload.plans import extract, mapping, named, rules
from strataload.plans.mapping import MappingRow
from strataload.sources.scan import as_strings

# --- projections ---------------------------------------------------------------


@query(
    "typed_projection",
    """select o_orderkey as order_id, cast(o_orderdate as date) as order_date, o_orderdate as order_ts,
  cast(o_totalprice as decimal(18,2)) as total, o_orderstatus as status, try_cast(o_orderpriority as integer) as level,
  cast(null as varchar) as nothing, try_cast(substr(o_orderpriority, 1, 1) as integer) as digit,
  cast(o_orderdate as date) as real_date, cast(o_orderdate as date) as parsed_date,
  cast(cast(o_orderdate as date) as timestamp) as real_ts
from orders""",
)
def typed_projection(t: Tables):
    staged = as_strings(t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a")))
    staged = staged.withColumn("day", F.to_date("o_orderdate", "MM/dd/yyyy hh:mm:ss a"))
    rows = [
        MappingRow("order_id", "o", "o_orderkey", datatype="long"),
        MappingRow("order_date", "o", "o_orderdate", datatype="date"),
        MappingRow("order_ts", "o", sql="o.o_orderdate", datatype="timestamp", format="MM/dd/yyyy hh:mm:ss a"),
        MappingRow("total", "o", "o_totalprice", datatype="decimal", length="(18,2)"),
        MappingRow("STATUS", "o", "o_orderstatus", datatype="varchar", length="-1"),
        MappingRow("level", "o", "o_orderpriority", datatype="integer"),
        MappingRow("nothing", "o"),
        MappingRow("digit", "o", sql="substr(o.o_orderpriority, 1, 1)", datatype="integer"),
        MappingRow("real_date", "o", "day", datatype="date"),
        MappingRow("parsed_date", "o", sql=f"to_date(o.o_orderdate, '{mapping.DEFAULT_FORMAT}')", datatype="date"),
        MappingRow("real_ts", "o", sql="cast(o.day as timestamp)", datatype="timestamp"),
    ]
    out = mapping.apply_mapping({"o": staged}, rows)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("order_ts", "real_ts")})


@query(
    "mapped_projection",
    f"""with {CUST_CTE}
select cust_id, lower(segment) as seg, cast(version as varchar) as v, null as empty, add_date, delete_date, is_active
from cust_versions""",
)
def mapped_projection(t: Tables):
    rows = [
        MappingRow("cust_id", "cv", "cust_id", alias="c"),
        MappingRow("seg", "cv", alias="c", sql="lower(c.segment)"),
        MappingRow("v", "cv", alias="c", sql="cast(c.version as string)"),
        MappingRow("empty", "cv", alias="c"),
    ]
    return mapping.apply_mapping({"cv": cust_versions(t)}, rows, mode="full", typed=False)


@query(
    "extract_projection",
    """select strftime(ts, '%Y-%m-%d %H:%M') as event_time, user_id as member, upper(event_type) as kind,
  cast(event_id as varchar) as event_id, cast(value as decimal(18,2)) as amount from events""",
)
def extract_projection(t: Tables):
    fields = [
        extract.ExtractField("event_id", "varchar", length="(20)", order=4),
        extract.ExtractField("value", "decimal", "amount", length="(18,2)"),
        extract.ExtractField("ts", "time", "event_time", format="yyyy-MM-dd HH:mm", order=1),
        extract.ExtractField("user_id", "bigint", "member", order=2),
        extract.ExtractField("event_type", "varchar", "kind", sql="upper(e.event_type)", order=3),
    ]
    return extract.project(t.events, fields, "e")


@query(
    "exclusion_filter",
    """select d.doc_id, d.lang, l.toxic as Exclude_Per_DID from documents d left join labels l on d.doc_id = l.doc_id
where coalesce(l.toxic, 0) <> 1""",
)
def exclusion_filter(t: Tables):
    labels = t.labels.select("doc_id", F.col("toxic").alias("Exclude_Per_DID"))
    return schema.drop_excluded(t.documents.select("doc_id", "lang").join(labels, "doc_id", "left"))


@query(
    "config_constants",
    "select s_suppkey, s_name, 'vendor' as data_source, 7 as data_source_id, '20240201' as data_version from supplier",
)
def config_constants(t: Tables):
    constants = {"data_source": "vendor", "data_source_id": 7, "data_version": "20240201"}
    return schema.config_constants(t.supplier.select("s_suppkey", "s_name"), constants)


@query("standard_names", "select l_orderkey as order_number, l_linenumber, l_shipdate as shipped_at from lineitem")
def standard_names(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    return schema.standard_names(rows, {"l_orderkey": "order_number", "l_linenumber": " ", "l_shipdate": "shipped_at"})


@query("snake_columns", "select conv_id as conversation_id, turn as turn_number, role as speaker_role from conversations")
def snake_columns(t: Tables):
    rows = t.conversations.select(
        F.col("conv_id").alias("conversation id"), F.col("turn").alias("turn  number"), F.col("role").alias(" speaker role")
    )
    return schema.snake_columns(rows)


@query(
    "unpivot_numbered",
    """select p_partkey, 1 as instance, p_type as code, p_name as note from part
union all select p_partkey, 2, p_brand, null from part
union all select p_partkey, 3, p_name, p_brand from part""",
)
def unpivot_numbered(t: Tables):
    wide = t.part.select(
        "p_partkey",
        F.col("p_type").alias("code1"),
        F.col("p_brand").alias("code2"),
        F.col("p_name").alias("code_3"),
        F.col("p_name").alias("note1"),
        F.col("p_brand").alias("note3"),
    )
    return schema.unpivot_numbered(wide, ["p_partkey"], ["code", "note"])


@query("wildcard_filter", "select p_partkey, p_name from part where p_name glob 'r?d *g*' or p_name glob '*anvil'")
def wildcard_filter(t: Tables):
    hit = scalar.wildcard(F.col("p_name"), "r?d *g*") | scalar.wildcard(F.col("p_name"), "*anvil")
    return t.part.filter(hit).select("p_partkey", "p_name")


@query(
    "list_has_long_value",
    f"""with {CODES_CTE}
select row_id, len(list_filter(string_split(code_list, '^'), lambda x: length(x) > 8)) > 0 as has_long from codes""",
)
def list_has_long_value(t: Tables):
    items = scalar.split_list(F.col("code_list"))
    return codes(t).select("row_id", scalar.has_long_value(items, longer_than=8).alias("has_long"))


# --- unions and set operations ---------------------------------------------------


def _parties(t: Tables):
    customers = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("nation"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
    )
    return customers, suppliers


PARTIES_SQL = """select c_custkey as id, c_name as name, cast(c_nationkey as varchar) as nation,
  c_mktsegment as segment, cast(null as decimal(18,2)) as balance from customer
{op} select s_suppkey, s_name, concat('n', cast(s_nationkey as varchar)), null, cast(s_acctbal as decimal(18,2))
from supplier"""


@query("union_aligned", PARTIES_SQL.format(op="union all"))
def union_aligned(t: Tables):
    return schema.union_bag(_parties(t))


@query(
    "union_merge_distinct",
    """select l_returnflag as flag, l_linestatus as status, cast(null as varchar) as kind from lineitem
union select null, o_orderstatus, o_orderpriority from orders""",
)
def union_merge_distinct(t: Tables):
    lines = t.lineitem.select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"))
    orders = t.orders.select(F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("status"))
    return schema.union_set([lines, orders])


@query(
    "except_rows",
    """select l_orderkey, l_linenumber, null as kind from lineitem
except select l_orderkey, l_linenumber, null from lineitem where l_returnflag = 'R'""",
)
def except_rows(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    returned = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", F.lit(None).alias("kind"))
    return schema.except_rows(lines, returned.withColumn("kind", F.col("kind").cast("string")))


@query(
    "names_from_columns",
    "select p_type as name from part union select p_brand from part union select p_name from part",
)
def names_from_columns(t: Tables):
    return schema.distinct_values(t.part, ["p_type", "p_brand", "p_name"])


@query(
    "group_all_distinct",
    """select l_suppkey as party, l_returnflag as flag from lineitem
union select o_custkey, o_orderstatus from orders""",
)
def group_all_distinct(t: Tables):
    lines = t.lineitem.select(F.col("l_suppkey").alias("party"), F.col("l_returnflag").alias("flag"))
    orders = t.orders.select(F.col("o_custkey").alias("party"), F.col("o_orderstatus").alias("flag"))
    return lines.unionByName(orders).distinct()


@query(
    "count_check",
    """select 'documents' as name, count(*) as n from documents union all select 'labels', count(*) from labels
union all select 'lineitem', count(*) from lineitem""",
)
def count_check(t: Tables):
    return quality.count_check({"documents": t.documents, "labels": t.labels, "lineitem": t.lineitem})


# --- scalar functions --------------------------------------------------------------


@query(
    "scalar_string",
    """select p_partkey, trim(concat('  ', p_name, ' ')) as trimmed, lower(p_type) as low, upper(p_name) as up,
  replace(p_brand, '#', '_') as replaced, substr(p_brand, 7) as tail, position('#' in p_brand) as at,
  p_name like 'r%g' as liked, p_type || '/' || p_brand as joined, concat_ws('^', p_type, null, p_brand) as listed,
  string_split(p_name, ' ')[2] as second, ascii(p_name) as code
from part""",
)
def scalar_string(t: Tables):
    return t.part.selectExpr(
        "p_partkey",
        "trim(concat('  ', p_name, ' ')) as trimmed",
        "lower(p_type) as low",
        "upper(p_name) as up",
        "replace(p_brand, '#', '_') as replaced",
        "substr(p_brand, 7) as tail",
        "cast(position('#' in p_brand) as bigint) as at",
        "p_name like 'r%g' as liked",
        "p_type || '/' || p_brand as joined",
        "concat_ws('^', p_type, null, p_brand) as listed",
        "try_element_at(split(p_name, ' '), 2) as second",
        "ascii(p_name) as code",
    )


@query(
    "scalar_null",
    """select d.doc_id, coalesce(quality, -1) as q, coalesce(cast(toxic as varchar), lang) as t,
  case when quality is null then 'none' when quality = 1 then 'good' else 'bad' end as grade
from documents d left join labels l on d.doc_id = l.doc_id""",
)
def scalar_null(t: Tables):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return joined.selectExpr(
        "doc_id",
        "coalesce(quality, -1) as q",
        "nvl(cast(toxic as string), lang) as t",
        "case when quality is null then 'none' when quality = 1 then 'good' else 'bad' end as grade",
    )


@query(
    "scalar_date",
    """select event_id, cast(ts as date) as day, strftime(ts, '%Y%m%d') as stamp, cast(ts as date) - 1 as before,
  cast(ts as date) between date '2024-01-05' and date '2024-01-10' as inside,
  strptime(strftime(ts, '%d/%m/%Y %H:%M:%S'), '%d/%m/%Y %H:%M:%S') as second
from events""",
)
def scalar_date(t: Tables):
    return t.events.select(
        "event_id",
        F.try_to_date(F.date_format("ts", "yyyyMMdd"), "yyyyMMdd").alias("day"),
        F.date_format("ts", "yyyyMMdd").alias("stamp"),
        F.date_sub(F.col("ts").cast("date"), 1).alias("before"),
        F.col("ts").cast("date").between("2024-01-05", "2024-01-10").alias("inside"),
        F.try_to_timestamp(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), F.lit("dd/MM/yyyy HH:mm:ss"))
        .cast("timestamp_ntz")
        .alias("second"),
    )


@query(
    "scalar_array",
    f"""with {CODES_CTE}, items as (
  select row_id, unnest(string_split(code_list, '^')) as item,
         generate_subscripts(string_split(code_list, '^'), 1) - 1 as place from codes)
select item, count(*) as n, string_agg(distinct cast(place as varchar), ',' order by cast(place as varchar)) as places,
  bool_or(item in ('ECONOMY', 'PROMO')) as listed
from items group by item""",
)
def scalar_array(t: Tables):
    items = codes(t).select("row_id", F.posexplode(scalar.split_list(F.col("code_list"))).alias("at", "item"))
    per_place = items.groupBy("item", F.col("at").cast("string").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    return per_place.groupBy("item").agg(
        F.sum("n").alias("n"),
        F.concat_ws(",", F.array_sort(F.collect_list("at"))).alias("places"),
        F.bool_or(F.array_contains(F.array(F.lit("ECONOMY"), F.lit("PROMO")), F.col("item"))).alias("listed"),
    )


@query(
    "month_text_cleanse",
    """select o_orderkey, strftime(o_orderdate, '%m%Y') as long_name, strftime(o_orderdate, '%d%m%Y') as short_name,
  strftime(o_orderdate, '%m-%d') as loose from orders""",
)
def month_text_cleanse(t: Tables):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        scalar.month_text(F.date_format(day, "MMMM yyyy")).alias("long_name"),
        scalar.month_text(F.upper(F.date_format(day, "dd'__'MMM',_'yyyy"))).alias("short_name"),
        scalar.month_text(F.concat(F.date_format(day, "MMM'.-'dd"), F.lit(" x."))).alias("loose"),
    )


@query("decrypt_column_roundtrip", "select c_custkey, c_name from customer")
def decrypt_column_roundtrip(t: Tables):
    key = F.lit("example-key-0001")
    secret = t.customer.select("c_custkey", scalar.encrypt_text(F.col("c_name"), key).alias("c_name"))
    return secret.withColumn("c_name", scalar.decrypt_text(F.col("c_name"), key))


# --- mappings ------------------------------------------------------------------------


@query(
    "mapped_joins",
    """select o.o_orderkey as order_id, c.c_name as customer, n.n_name as nation, r.r_name as region
from orders o left join customer c on o.o_custkey = c.c_custkey left join nation n on n.n_nationkey = c.c_nationkey
join region r on r.r_regionkey = n.n_regionkey where o.o_totalprice > 100000""",
)
def mapped_joins(t: Tables):
    rows = [
        MappingRow("order_id", "orders", "o_orderkey", alias="o", kind="primary", datatype="bigint"),
        MappingRow("customer", "customer", "c_name", alias="c"),
        MappingRow("nation", "nation", "n_name", alias="n"),
        MappingRow("region", "region", "r_name", alias="r"),
        MappingRow(table="customer", alias="c", kind="left join", sql="o.o_custkey = c.c_custkey"),
        MappingRow(table="nation", alias="n", kind="Left Join", sql="n.n_nationkey = c.c_nationkey"),
        MappingRow(table="region", alias="r", kind="join", sql="r.r_regionkey = n.n_regionkey"),
        MappingRow(kind="where", sql="o.o_totalprice > 100000"),
    ]
    tables = {name: getattr(t, name) for name in ("orders", "customer", "nation", "region")}
    return mapping.apply_mapping(tables, rows)


@query(
    "multi_rule_union",
    """select o_orderkey as id, o_orderstatus as status, cast(null as varchar) as flag from orders where o_orderstatus = 'F'
union all select l_orderkey, null, l_returnflag from lineitem
union all select o_orderkey, o_orderpriority, null from orders""",
)
def multi_rule_union(t: Tables):
    closed = [
        MappingRow("id", "orders", "o_orderkey", datatype="bigint"),
        MappingRow("status", "orders", "o_orderstatus"),
        MappingRow(kind="where", sql="o_orderstatus = 'F'"),
    ]
    lines = [
        MappingRow("id", "lineitem", "l_orderkey", datatype="bigint"),
        MappingRow("flag", "lineitem", "l_returnflag"),
    ]
    every = [MappingRow("id", "orders", "o_orderkey", datatype="bigint"), MappingRow("status", "orders", "o_orderpriority")]
    rows = mapping.with_order(every, 2) + mapping.with_order(lines, 1, 2) + mapping.with_order(closed, 1, 1)
    return mapping.apply_all_rules({"orders": t.orders, "lineitem": t.lineitem}, rows)


@query(
    "per_source_mapping",
    """select c_custkey as party_id, upper(c_name) as party, 'retail' as data_source, 1 as data_source_id from customer
union all select s_suppkey, upper(s_name), 'vendor', 2 from supplier""",
)
def per_source_mapping(t: Tables):
    rows = [
        MappingRow("party_id", "party", "id", datatype="bigint"),
        MappingRow("party", "party", sql="upper(party.name)"),
    ]
    sources = {
        "retail": {"party": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))},
        "vendor": {"party": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))},
    }
    constants = {
        "retail": {"data_source": "retail", "data_source_id": 1},
        "vendor": {"data_source": "vendor", "data_source_id": 2},
    }
    return mapping.apply_per_source(sources, rows, constants)


@query(
    "sql_step",
    """select n_name, o_orderstatus, count(*) as n, sum(cast(o_totalprice as decimal(18,2))) as total
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2""",
)
def sql_step(t: Tables):
    text = """select n_name, o_orderstatus, count(*) as n, sum(cast(o_totalprice as decimal(18,2))) as total
        from {src1_schema.orders} join {src2_schema.customer} on o_custkey = c_custkey
        join {src2_schema.nation} on c_nationkey = n_nationkey group by n_name, o_orderstatus"""
    tables = {"sales_orders": t.orders, "crm_customer": t.customer, "crm_nation": t.nation}
    return mapping.sql_step(t.spark, text, tables, {"src1_schema": "sales", "src2_schema": "crm"})


@query(
    "distinct_row_steps",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc, l_partkey, l_suppkey) as rn from lineitem) x where rn = 1""",
)
def distinct_row_steps(t: Tables):
    steps = {
        "ranked": """select *, row_number() over (partition by l_orderkey, l_linenumber
            order by l_shipdate desc, l_partkey, l_suppkey) as rn from {lines}""",
        "first": "select * from {ranked} where rn = 1",
    }
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return mapping.distinct_rows(lines, "lines", steps)


# --- rules ---------------------------------------------------------------------------


@query(
    "deid_rules",
    """select o_orderkey, case when r.r_name in ('ASIA', 'EUROPE') then null else o_custkey end as o_custkey,
  case when o_orderstatus = 'P' then 'masked' else o_orderstatus end as o_orderstatus,
  date_trunc('year', cast(o_orderdate as date)) :: date as o_orderdate,
  concat(r.r_name, '/', case when o_orderstatus = 'P' then 'masked' else o_orderstatus end) as area
from (select o_orderkey, o_custkey, o_orderstatus, o_orderdate from orders) o
left join customer c on o.o_custkey = c.c_custkey left join nation n on n.n_nationkey = c.c_nationkey
left join region r on r.r_regionkey = n.n_regionkey""",
)
def deid_rules(t: Tables):
    lookup = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    steps = [
        rules.Rule("element", "o_orderstatus", "case when o.o_orderstatus = 'P' then 'masked' else o.o_orderstatus end"),
        rules.Rule("element", "o_orderdate", "cast(trunc(o.o_orderdate, 'year') as date)"),
        rules.Rule("lookup", sql="o.o_custkey = reg.c_custkey", alias="reg", order=1, set=1),
        rules.Rule("element", "area", "reg.r_name", order=1, set=1),
        rules.Rule(
            "element", "o_custkey", "case when o.area in ('ASIA', 'EUROPE') then null else o.o_custkey end", order=1, set=2
        ),
        rules.Rule("element", "area", "concat(o.area, '/', o.o_orderstatus)", order=2),
    ]
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return rules.apply_rules(base, steps, {"reg": lookup.select("c_custkey", "r_name")}, "o")


@query(
    "cleanse_rules",
    """select c_custkey, concat(substr(c_name, 1, 1), '-retail') as c_name, c_nationkey, c_mktsegment, n.n_name as nation,
  s.label as segment_label
from customer c left join (select n_nationkey, n_name from nation where n_regionkey < 3) n on c.c_nationkey = n.n_nationkey
left join (select substr(r_name, 1, 1) as start, min(r_name) as label from region group by 1) s
  on starts_with(c.c_mktsegment, s.start)""",
)
def cleanse_rules(t: Tables):
    """Class text, lookup filter and columns, a wildcard lookup and a source list at work."""
    classes = [
        rules.RuleClass("mask", "concat(substr(<alias:$1>.<element_name:$1>, 1, 1), '-any')"),
        rules.RuleClass("mask", "concat(substr(<alias:$1>.<element_name:$1>, 1, 1), '-retail')", source="retail"),
        rules.RuleClass(
            "nation", "<alias:$1>.c_nationkey = <alias:$2>.n_nationkey", lookup_arg="filter:n_regionkey < 3;columns:n_nationkey,n_name"
        ),
    ]
    steps = [
        rules.Rule("element", "c_name", rule_class="mask", source="wholesale, retail"),
        rules.Rule("element", "c_mktsegment", "'lost'", source="wholesale"),
        rules.Rule("lookup", rule_class="nation", lookup="nations", alias="nat", order=1),
        rules.Rule("element", "nation", "nat.n_name", order=1),
        rules.Rule(
            "lookup", "c_mktsegment", "customer.c_mktsegment = seg.start", lookup="starts", alias="seg",
            lookup_arg="pattern:start", order=2,
        ),
        rules.Rule("element", "segment_label", "seg.label", order=2),
    ]
    start = F.concat(F.substring("r_name", 1, 1), F.lit("*")).alias("start")
    lookups = {"nations": t.nation, "starts": t.region.groupBy(start).agg(F.min("r_name").alias("label"))}
    base = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return rules.apply_rules(base, steps, lookups, "customer", classes, source="retail")


@query(
    "rule_template",
    """select c_custkey, concat(substr(c_name, 1, 1), '***') as c_name, n.n_name as c_nationkey,
  concat(lower(substr(c_mktsegment, 1, 3)), '-', cast(c_custkey as varchar)) as c_mktsegment
from customer c left join nation n on c.c_nationkey = n.n_nationkey""",
)
def rule_template(t: Tables):
    classes = [
        rules.RuleClass("mask", "concat(substr(<alias:$1>.<element_name:$1>, 1, 1), '***')"),
        rules.RuleClass("tag", "concat(<alias:$1>.<element_name:$1>, '?')"),
        rules.RuleClass(
            "tag",
            "concat(lower(substr(<alias:$1>.<element_name:$1>, 1, 3)), '-', cast(<alias:$1>.<element_name:$2> as string))",
            source="retail",
        ),
        rules.RuleClass("nation_of", "<alias:$1>.<element_name:$1> = <alias:$2>.n_nationkey"),
    ]
    steps = [
        rules.Rule("element", "c_name", rule_class="mask"),
        rules.Rule(
            "element", "c_mktsegment", rule_class="tag", source="retail", parameters="element_name:c_mktsegment,c_custkey"
        ),
        rules.Rule("lookup", "c_nationkey", rule_class="nation_of", alias="nat"),
        rules.Rule("element", "c_nationkey", "nat.n_name"),
    ]
    base = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return rules.apply_rules(base, steps, {"nat": t.nation}, "customer", classes)


@query(
    "named_functions",
    """select distinct c_custkey, trim(c_name) as name, c_mktsegment, 'x' as source from customer where c_mktsegment is not null""",
)
def named_functions(t: Tables):
    """A table shaped by functions that configuration names."""
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    rows = named.processed(rows, named.BEFORE, "without_nulls(c_mktsegment); distinct")
    rows = named.with_columns(rows, {"name": "trimmed(c_name)"})
    return named.processed(rows, named.AFTER, "constant(source, x); drop(c_name, c_acctbal)")
