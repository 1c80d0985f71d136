"""Load strategies over two days of ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataload.audit import hash_columns, stamp
from strataload.catalog.frames import (
    AUDIT,
    DEACT_CTE,
    ORDERS_CTE,
    deact_feed,
    orders_src,
    orders_tgt,
)
from strataload.catalog.registry import ORACLES, Tables, query
from strataload.operators import incremental as inc
from strataload.plans import touched
from strataload.sources import sink, versions
from strataload.sources.metrics import Metrics
from strataload.streaming import feeds

COLUMNS = (
    "order_id, cust_id, status, total, order_date, hashkey, add_date, delete_date, last_modified_date, "
    "is_active, is_incremental"
)


def _rows(alias: str = "", incremental: str = "is_incremental") -> str:
    p = f"{alias}." if alias else ""
    flag = f"{p}is_incremental" if incremental == "is_incremental" else incremental
    return (
        f"{p}order_id, {p}cust_id, {p}status, {p}total, {p}order_date, {p}hashkey, {p}add_date, {p}delete_date, "
        f"{p}last_modified_date, {p}is_active, {flag} as is_incremental"
    )


def _closed(incremental: str = "is_incremental") -> str:
    return (
        "order_id, cust_id, status, total, order_date, hashkey, add_date, date '2024-01-31' as delete_date, "
        f"timestamp '2024-02-01 00:00:00' as last_modified_date, 0 as is_active, {incremental} as is_incremental"
    )


@query("load_full_mode", f"with {ORDERS_CTE} select {COLUMNS} from orders_src")
def load_full_mode(t: Tables):
    """Full mode replaces the target, whatever the strategy; a first load does the same."""
    first = inc.load(orders_src(t), None, mode="active", strategy="checksum_all", audit=AUDIT)
    return inc.load(first, orders_tgt(t), mode="full", strategy="checksum_all", audit=AUDIT)


@query("load_overwrite", f"with {ORDERS_CTE} select {COLUMNS} from orders_src")
def load_overwrite(t: Tables):
    return inc.load_overwrite(orders_src(t), orders_tgt(t), audit=AUDIT).to_df()


@query(
    "load_append",
    f"with {ORDERS_CTE} select {COLUMNS} from orders_src union all select {COLUMNS} from orders_tgt",
)
def load_append(t: Tables):
    return inc.load_append(orders_src(t), orders_tgt(t), audit=AUDIT).to_df()


@query(
    "load_append_new_keys",
    f"""with {ORDERS_CTE}
select {COLUMNS} from orders_src where order_id not in (select order_id from orders_tgt where is_active = 1)
union all select {COLUMNS} from orders_tgt""",
)
def load_append_new_keys(t: Tables):
    return inc.load_append_new_keys(orders_src(t), orders_tgt(t), keys=["order_id"], audit=AUDIT).to_df()


@query(
    "load_conditional",
    f"""with {ORDERS_CTE}
select {COLUMNS} from orders_src
union all select {_closed('0')} from orders_tgt
  where (order_date >= date '1998-01-01' or status = 'X') and is_active = 1
union all select {_rows('', '0')} from orders_tgt
  where not (order_date >= date '1998-01-01' or status = 'X') and is_active = 1
union all select {_rows('', '0')} from orders_tgt where is_active = 0""",
)
def load_conditional(t: Tables):
    condition = "order_date >= date '1998-01-01' or status = 'X'"
    return inc.load_conditional(orders_src(t), orders_tgt(t), condition=condition, audit=AUDIT).to_df()


@query(
    "load_checksum_all",
    f"""with {ORDERS_CTE},
sides as (select *, hashkey in (select hashkey from orders_src) as again from orders_tgt)
select {_rows('', '0')} from sides where is_active = 0 or again
union all select {_closed('1')} from sides where is_active = 1 and not again
union all select {COLUMNS} from orders_src where hashkey not in (select hashkey from orders_tgt where is_active = 1)""",
)
def load_checksum_all(t: Tables):
    return inc.load_checksum_all(orders_src(t), orders_tgt(t), audit=AUDIT).to_df()


@query(
    "load_by_key",
    f"""with {ORDERS_CTE},
sides as (select distinct *, is_active = 1 and order_id in (select order_id from orders_src) as again from orders_tgt)
select {_closed('1')} from sides where again
union all select {_rows('', '0')} from sides where not again
union all select {COLUMNS} from orders_src where is_active = 1""",
)
def load_by_key(t: Tables):
    return inc.load_by_key(orders_src(t), orders_tgt(t), keys=["order_id"], audit=AUDIT).to_df()


@query(
    "load_deact_key",
    f"""with {ORDERS_CTE}, {DEACT_CTE},
sides as (select distinct *, is_active = 1 and exists (
            select 1 from deact d where d.dk = t.order_id and upper(d.ds) = t.status) as named from orders_tgt t),
open_hashes as (select hashkey from sides where is_active = 1 group by hashkey having not bool_or(named))
select {_closed()} from sides where named
union all select {_rows('', '0')} from sides where not named
union all select {COLUMNS} from orders_src where is_active = 1 and hashkey not in (select hashkey from open_hashes)""",
)
def load_deact_key(t: Tables):
    return inc.load_deact_key(
        orders_src(t),
        orders_tgt(t),
        deact=deact_feed(t),
        source_keys=["dk", "ds"],
        target_keys=["order_id", "status"],
        audit=AUDIT,
    ).to_df()


SCD2_SQL = f"""
, pairs as (
  select s.order_id as new_id, t.order_id as old_id, coalesce(s.hashkey = t.hashkey, false) as same
  from orders_src s full join (select * from orders_tgt where is_active = 1) t on s.order_id = t.order_id)
select {COLUMNS} from orders_tgt where is_active = 0 or order_id in (select old_id from pairs where same)
union all select {_closed()} from orders_tgt
  where is_active = 1 and order_id in (select old_id from pairs where not same and old_id is not null)
union all select {COLUMNS} from orders_src
  where order_id in (select new_id from pairs where not same and new_id is not null)"""


@query("load_scd2_checksum", f"with {ORDERS_CTE} {SCD2_SQL}")
def load_scd2_checksum(t: Tables):
    return inc.load_scd2_checksum(orders_src(t), orders_tgt(t), keys=["order_id"], audit=AUDIT).to_df()


@query("scd2_helper", f"with {ORDERS_CTE} {SCD2_SQL}".replace("union all", "union"))
def scd2_helper(t: Tables):
    return inc.scd2_helper(orders_src(t), orders_tgt(t), keys=["order_id"], audit=AUDIT)


@query(
    "scd1_helper",
    f"""with {ORDERS_CTE},
keyed_src as (select *, order_id + 1000000 as row_id from orders_src),
keyed_tgt as (select *, order_id + 5000000 as row_id from orders_tgt)
select row_id, {COLUMNS} from keyed_tgt t
  where is_active = 1 and exists (select 1 from keyed_src s where s.order_id = t.order_id and s.hashkey = t.hashkey)
union select s.row_id, {_rows('s')} from keyed_src s
  where not exists (select 1 from keyed_tgt t where t.is_active = 1 and s.order_id = t.order_id)
union select t.row_id, s.order_id, s.cust_id, s.status, s.total, s.order_date, s.hashkey, date '2024-02-01',
  s.delete_date, timestamp '2024-02-01 00:00:00', 1, s.is_incremental
  from keyed_src s join keyed_tgt t on s.order_id = t.order_id and t.is_active = 1 and s.hashkey <> t.hashkey""",
)
def scd1_helper(t: Tables):
    src = orders_src(t).withColumn("row_id", F.col("order_id") + 1000000)
    tgt = orders_tgt(t).withColumn("row_id", F.col("order_id") + 5000000)
    return inc.scd1_helper(src, tgt, keys=["order_id"], id_col="row_id", audit=AUDIT)


@query(
    "load_key_date",
    f"""with {ORDERS_CTE},
newest as (select order_id, max(order_date) as new_date, max(hashkey) as new_hash from orders_src group by 1),
oldest as (select order_id, min(order_date) as old_date, max(hashkey) as old_hash from orders_tgt
           where is_active = 1 group by 1),
sides as (select t.*, coalesce(t.is_active = 1 and t.order_date <= n.new_date and t.hashkey <> n.new_hash, false) as gone
          from orders_tgt t left join newest n using (order_id))
select {_rows('s')} from orders_src s left join oldest o using (order_id)
  where o.old_hash is null or (o.old_hash <> s.hashkey and o.old_date <= s.order_date)
union all select {_closed('0')} from sides where gone
union all select {_rows('', '0')} from sides where not gone""",
)
def load_key_date(t: Tables):
    return inc.load_key_date(
        orders_src(t), orders_tgt(t), keys=["order_id"], date_col="order_date", audit=AUDIT
    ).to_df()


@query(
    "load_multi_key_date",
    f"""with {ORDERS_CTE},
act as (select * from orders_tgt where is_active = 1),
tk as (select *, exists (select 1 from orders_src s where s.order_id = a.order_id) as first_hit from act a),
sk as (select *, exists (select 1 from act a where s.order_id = a.order_id) as first_hit,
              exists (select 1 from act a where s.cust_id = a.cust_id) as second_hit from orders_src s),
closed as (select * from tk t where exists (
  select 1 from orders_src s where (case when t.first_hit then s.order_id = t.order_id else s.cust_id = t.cust_id end)
  and t.order_date <= s.order_date and t.hashkey <> s.hashkey))
select {_rows('s')} from sk s where (not first_hit and not second_hit) or exists (
  select 1 from act t where (case when s.first_hit then s.order_id = t.order_id else s.cust_id = t.cust_id end)
  and t.order_date <= s.order_date and t.hashkey <> s.hashkey)
union all select {_closed('0')} from closed
union all select {_rows('', '0')} from (
  select {COLUMNS} from orders_tgt except select {COLUMNS} from closed) k""",
)
def load_multi_key_date(t: Tables):
    return inc.load_multi_key_date(
        orders_src(t),
        orders_tgt(t),
        key_sets=[["order_id"], ["cust_id"]],
        date_col="order_date",
        audit=AUDIT,
    ).to_df()


@query(
    "load_partitioned",
    f"""with {ORDERS_CTE}
select {_rows('t', '0')} from orders_tgt t where status = 'F' and is_active = 1
  and exists (select 1 from orders_src s where s.status = 'F' and s.hashkey = t.hashkey)
union all select {_closed('1')} from orders_tgt t where status = 'F' and is_active = 1
  and not exists (select 1 from orders_src s where s.status = 'F' and s.hashkey = t.hashkey)
union all select {_rows('', '0')} from orders_tgt where status = 'F' and is_active = 0
union all select {COLUMNS} from orders_src s where status = 'F' and not exists (
  select 1 from orders_tgt t where t.status = 'F' and t.is_active = 1 and t.hashkey = s.hashkey)
union all select {COLUMNS} from orders_src where status = 'O'
union all select {COLUMNS} from orders_tgt where status = 'O'
union all select {COLUMNS} from orders_src where status = 'P'
union all select {COLUMNS} from orders_tgt where status not in ('F', 'O', 'P')""",
)
def load_partitioned(t: Tables):
    plans = {"f": ("checksum_all", {}), "o": ("append", {}), "p": ("overwrite", {})}
    return inc.load_partitioned(orders_src(t), orders_tgt(t), column="status", plans=plans, audit=AUDIT)


@query(
    "row_hash",
    """select distinct l_orderkey, l_partkey, l_linenumber, l_returnflag, cast(l_shipdate as date) as ship_date,
 md5(concat_ws('-', cast(l_linenumber as varchar), cast(l_orderkey as varchar), cast(l_partkey as varchar),
   l_returnflag, cast(cast(l_shipdate as date) as varchar))) as hashkey,
 date '2024-02-01' as add_date, date '9999-12-31' as delete_date,
 timestamp '2024-02-01 00:00:00' as last_modified_date, 1 as is_active, 1 as is_incremental
from lineitem""",
)
def row_hash(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", F.col("l_shipdate").cast("date").alias("ship_date")
    )
    return stamp(rows, AUDIT, hash_cols=hash_columns(rows))


@query("load_touched_files", ORACLES["load_checksum_all"])
def load_touched_files(t: Tables):
    """The checksum load into a versioned table, of which only files with changes are written."""
    path = sink.scratch_folder(t.spark)
    by_range = orders_tgt(t).repartitionByRange(8, "order_id")
    versions.versioned_publish(by_range, path, "is_active", rebalance=False)
    touched.load_touched_files(t.spark, orders_src(t), path, strategy="checksum_all", audit=AUDIT)
    return versions.read_version(t.spark, path).select(*orders_src(t).columns)


@query("load_key_date_touched", ORACLES["load_key_date"])
def load_key_date_touched(t: Tables):
    path = sink.scratch_folder(t.spark)
    versions.versioned_publish(orders_tgt(t).repartitionByRange(8, "order_id"), path, "is_active", rebalance=False)
    touched.load_touched_files(t.spark, orders_src(t), path, strategy="key_date", audit=AUDIT, keys=["order_id"], date_col="order_date")
    return versions.read_version(t.spark, path).select(*orders_src(t).columns)


@query(
    "load_counts",
    f"""with {ORDERS_CTE}, kept as (
  select is_active = 1 and hashkey not in (select hashkey from orders_src) as closed from orders_tgt)
select 'source' as name, count(*) as n from orders_src
union all select 'history', count(*) from kept
union all select 'closed', count(*) from kept where closed
union all select 'inserted', count(*) from orders_src where hashkey not in (select hashkey from orders_tgt where is_active = 1)
union all select 'joined', count(*) from orders_src""",
)
def load_counts(t: Tables):
    """The counts of a load and of a lookup before it, taken by the write itself."""
    metrics = Metrics()
    nations = t.customer.select(F.col("c_custkey").alias("_cust"), "c_nationkey")
    src = orders_src(t)
    joined = metrics.count("joined", src.join(nations, src.cust_id == nations["_cust"], "left"))
    src = joined.select(*src.columns)
    out = inc.metered_load(src, orders_tgt(t), metrics, mode="active", strategy="checksum_all", audit=AUDIT)
    guards = [metrics.same_rows("joined", "source"), metrics.not_empty("source", "nothing to load")]
    sink.publish(out, sink.scratch_folder(t.spark), guards=guards)
    closed = t.spark.createDataFrame([("closed", metrics.of("history")["closed"])], "name string, n long")
    return metrics.frame(t.spark).unionByName(closed)


@query("load_by_key_pruned", ORACLES["load_by_key"])
def load_by_key_pruned(t: Tables):
    return inc.load_by_key(orders_src(t), orders_tgt(t), keys=["order_id"], audit=AUDIT, prune=True).to_df()


@query("load_multi_key_date_pruned", ORACLES["load_multi_key_date"])
def load_multi_key_date_pruned(t: Tables):
    sets = [["order_id"], ["cust_id"]]
    return inc.load_multi_key_date(
        orders_src(t), orders_tgt(t), key_sets=sets, date_col="order_date", audit=AUDIT, prune=True
    ).to_df()


BATCHES = ("o_orderstatus = 'F'", "o_orderpriority = '1-URGENT'", "o_orderstatus = 'P'")
BATCH_SQL = "select o_orderkey, o_custkey, o_orderstatus, {total} as total from orders where {where}"


@query(
    "load_stream",
    f"""with {", ".join(f"b{i} as (" + BATCH_SQL.format(total=f"cast(o_totalprice as double) + {i}", where=w) + ")" for i, w in enumerate(BATCHES))},
ends as (
  select *, 0 as batch, o_orderkey in (select o_orderkey from b1) as closed, 0 as flag from b0
  union all select *, 1, o_orderkey in (select o_orderkey from b2), case when o_orderkey in (select o_orderkey from b2) then 1 else 0 end from b1
  union all select *, 2, false, 1 from b2)
select o_orderkey, o_custkey, o_orderstatus, total, date '2024-02-01' as add_date,
  case when closed then date '2024-01-31' else date '9999-12-31' end as delete_date,
  case when closed then 0 else 1 end as is_active, flag as is_incremental from ends""",
)
def load_stream(t: Tables):
    """Three deliveries through a stream, all of them handed over a second time."""
    folder = sink.scratch_folder(t.spark)
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "total"]
    for number, where in enumerate(BATCHES):
        rows = t.orders.withColumn("total", F.col("o_totalprice").cast("double") + number)
        sink.publish(rows.filter(where).select(*columns), f"{folder}/in/day={number}", files=1)
    schema = t.spark.read.parquet(f"{folder}/in/day=0").schema

    def prepare(batch, audit):
        rows = batch.select(*columns)
        return stamp(rows, audit, hash_cols=hash_columns(rows))

    for run in ("first", "again"):
        feed = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/day=*")
        done = feeds.start_loading(feed, f"{folder}/t", f"{folder}/{run}", "orders", prepare, lambda _: AUDIT, "by_key", keys=["o_orderkey"])
        done.awaitTermination()
    return versions.read_version(t.spark, f"{folder}/t").select(*columns, "add_date", "delete_date", "is_active", "is_incremental")
