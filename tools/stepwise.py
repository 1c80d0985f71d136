"""One plan and one write against a step-by-step load with temporary tables.

python tools/stepwise.py [copies]   (copies of the sf0.1 orders table, default 20)

The step-by-step form stages the source, counts and appends every bucket on its
own and then copies the result over the target, as a chain of batch steps would.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from strataload.catalog.frames import AUDIT, orders_src, orders_tgt
from strataload.catalog.registry import Tables
from strataload.operators import incremental as inc
from strataload.session import local_session
from strataload.sources.sink import publish


def stepwise(spark, src, tgt, on, base):
    """Presence load on ``on``, bucket by bucket."""
    stage, work, final = (f"{base}/{n}" for n in ("stage", "work", "final"))
    src.count()
    src.write.parquet(stage)
    src = spark.read.parquet(stage)
    src.count()
    active = tgt.filter("is_active = 1")
    closing = {"delete_date": F.lit(AUDIT.closing_date), "last_modified_date": AUDIT.now(), "is_active": F.lit(0)}
    buckets = [
        active.join(src.select(*on), on, "inner").withColumn("is_incremental", F.lit(0)),
        tgt.filter("is_active = 0").withColumn("is_incremental", F.lit(0)),
        active.join(src.select(*on, F.lit(1).alias("_s")), on, "left").filter("_s is null").withColumns(closing),
        src.join(active.select(*on, F.lit(1).alias("_t")), on, "left").filter("_t is null"),
    ]
    for bucket in buckets:
        bucket.count()
        bucket.select(*src.columns).write.mode("append").parquet(work)
    spark.read.parquet(work).write.mode("overwrite").parquet(final)
    return spark.read.parquet(final)


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(8, app="stepwise", **{"spark.sql.shuffle.partitions": "32"})
    t = Tables(spark, "/root/testdata/sf0.1")
    for name, make in (("src", orders_src), ("tgt", orders_tgt)):
        # every copy gets its own order numbers and hashes
        rows = make(t).repartition(32).withColumn("_shift", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        rows = rows.withColumn("order_id", F.col("order_id") + F.col("_shift") * 10_000_000)
        rows.withColumn("hashkey", F.md5(F.concat_ws("-", "hashkey", "_shift"))).drop("_shift").write.parquet(f"{base}/{name}")
    src, tgt = spark.read.parquet(f"{base}/src"), spark.read.parquet(f"{base}/tgt")
    print(f"{src.count()} source rows, {tgt.count()} target rows")
    loads = {
        "checksum_all": (["hashkey"], lambda: inc.load_checksum_all(src, tgt, audit=AUDIT)),
        "scd2_checksum": (["order_id", "hashkey"], lambda: inc.load_scd2_checksum(src, tgt, keys=["order_id"], audit=AUDIT)),
    }
    for name, (on, load) in loads.items():
        for attempt in ("cold", "warm"):
            start = time.perf_counter()
            publish(load().to_df(), f"{base}/{name}-{attempt}")
            ours = time.perf_counter() - start
            start = time.perf_counter()
            other = stepwise(spark, src, tgt, on, f"{base}/{name}-{attempt}-steps")
            steps = time.perf_counter() - start
            mine = spark.read.parquet(f"{base}/{name}-{attempt}")
            print(f"{name} {attempt}: one plan {ours:.2f}s, step by step {steps:.2f}s, rows {mine.count()} / {other.count()}")


if __name__ == "__main__":
    main()
