"""Session settings and durable cut points.

Everything in the library is a lazy DataFrame plan.  The few operators that
need two passes over the *same* partitioning cut the plan with a reliable
checkpoint, so a lost executor never changes the result.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Applied by tune(): every value is a runtime setting, none is tied to a
# cluster size.  forceOptimizeSkewedJoin lets AQE split a hot join key even
# when the split costs one more exchange further down.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime settings the operators are written for."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "strataload", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark (no web page, no port)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def _shared_folder(spark: SparkSession) -> str:
    """The folder for cut plans: the cluster's own, else (local mode) a new one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder before using two-pass operators")
    return tempfile.mkdtemp(prefix="strataload-checkpoint-")


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder.

    Row order and partitioning of the result are those of ``df`` and stay the
    same for every later read, also after an executor is lost.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_folder(spark))
    return df.checkpoint(eager=True)
