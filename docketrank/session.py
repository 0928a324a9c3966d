"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What the results depend on: UTC dates, and ANSI arithmetic so that a bigint sum that
# overflows stops the job instead of wrapping around.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# The JVM never compiles a method of more than 8000 bytes of bytecode. The staging projections
# are wide enough to make such methods, which then run interpreted; with this limit Spark
# generates split methods for them instead (measured: 1.6 times faster staging).
CODEGEN_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# A union that kept the partitions of its parts would put the hash tables of all parts' totals, of their merge
# and of what is made from it in one task; without, the merge has a shuffle between.
PLAN_SETTINGS = {"spark.sql.unionOutputPartitioning": "false"}

# Shuffles start with so many partitions unless told otherwise, and AQE merges the small ones. AQE
# does not split the partitions of an aggregate, so a large job wants a high number to begin with.
INITIAL_PARTITIONS = 4000

# What only the speed depends on; hot join partitions are split.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what results and code generation need on a session somebody else made.

    Partitioning and memory stay as that session has them.
    """
    for key, value in {**RESULT_SETTINGS, **CODEGEN_SETTINGS, **PLAN_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "docketrank", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session for a job or a test; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_SETTINGS, **CODEGEN_SETTINGS, **PLAN_SETTINGS, **SCALE_SETTINGS}.items():
        builder = builder.config(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config(initial, str(INITIAL_PARTITIONS))
    return builder.getOrCreate()
