"""Session settings the jobs rely on; a caller's own session works as well."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # Run-time re-planning: partition coalescing, size-checked broadcasts and
    # the splitting of skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


# Initial shuffle partitions for each core of a cluster; adaptive execution merges what is small.
PARTITIONS_A_CORE = 4
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app: str = "tallyrate", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    context = spark.sparkContext
    if not context.master.startswith("local") and not spark.conf.get(INITIAL, None):
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(INITIAL, str(max(usual, PARTITIONS_A_CORE * context.defaultParallelism)))
    return spark
