"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows here are small and costly to compare: let small stages keep all cores busy.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
    # The filter Spark infers below explode() would build the exploded array a second time.
    "spark.sql.optimizer.excludedRules": "org.apache.spark.sql.catalyst.optimizer.InferFiltersFromGenerate",
    # The JVM never compiles a method above 8000 bytes; a stage that would need one runs
    # faster as separate, compiled projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Splits a join partition that a hot key has made large; see README on skew.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Columns of few distinct values take a hundredth of their size in files: 10 MB there may be a GB at the driver.
    "spark.sql.autoBroadcastJoinThreshold": "256k",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def apply(spark: SparkSession) -> SparkSession:
    """Set the same on a session that is already running."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
