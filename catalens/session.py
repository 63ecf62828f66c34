"""Session settings the operators are written for; a cluster's own settings win where they are set."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits skewed joins and sizes reduce partitions; start from many.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # quantile sketches of many groups: stay in the hash map instead of sorting the rows by group
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app: str = "catalens", **extra: str) -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b
