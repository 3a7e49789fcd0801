"""Session settings the plans are made for. Any Spark session gives the same results."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows cost far more CPU than their bytes suggest: keep partitions small.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # The JVM only interprets methods above 8000 bytes; many-regex projections run
    # faster as split projections than as one such method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Plans have thousands of small expressions; skip recording a call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
