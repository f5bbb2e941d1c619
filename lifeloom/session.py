"""Session settings the library is tuned for. All of them can change at run time."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # All sources are UTC; calendar days and weeks must not depend on where a job runs.
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles methods above 8,000 bytes of bytecode. Wide projections over
    # events exceed that when fused into one stage, and run faster as separate operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Splits skewed joins and skewed days on write, merges small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming sessions of a busy device are merged per task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
