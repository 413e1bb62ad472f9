"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Source times are UTC.
    "spark.sql.session.timeZone": "UTC",
    # The tables are wide. HotSpot never compiles methods above this size, so a
    # stage that would need one runs faster as separate, split projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A join key with very many rows is split even where the grouping after the
    # join would otherwise use its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where one side of a join is small in every partition, the wide other side is not sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
}
# Bytes that a task reads, at most. Rows of these tables shrink some tenfold when written, and sorts
# and groupings hold them as they are: a task needs tens of times the bytes that it reads.
AT_MOST = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in AT_MOST.items():
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark
