"""Settings the plans rely on at scale."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE splits the partitions of an over-full key while joining, also where the
# next step aggregates by that key (an extra exchange after the partial
# aggregate is then far smaller than the split partition). Joins are broadcast
# only where the measured size is below spark.sql.autoBroadcastJoinThreshold.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings to a running session."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark
