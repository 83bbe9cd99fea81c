"""Session settings that suit the flows; a caller's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Spark's own defaults are right for the rest (adaptive execution, skew joins,
# partition coalescing are on).
SUGGESTED = {
    # bars keep a percentile sketch per group: at the default of 128 groups per task
    # the hash aggregate would fall back to sorting all remaining ticks
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    # state of streams off the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def builder(app_name: str) -> SparkSession.Builder:
    made = SparkSession.builder.appName(app_name)
    for key, value in SUGGESTED.items():
        made = made.config(key, value)
    return made
