"""Runtime SQL settings the batch plans rely on; none of them needs a new session."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Event times are instants; zone-less source columns are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot (symbol, hour) is split between tasks even where the rows are
    # regrouped right after the join, at the price of one more shuffle then.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# For streaming jobs: keep join and window state off the heap.
STREAMING_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession, streaming: bool = False) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if streaming:
        for key, value in STREAMING_SETTINGS.items():
            spark.conf.set(key, value)
    return spark
