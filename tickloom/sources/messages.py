"""Reading and decoding JSON messages; works the same on batch and streaming input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import parse_time

# Defaults per source format. A new consumer reads a topic from its start.
_DEFAULTS = {"kafka": {"startingOffsets": "earliest"}}


def read_messages(
    spark: SparkSession,
    format: str,
    options: dict[str, str] | None = None,
    path: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Messages of any source with a `value` column, such as a topic or a folder of text files."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(format).options(**{**_DEFAULTS.get(format, {}), **(options or {})})
    loaded = reader.load(path) if path else reader.load()
    return loaded.select(F.col("value").cast("string").alias("value"))


def decode(messages: DataFrame, schema: StructType, lateness: str | None = None) -> DataFrame:
    """One column per schema field, `timestamp` parsed to TIMESTAMP.

    A message that is not JSON gives a row of NULLs. `lateness` sets the
    event-time watermark, for streaming input.
    """
    fields = messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data")
    ).select("data.*")
    decoded = fields.withColumn("timestamp", parse_time(F.col("timestamp")))
    return decoded.withWatermark("timestamp", lateness) if lateness else decoded


def ticks_from(
    table: DataFrame, symbol: str, price: str, timestamp: str, lateness: str | None = None
) -> DataFrame:
    """Ticks out of any table; a TIMESTAMP_NTZ column is read in the session zone."""
    ticks = table.select(
        F.col(symbol).cast("string").alias("symbol"),
        F.col(price).cast("double").alias("price"),
        F.col(timestamp).cast("timestamp").alias("timestamp"),
    )
    return ticks.withWatermark("timestamp", lateness) if lateness else ticks


def explode_stats(moving: DataFrame) -> DataFrame:
    """One row per window out of the array form; rows without windows vanish."""
    return moving.select("timestamp", "symbol", F.inline("windows"))


def explode_zscores(arrays: DataFrame) -> DataFrame:
    """One row per z-score out of the array form; rows without z-scores vanish."""
    # Not `inline`: Spark would infer that the array is not empty, and evaluate it, with
    # all scores in it, once more in the join it comes from.
    rows = arrays.select("timestamp", "symbol", F.posexplode_outer("zscores").alias("place", "score"))
    return rows.filter(F.col("place").isNotNull()).select("timestamp", "symbol", "score.*")
