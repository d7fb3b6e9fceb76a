"""Checks a tick has to pass before it is analysed."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import parse_time
from ..schemas import TICK_TEXT


# The reasons for which messages are rejected, in the order in which they are tested.
REASONS = ("not JSON", "no symbol", "no price", "price is not a number", "price is NaN", "no valid time")


def validate_ticks(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split tick messages into good ticks and rejected messages with a reason."""
    checked = check_ticks(messages)
    return good_ticks(checked), rejected_messages(checked)


def good_ticks(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNull()).select("symbol", "price", "timestamp")


def rejected_messages(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason").isNotNull()).select("value", "reason")


def reason_counts(checked: DataFrame, name: str) -> DataFrame:
    """`checked` as it is, which reports on the way how many ticks were good and how many rejected for what.

    A batch gives the numbers to an `Observation`, a stream to its listeners, batch by batch.
    """
    reasons = [F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS]
    return checked.observe(name, F.count(F.when(F.col("reason").isNull(), 1)).alias("good"), *reasons)


def check_ticks(messages: DataFrame) -> DataFrame:
    """(value, symbol, price, timestamp, reason): tick messages read, and why one is none.

    A tick needs a symbol, a price that reads as a number (quoted or not) other
    than NaN, and a time. Nothing raises: every row keeps the message text.
    """
    schema = StructType([*TICK_TEXT.fields, StructField("_malformed", StringType(), True)])
    text = F.col("value").cast("string")
    data = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_malformed"})
    read = messages.select(text.alias("value"), data.alias("data")).select(
        "value",
        F.col("data.symbol").alias("symbol"),
        F.col("data.price").alias("price_text"),
        # Spark reads a bare NaN or Infinity as text in quotes.
        F.regexp_replace("data.price", r'^"([-+]?(?:NaN|Infinity|INF))"$', "$1")
        .try_cast("double")
        .alias("price"),
        parse_time(F.col("data.timestamp")).alias("timestamp"),
        (F.col("data").isNull() | F.col("data._malformed").isNotNull()).alias("malformed"),
    )
    tests = (
        F.col("malformed"),
        F.col("symbol").isNull(),
        F.col("price_text").isNull(),
        F.col("price").isNull(),
        F.isnan("price"),
        F.col("timestamp").isNull(),
    )
    reason = F.lit(None).cast("string")
    for name, failed in reversed(list(zip(REASONS, tests))):
        reason = F.when(failed, name).otherwise(reason)
    return read.select("value", "symbol", "price", "timestamp", reason.alias("reason"))
