"""Mean and sample deviation of the price over tumbling windows of several widths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import as_micros, floor_micros, from_micros
from ..widths import SIX, nested


def window_stats(ticks: DataFrame, widths=SIX, rollup: bool = False) -> DataFrame:
    """(timestamp, symbol, window, avg_price, std_price); `timestamp` is the window's end.

    The deviation is NULL for a single tick and 0.0 where the price stood still.

    Streaming input is read once and aggregated in one state, where each window
    closes as soon as the watermark passes its own end. Batch input is read and
    shuffled once for all widths, too:

    * by default every tick is counted towards each width in a single
      aggregate, combined before the shuffle;
    * with `rollup` ticks are first reduced to one row per shortest window,
      and these are merged into the longer ones. Worth it on dense feeds (many
      ticks per shortest window), above all when files are not in time order:
      the shuffle then carries at most one row per tick instead of one per
      tick and width.
    """
    widths = nested(widths)
    if ticks.isStreaming:
        return _closed(ticks, widths).withColumn("timestamp", end_of("last_instant")).select(
            "timestamp", "symbol", "window", "avg_price", "std_price"
        )
    stats = _rolled_up(ticks, widths) if rollup else _counted_per_width(ticks, widths)
    return stats.withColumn("timestamp", from_micros(F.col("end"))).select(
        "timestamp", "symbol", "window", "avg_price", "std_price"
    )


def stats_array(ticks: DataFrame, widths=SIX, rollup: bool = False) -> DataFrame:
    """(timestamp, symbol, windows): the statistics of all windows ending at one instant.

    On a stream this is one query: windows are regrouped on the event time of
    their last instant, which keeps the watermark, so none is late.
    """
    if not ticks.isStreaming:
        return regroup_stats(window_stats(ticks, widths, rollup))
    closed = _closed(ticks, nested(widths))
    grouped = closed.groupBy("last_instant", "symbol").agg(_windows_by_width())
    return grouped.select(end_of("last_instant").alias("timestamp"), "symbol", "windows")


def regroup_stats(stats: DataFrame) -> DataFrame:
    """`stats_array` for statistics that were stored or sent as messages in between.

    What has no time, such as a message that could not be read, belongs to no
    instant and is let go; on a stream it would be kept for ever.
    """
    return stats.filter(F.col("timestamp").isNotNull()).groupBy("timestamp", "symbol").agg(_windows_by_width())


def late_for(ticks: DataFrame, watermark_ms: int, widths=SIX) -> DataFrame:
    """`ticks` with `late_for`: the labels of windows that a watermark had closed before the tick came, shortest first."""
    us = as_micros(F.col("timestamp"))
    closed = [
        F.when(floor_micros(us, w.micros) + F.lit(w.micros) <= F.lit(watermark_ms * 1000), F.lit(w.label))
        for w in nested(widths)
    ]
    return ticks.withColumn("late_for", F.array_compact(F.array(*closed)))


def width_seconds(label: Column, widths=SIX) -> Column:
    """The length behind a window label, 0 for an unknown one."""
    seconds = F.lit(0)
    for w in widths:
        seconds = F.when(label == w.label, w.seconds).otherwise(seconds)
    return seconds


def _windows_by_width() -> Column:
    # At most one element per width.
    element = F.struct(
        width_seconds(F.col("window")).alias("seconds"), "window", "avg_price", "std_price"
    )
    return F.transform(
        F.sort_array(F.collect_list(element)),
        lambda e: F.struct(
            e["window"].alias("window"),
            e["avg_price"].alias("avg_price"),
            e["std_price"].alias("std_price"),
        ),
    ).alias("windows")


def last_instant(end: Column, table: DataFrame, column: str = "timestamp") -> Column:
    """The last microsecond before `end` (microseconds), as event time under the watermark of `column`.

    Spark marks the column of a watermark in its metadata and closes a group, or lets go of a
    row of a join, once the watermark passes the marked key. Marked here is the
    end of a window of any width, as `window` does it for the one it makes.
    """
    return from_micros(end - F.lit(1)).alias("last_instant", metadata=watermark_of(table, column))


def watermark_of(table: DataFrame, column: str = "timestamp") -> dict:
    """What tells Spark that a column is event time, empty for none."""
    return dict(table.schema[column].metadata)


def end_of(instant: str) -> Column:
    return from_micros(as_micros(F.col(instant)) + F.lit(1))


def _closed(ticks: DataFrame, widths) -> DataFrame:
    """One aggregate of a stream over windows of all widths, each closed at its own last instant."""
    if not watermark_of(ticks):
        raise ValueError("a stream of ticks needs a watermark on `timestamp`")
    per_width = _per_width(ticks, widths).select(
        "symbol",
        "price",
        "window",
        last_instant(F.col("us") - F.pmod("us", "width") + F.col("width"), ticks),
    )
    return per_width.groupBy("last_instant", "symbol", "window").agg(*_moments())


def _counted_per_width(ticks: DataFrame, widths) -> DataFrame:
    end = F.col("us") - F.pmod("us", "width") + F.col("width")
    return _per_width(ticks, widths).groupBy("symbol", "window", end.alias("end")).agg(*_moments())


def _moments() -> list[Column]:
    """Mean and sample deviation; a price that stood still is its own mean, with a deviation of exactly 0.0."""
    still = F.min("price") == F.max("price")
    return [
        F.when(still, F.min("price")).otherwise(F.avg("price")).alias("avg_price"),
        F.when(still & (F.count("price") > 1), F.lit(0.0)).otherwise(F.stddev_samp("price")).alias("std_price"),
    ]


def _per_width(ticks: DataFrame, widths) -> DataFrame:
    """(symbol, price, us, window, width): each tick once per width."""
    spans = F.array(
        *[F.struct(F.lit(w.label).alias("window"), F.lit(w.micros).alias("width")) for w in widths]
    )
    return ticks.filter(F.col("timestamp").isNotNull()).select(
        "symbol", "price", as_micros(F.col("timestamp")).alias("us"), F.inline(spans)
    )


def _rolled_up(ticks: DataFrame, widths) -> DataFrame:
    shortest, longest = widths[0], widths[-1]
    us = as_micros(F.col("timestamp"))
    slots = (
        ticks.filter(F.col("timestamp").isNotNull())
        .groupBy("symbol", floor_micros(us, shortest.micros).alias("start"))
        .agg(
            F.count("price").alias("n"),
            F.avg("price").alias("mean"),
            F.var_pop("price").alias("variance"),
            F.min("price").alias("lo"),
            F.max("price").alias("hi"),
        )
    )
    # A price that stood still is its own mean, exactly; this keeps the
    # deviation of longer still windows at 0.0.
    mean = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("mean"))
    block = floor_micros(F.col("start"), longest.micros)
    # Slots of a block meet in one partition, and everything below happens there. Means are
    # taken from one of the block's own, so that sums of squares do not cancel.
    placed = slots.select(
        "symbol", "start", "n", mean.alias("mean"), (F.col("variance") * F.col("n")).alias("m2"), block.alias("block")
    ).repartition("symbol", "block")
    origin = F.first("mean", ignorenulls=True).over(
        Window.partitionBy("symbol", "block").orderBy("start").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
    )
    spans = F.array(
        *[
            F.struct(
                F.lit(w.label).alias("window"),
                (floor_micros(F.col("start"), w.micros) + F.lit(w.micros)).alias("end"),
            )
            for w in widths
        ]
    )
    off = F.col("mean") - F.col("origin")
    merged = (
        placed.withColumn("origin", origin)
        .select("symbol", "block", "origin", "n", "m2", off.alias("off"), F.inline(spans))
        .groupBy("symbol", "block", "window", "end")
        .agg(
            F.first("origin").alias("origin"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("off")).alias("first"),
            F.sum(F.coalesce("m2", F.lit(0.0)) + F.col("n") * F.col("off") * F.col("off")).alias("second"),
        )
    )
    n, first = F.col("n"), F.col("first")
    deviation = F.greatest(F.col("second") - first * first / n, F.lit(0.0))
    return merged.select(
        "symbol",
        "end",
        "window",
        F.when(n > 0, F.col("origin") + first / n).alias("avg_price"),
        F.when(n > 1, F.sqrt(deviation / (n - 1))).alias("std_price"),
    )
