"""The streaming jobs: ticks -> window arrays -> z-score arrays -> outputs per window,
and ticks -> first moves. Each reads messages, applies the operators and starts queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import (
    check_ticks,
    first_higher,
    first_lower,
    first_move,
    good_ticks,
    late_for,
    reason_counts,
    regroup_stats,
    rejected_messages,
    stats_array,
    window_stats,
    zscore_array,
    zscore_rows,
)
from ..sources import decode, explode_stats, explode_zscores, read_messages
from ..streaming import encode, route, route_by_window, start_sink, watermark_of_batch, write_each
from ..widths import SIX

LATENESS = "10 seconds"


@dataclass(frozen=True)
class Endpoint:
    """Where messages come from or go to: a topic, a folder, or whatever the format names.

    `keyed` tells whether it takes a key column beside the value, as topics do.
    """

    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None
    keyed: bool = True

    def messages(self, rows: DataFrame, key: str | None = None) -> DataFrame:
        return encode(rows, key if self.keyed else None)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_messages(spark, self.format, self.options, self.path)

    def append(self, messages: DataFrame, batch_id: int) -> None:
        """Write the batch of a stream; sinks that know `batch_id` can tell a repeated one."""
        writer = messages.write.format(self.format).mode("append").options(**self.options)
        writer.option("batchId", str(batch_id)).save(self.path)

    def write(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return start_sink(messages, self.format, self.options, checkpoint, self.path, **trigger)


def moving_job(
    spark: SparkSession,
    ticks: Endpoint,
    moving: Endpoint,
    checkpoint: str,
    stats: Endpoint | None = None,
    lateness: str = LATENESS,
    **trigger,
) -> list[StreamingQuery]:
    """Window statistics of the ticks as one array per instant and symbol.

    One query. With `stats` the statistics themselves are also published, and
    the arrays are formed from there by a second query.
    """
    source = decode(ticks.read(spark), schemas.TICK, lateness)
    if stats is None:
        arrays = stats_array(source)
        return [moving.write(moving.messages(arrays, "symbol"), f"{checkpoint}/moving", **trigger)]
    first = stats.write(
        stats.messages(window_stats(source), "symbol"), f"{checkpoint}/moving_window", **trigger
    )
    published = decode(stats.read(spark), schemas.WINDOW_STAT, lateness)
    second = moving.write(
        moving.messages(regroup_stats(published), "symbol"), f"{checkpoint}/moving_grouped", **trigger
    )
    return [first, second]


def zscore_job(
    spark: SparkSession,
    ticks: Endpoint,
    moving: Endpoint,
    zscores: Endpoint,
    checkpoint: str,
    lateness: str = LATENESS,
    **trigger,
) -> list[StreamingQuery]:
    """Scores of the ticks against the published window arrays, one array per tick time."""
    prices = decode(ticks.read(spark), schemas.TICK, lateness)
    arrays = decode(moving.read(spark), schemas.MOVING, lateness)
    scored = zscore_array(zscore_rows(prices, explode_stats(arrays)))
    return [zscores.write(zscores.messages(scored, "symbol"), f"{checkpoint}/zscore", **trigger)]


def first_move_job(
    spark: SparkSession,
    ticks: Endpoint,
    higher: Endpoint,
    lower: Endpoint,
    checkpoint: str,
    lateness: str = LATENESS,
    horizon: int = 20,
    fill: float | None = None,
    partition_cols: tuple[str, ...] = (),
    **trigger,
) -> list[StreamingQuery]:
    """Gaps to the first higher and the first lower price, each to an output without keys.

    One query: each batch is written to both outputs. A batch that is repeated
    after a failure is written only where it was not, by the records beside the checkpoint.
    """
    prices = decode(ticks.read(spark), schemas.TICK, lateness)
    moves = first_move(prices, horizon, fill, partition_cols)

    def both(batch: DataFrame, batch_id: int) -> None:
        writes = {
            "higher": lambda: higher.append(higher.messages(first_higher(batch)), batch_id),
            "lower": lambda: lower.append(lower.messages(first_lower(batch)), batch_id),
        }
        write_each(batch, batch_id, writes, f"{checkpoint}/first_move_written")

    return [route(moves, both, f"{checkpoint}/first_move", **trigger)]


def validation_job(
    spark: SparkSession,
    messages: Endpoint,
    good: Endpoint,
    rejected: Endpoint,
    checkpoint: str,
    **trigger,
) -> list[StreamingQuery]:
    """Tick messages checked: good ticks to one output, rejected messages with their reason to another.

    One query, each batch read once and written once to each output. The numbers per reason
    come with its progress under the name `validation`; `streaming.Observed` adds them up.
    """
    checked = reason_counts(check_ticks(messages.read(spark)), "validation")

    def both(batch: DataFrame, batch_id: int) -> None:
        writes = {
            "good": lambda: good.append(good.messages(good_ticks(batch), "symbol"), batch_id),
            "rejected": lambda: rejected.append(rejected.messages(rejected_messages(batch)), batch_id),
        }
        write_each(batch, batch_id, writes, f"{checkpoint}/validation_written")

    return [route(checked, both, f"{checkpoint}/validation", **trigger)]


def late_job(
    ticks: DataFrame,
    kept: Callable[[DataFrame, int], None],
    late: Callable[[DataFrame, int], None],
    checkpoint: str,
    widths=SIX,
    **trigger,
) -> list[StreamingQuery]:
    """Ticks that come after a window of theirs was closed, kept aside with the names of these windows.

    `ticks` is a stream with a watermark. One query: `kept` is given the ticks of a batch that
    are in time for all windows, `late` the others with `late_for`. A batch is held against the
    watermark that the query's offset log names for it, the one by which Spark drops rows, so
    a batch repeated after a failure is split alike, and is written only where it was not.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        mark = watermark_of_batch(batch.sparkSession, f"{checkpoint}/late", batch_id)
        told = late_for(batch, mark, widths)
        writes = {
            "kept": lambda: kept(told.filter(F.size("late_for") == 0).drop("late_for"), batch_id),
            "late": lambda: late(told.filter(F.size("late_for") > 0), batch_id),
        }
        write_each(batch, batch_id, writes, f"{checkpoint}/late_written")

    return [route(ticks, split, f"{checkpoint}/late", **trigger)]


def loader_job(
    spark: SparkSession,
    zscores: Endpoint,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    console: bool = False,
    **trigger,
) -> list[StreamingQuery]:
    """Published score arrays as rows, routed by window label in one query.

    `write` is a router such as `to_folders` or `to_outputs`. `console` also
    prints the rows, in a query of its own.
    """
    rows = explode_zscores(decode(zscores.read(spark), schemas.ZSCORES))
    queries = [route_by_window(rows, write, f"{checkpoint}/loader", **trigger)]
    if console:
        queries.append(start_sink(rows, "console", {"truncate": "false"}, **trigger))
    return queries
