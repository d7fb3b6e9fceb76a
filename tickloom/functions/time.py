"""Event-time arithmetic on microseconds since the epoch, independent of the session zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; NULL when it is not a time, whatever the ANSI setting.

    Takes 0 to 6 fraction digits, `Z`, and offsets. A format pattern would not:
    producers leave the fraction out on whole seconds.
    """
    return F.try_to_timestamp(text)


def as_micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us)


def floor_micros(us: Column, step: int) -> Column:
    """Round down to a multiple of `step`, also before 1970."""
    return us - F.pmod(us, F.lit(step))


def whole_seconds(us: Column) -> Column:
    return F.floor(floor_micros(us, 1_000_000) / F.lit(1_000_000)).cast("long")
