"""Small tick sets with answers worked out by hand."""

import datetime as dt

UTC = dt.timezone.utc
DAY = dt.datetime(2025, 1, 1, tzinfo=UTC)
SCHEMA = "symbol string, price double, timestamp timestamp"


def at(seconds: float) -> dt.datetime:
    return DAY + dt.timedelta(microseconds=round(seconds * 1_000_000))


SIX_TICKS = [
    ("A", 10.0, at(5)),
    ("A", 14.0, at(10)),
    ("A", 12.0, at(29.9)),
    ("A", 20.0, at(30)),
    ("A", 20.0, at(55)),
    ("A", 8.0, at(60)),
]

SIX_STATS = {
    ("30s", at(30)): (12.0, 2.0),
    ("30s", at(60)): (20.0, 0.0),
    ("30s", at(90)): (8.0, None),
    ("1m", at(60)): (15.2, 4.604346),
    ("1m", at(120)): (8.0, None),
    ("5m", at(300)): (14.0, 5.059644),
    ("15m", at(900)): (14.0, 5.059644),
    ("30m", at(1800)): (14.0, 5.059644),
    ("1h", at(3600)): (14.0, 5.059644),
}

# Per tick: score in 30s, in 1m, in every longer window.
SIX_SCORES = {
    at(5): (-1.0, -1.129368, -0.790569),
    at(10): (1.0, -0.260623, 0.0),
    at(29.9): (0.0, -0.694996, -0.395285),
    at(30): (None, 1.042493, 1.185854),
    at(55): (None, 1.042493, 1.185854),
    at(60): (None, None, -1.185854),
}

SIX_MOVES = {
    at(5): (5.0, None),
    at(10): (20.0, 19.0),
    at(29.9): (1.0, None),
    at(30): (None, None),
    at(55): (None, 5.0),
    at(60): (None, None),
}


def ticks(spark, rows=SIX_TICKS):
    return spark.createDataFrame(rows, SCHEMA)


def utc(value: dt.datetime) -> dt.datetime:
    """What Spark collected, as an aware time."""
    return value.astimezone(UTC)


def near(a, b, digits=6):
    if a is None or b is None:
        return a is None and b is None
    return round(a - b, digits) == 0
