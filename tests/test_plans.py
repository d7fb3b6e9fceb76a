"""Plan shapes that have to hold at scale, and inputs with one hot key."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import tickloom as tl
from data import ticks

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange (?:hash|range|single|rr)", plan(df), re.I))


def feed(spark):
    return driver._ticks(spark, SF_DIR)


OPERATORS = {
    "window_stats": (tl.window_stats, 1),
    "rollup": (lambda t: tl.window_stats(t, rollup=True), 2),
    "stats_array": (tl.stats_array, 2),
    # Ticks once; statistics per window, then per block, then per part.
    "tick_zscores": (tl.tick_zscores, 4),
    "zscores": (tl.zscores, 4),
    # As planned; what is shuffled alike is shuffled once, see below.
    "first_move": (tl.first_move, 10),
    "first_move_by_symbol": (lambda t: tl.first_move(t, partition_cols=("symbol",)), 10),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_shuffles_scans_and_no_python(spark, name):
    operator, shuffles = OPERATORS[name]
    text = plan(operator(feed(spark)))
    assert exchanges(operator(feed(spark))) == shuffles
    for never in ("CartesianProduct", "NestedLoop", "Python", "BroadcastExchange", "SinglePartition"):
        assert never not in text
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert set(re.findall(r"(\w+):", schema)) <= {"event_type", "value", "ts"}
        assert "user_id" not in schema and "props" not in schema
    assert "IsNotNull(ts)" in text


def test_first_move_shuffles_once(spark):
    """Times; their seconds; extremes of seconds; seconds a horizon before; trees; seconds and trees for their join."""
    for moves in (tl.first_move(feed(spark)), tl.first_move(feed(spark), partition_cols=("symbol",))):
        moves.collect()
        done = plan(moves).split("== Initial Plan ==")[0]
        assert len(re.findall(r"[- ] Exchange hash", done)) == 7, done


def test_first_move_reads_no_symbol_when_not_partitioned(spark):
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan(tl.first_move(feed(spark)))


def test_one_label_computes_one_width(spark):
    """A query for one window label neither computes the others nor repeats scores in the join."""
    for query in (driver.tick_queries()["zscore_30s"], driver.zscore_rows):
        text = plan(query(spark, SF_DIR))
        joins = [x for x in text.splitlines() if "SortMergeJoin" in x]
        assert joins and not any("std_price" in x or "size(" in x for x in joins)
    assert "1h" not in plan(driver.tick_queries()["zscore_30s"](spark, SF_DIR))


@pytest.mark.parametrize("operator", [tl.tick_zscores, tl.zscores])
def test_a_hot_hour_is_split(spark, operator):
    """A third of all ticks in one hour of one symbol; every tick comes out."""
    n = 60_000
    hot = F.col("id") % 3 == 0
    start = 1_735_689_600_000_000
    feed = spark.range(n).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("symbol"),
        (F.col("id") % 97).cast("double").alias("price"),
        F.timestamp_micros(
            start + F.when(hot, F.col("id") * 50_000).otherwise(F.col("id") * 3_000_000)
        ).alias("timestamp"),
    )
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = operator(feed)
        assert len(df.collect()) == n
        assert "skew=true" in plan(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_crowded_stretch_of_times_is_spread(spark):
    """A third of all times within one horizon: no task has more than four times the median."""
    n, start = 60_000, 1_735_689_600_000_000
    hot = F.col("id") % 3 == 0
    feed = spark.range(n).select(
        F.lit("A").alias("symbol"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("price"),
        F.timestamp_micros(start + F.when(hot, F.col("id") * 300).otherwise(30_000_000 + F.col("id") * 20_000)).alias("timestamp"),
    )
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        moves = tl.first_move(feed)
        tasks = moves.groupBy(F.spark_partition_id().alias("task")).count().collect()
        rows = sorted(r["count"] for r in tasks)
        assert sum(rows) == n
        assert rows[-1] <= 4 * rows[len(rows) // 2]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_first_move_with_hot_times_and_a_hot_second(spark):
    """Neither ticks of one time nor a crowded second are compared pair by pair."""
    start = 1_735_689_600_000_000
    same = spark.range(200_000).select(
        (F.col("id") % 1000).cast("double").alias("price"), F.lit(start).alias("us")
    )
    rising = spark.range(200_000).select(
        (F.col("id") + 2000).cast("double").alias("price"), (F.lit(start + 5_000_000) + F.col("id")).alias("us")
    )
    rows = same.unionAll(rising).select(
        F.lit("A").alias("symbol"), "price", F.timestamp_micros("us").alias("timestamp")
    )
    moves = tl.first_move(rows).groupBy("higher_window", "lower_window").count().collect()
    found = {(r.higher_window, r.lower_window): r["count"] for r in moves}
    assert found == {(5.0, None): 1, (0.0, None): 199_999, (None, None): 1}
