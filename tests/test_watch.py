"""Queries that fail on purpose, outputs written once, late ticks aside, counts, and state looked at."""

import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import tickloom as tl
from data import SIX_TICKS, at, ticks
from test_stream import LATENESS, SENTINELS, feed, folder, real, score_stream, tick_stream, write_files
from tickloom import schemas
from tickloom.operators import REASONS, check_ticks, late_for, reason_counts
from tickloom.plans import Endpoint, first_move_job, late_job, validation_job
from tickloom.streaming import (
    Commits,
    Job,
    Observed,
    encode,
    largest_keys,
    operators,
    route_by_window,
    start_sink,
    state_by_partition,
    state_rows,
    to_outputs,
)


def test_outputs_are_written_once(spark):
    """A run that fails at the third of six outputs, and goes on, has no row twice and none missing."""
    stream, expected = score_stream(spark)
    out, checkpoint, commits = folder(), folder(), folder()
    failing = [True]

    def options(label):
        if label == "5m" and failing:
            raise OSError("no room for 5m")
        return {"path": f"{out}/{label}"}

    write = to_outputs("json", options, commits=commits)
    with pytest.raises(StreamingQueryException):
        route_by_window(stream, write, checkpoint, available_now=True).awaitTermination()
    failing.clear()
    route_by_window(stream, write, checkpoint, available_now=True).awaitTermination()
    for label in tl.LABELS:
        found = spark.read.schema(expected.schema).json(f"{out}/{label}")
        assert found.count() == expected.filter(F.col("window") == label).count() > 0


def test_first_moves_are_written_once(spark):
    """The output for falls fails once, after the one for rises was written."""
    rows = feed(200, 5, 120)
    source = Endpoint("text", path=write_files(spark, rows + SENTINELS, 2))
    higher = Endpoint("text", path=folder(), keyed=False)
    state, path = folder(), folder()

    class Failing(Endpoint):
        def append(self, messages, batch_id):
            raise OSError("the output is gone")

    with pytest.raises(StreamingQueryException):
        first_move_job(spark, source, higher, Failing("text", path=path, keyed=False), state, available_now=True)[0].awaitTermination()
    lower = Endpoint("text", path=path, keyed=False)
    first_move_job(spark, source, higher, lower, state, available_now=True)[0].awaitTermination()
    batch = tl.first_move(ticks(spark, rows))
    for end, schema, pick in ((higher, schemas.HIGHER, tl.first_higher), (lower, schemas.LOWER, tl.first_lower)):
        sent = tl.decode(tl.read_messages(spark, "text", path=end.path, streaming=False), schema)
        assert sorted(map(str, sent.collect())) == sorted(map(str, pick(batch).collect()))


def test_commits(spark):
    done = Commits(spark, folder())
    assert not done.has("a", 0)
    done.add("a", 0)
    done.add("b", 0)
    done.add("a", 1)
    assert done.has("a", 1) and not done.has("a", 0) and done.has("b", 0) and not done.has("b", 1)


def test_one_failure_stops_the_job(spark):
    rows = spark.readStream.format("rate").option("rowsPerSecond", 5).load()

    def fails(batch, batch_id):
        if batch_id >= 1:
            raise OSError("the disk is full")

    well = [start_sink(rows, "noop", checkpoint=folder(), name=f"well{i}") for i in range(2)]
    ill = rows.writeStream.queryName("ill").foreachBatch(fails).option("checkpointLocation", folder()).start()
    with Job(spark, [*well, ill]) as job:
        with pytest.raises(RuntimeError, match="ill.*(?s:.*)disk is full"):
            job.wait(120)
        assert job.failure[0] == "ill"
        for q in well:
            assert q.awaitTermination(30)
        with pytest.raises(RuntimeError):
            job.wait_any(1)


def test_waiting_for_all_or_any(spark):
    path = write_files(spark, SIX_TICKS, 1)
    rows = spark.readStream.format("rate").load()
    ends = start_sink(tick_stream(spark, path), "noop", checkpoint=folder(), available_now=True)
    stays = start_sink(rows, "noop", checkpoint=folder())
    with Job(spark, [ends, stays]) as job:
        assert job.wait_any(60) and job.wait(0.5) is False
        threading.Timer(0.5, job.stop).start()
        assert job.wait(60) and job.failure is None


def spoilt(spark):
    path = write_files(spark, SIX_TICKS, 2)
    bad = ["not json", '{"symbol":"A"}', '{"symbol":"A","price":"x","timestamp":"2025-01-01T00:00:00Z"}', "[]", "not json"]
    spark.createDataFrame([(v,) for v in bad], "value string").coalesce(1).write.mode("append").text(path)
    return path


def test_checks_of_a_stream_from_one_query(spark):
    """Good ticks, rejected messages and the counts per reason, each message read once."""
    path = spoilt(spark)
    good, bad = Endpoint("text", path=folder(), keyed=False), Endpoint("text", path=folder(), keyed=False)
    counts = Observed("validation")
    spark.streams.addListener(counts)
    try:
        (query,) = validation_job(spark, Endpoint("text", {"maxFilesPerTrigger": "1"}, path), good, bad, folder(), available_now=True)
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(counts)
    batch = check_ticks(tl.read_messages(spark, "text", path=path, streaming=False))
    expected = {r.reason or "good": r["count"] for r in batch.groupBy("reason").count().collect()}
    assert {k: v for k, v in counts.total.items() if v} == expected
    assert set(counts.total) == {"good", *REASONS} and counts.batches == 3
    assert sum(p["numInputRows"] for p in query.recentProgress) == sum(expected.values())
    sent = tl.decode(tl.read_messages(spark, "text", path=good.path, streaming=False), schemas.TICK)
    assert sorted(map(str, sent.collect())) == sorted(map(str, ticks(spark).collect()))
    rejected = spark.read.schema("value string, reason string").json(bad.path)
    assert {r.reason: r["count"] for r in rejected.groupBy("reason").count().collect()} == {
        k: v for k, v in expected.items() if k != "good"
    }


def test_counts_of_a_batch(spark):
    from pyspark.sql import Observation

    seen = Observation("checks")
    reason_counts(check_ticks(tl.read_messages(spark, "text", path=spoilt(spark), streaming=False)), seen).write.format(
        "noop"
    ).mode("overwrite").save()
    assert seen.get["good"] == 6 and seen.get["no price"] == 1 and sum(seen.get.values()) == 11


def test_late_ticks_are_kept_aside(spark):
    path = folder()
    write_files(spark, [("A", 1.0, at(10)), ("A", 2.0, at(100))], 1, path)
    write_files(spark, [("A", 4.0, at(91)), ("A", 8.0, at(15)), ("A", 9.0, at(50))], 1, path)
    out, state = folder(), folder()

    def to(name):
        return lambda rows, batch_id: rows.write.mode("append").json(f"{out}/{name}")

    (query,) = late_job(tick_stream(spark, path), to("kept"), to("late"), state, available_now=True)
    query.awaitTermination()
    kept = spark.read.json(f"{out}/kept")
    late = {r.price: r.late_for for r in spark.read.json(f"{out}/late").collect()}
    # The watermark of the second batch is at 90 s.
    assert sorted(r.price for r in kept.collect()) == [1.0, 2.0, 4.0]
    assert late == {8.0: ["30s", "1m"], 9.0: ["30s", "1m"]}
    assert late_for(ticks(spark), 0).filter("size(late_for) > 0").count() == 0


def test_state_by_key_and_partition(spark):
    """What the operators keep: windows and scores by symbol, times of first moves by second."""
    rows = [("A" if i % 4 else "B", float(i % 9), at(i)) for i in range(240)]
    path = write_files(spark, rows, 2)
    checkpoint = folder()
    stats = tl.window_stats(tick_stream(spark, path))
    start_sink(stats, "noop", checkpoint=checkpoint, available_now=True).awaitTermination()
    assert [r.operatorName for r in operators(spark, checkpoint).collect()] == ["stateStoreSave"]
    kept = state_rows(spark, checkpoint)
    n = kept.count()
    # Open windows of either symbol: one of each width, and what the lateness leaves open.
    assert {r.symbol for r in largest_keys(spark, checkpoint, ["symbol"]).collect()} == {"A", "B"}
    assert sum(r["rows"] for r in state_by_partition(spark, checkpoint).collect()) == n
    assert 12 <= n <= 20

    moves = folder()
    start_sink(tl.first_move(tick_stream(spark, path)), "noop", checkpoint=moves, available_now=True).awaitTermination()
    names = [r.operatorName for r in operators(spark, moves).orderBy("operatorId").collect()]
    assert names == ["stateStoreSave"] * len(names) and len(names) >= 2
    for operator in range(len(names)):
        assert state_rows(spark, moves, operator).count() <= 60


def test_state_of_the_join_by_key(spark):
    """Ticks of an hour lie on several keys, and the statistics on all of these."""
    rows = [("A", float(i % 9), at(i * 5)) for i in range(240)]
    path, checkpoint = write_files(spark, rows, 1), folder()
    moving = folder()
    encode(tl.stats_array(ticks(spark, [("B", 1.0, at(1))]))).write.mode("append").text(moving)
    arrays = tl.decode(tl.read_messages(spark, "text", path=moving), schemas.MOVING, LATENESS)
    scored = tl.zscore_rows(tick_stream(spark, path), tl.explode_stats(arrays))
    start_sink(scored, "noop", checkpoint=checkpoint, available_now=True).awaitTermination()
    assert {r.operatorName for r in operators(spark, checkpoint).collect()} == {"symmetricHashJoin"}
    left = state_rows(spark, checkpoint, joinSide="left")
    assert left.count() > 240
    salts = {r[0] for r in left.select(F.col("key")[left.schema["key"].dataType.names[-1]]).distinct().collect()}
    assert salts == {0, 1, 2, 3}
    assert len(state_by_partition(spark, checkpoint, joinSide="left").collect()) > 1
