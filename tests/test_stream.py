"""Streams against batch: the same function over the same rows must give the same result."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

import tickloom as tl
from data import SCHEMA, SIX_TICKS, at, ticks
from tickloom import schemas
from tickloom.operators import zscore
from tickloom.plans import Endpoint, first_move_job, loader_job, moving_job, zscore_job
from tickloom.streaming import encode, route_by_window, start_sink, to_folders, to_outputs

LATENESS = "10 seconds"
END = 7200
# Ticks long after the last real one, which push the watermark past its windows.
SENTINELS = [("~", 0.0, at(END * 10)), ("~", 0.0, at(END * 20))]


def folder():
    return tempfile.mkdtemp(prefix="tickloom-test-")


def feed(n=400, seed=11, seconds=END, symbols="AB"):
    r = random.Random(seed)
    times = sorted(r.sample(range(seconds * 100), n))
    return [(r.choice(symbols), float(r.randint(1, 30)), at(t / 100)) for t in times]


def write_files(spark, rows, files, path=None):
    """The rows as messages, in so many files, oldest first."""
    path = path or folder()
    size = -(-len(rows) // files)
    for i in range(0, len(rows), size):
        part = spark.createDataFrame(rows[i : i + size], SCHEMA).coalesce(1)
        encode(part).write.mode("append").text(path)
    return path


def tick_stream(spark, path, lateness=LATENESS):
    messages = tl.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, path)
    return tl.decode(messages, schemas.TICK, lateness)


def run(df, checkpoint=None):
    """Work off a stream and give back (rows, progress of each batch)."""
    out = folder()
    query = start_sink(df, "parquet", checkpoint=checkpoint or folder(), path=out, available_now=True)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out), query.recentProgress


def real(df):
    return df.filter(F.col("symbol") != "~") if "symbol" in df.columns else df


def rounded(df):
    def fix(c, t):
        if t == "double":
            return F.round(c, 8).alias(c)
        if t.startswith("array"):
            # JSON text for comparison, scores rounded.
            return F.to_json(F.transform(c, lambda e: F.struct(*[
                (F.round(e[f], 8) if "price" in f else e[f]).alias(f)
                for f in ("window", "avg_price", "std_price", "zscore_price") if f in t
            ]))).alias(c)
        return F.col(c)
    return df.select(*[fix(c, t) for c, t in df.dtypes])


def assert_same(stream, batch):
    a, b = rounded(stream), rounded(batch)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() > 0


def test_window_stats(spark):
    rows = feed()
    path = write_files(spark, rows + SENTINELS, 4)
    found, _ = run(tl.window_stats(tick_stream(spark, path)))
    assert_same(real(found), tl.window_stats(ticks(spark, rows)))


def test_stats_array_in_one_query(spark):
    rows = feed()
    path = write_files(spark, rows + SENTINELS, 4)
    found, progress = run(tl.stats_array(tick_stream(spark, path)))
    assert_same(real(found), tl.stats_array(ticks(spark, rows)))
    assert all(op["numRowsDroppedByWatermark"] == 0 for p in progress for op in p["stateOperators"])


@pytest.mark.parametrize("keys", [(), ("symbol",)])
def test_first_move(spark, keys):
    # Dense enough for moves, and with times that repeat.
    rows = feed(500, 5, 300) + [("B", 15.0, at(100)), ("A", 2.0, at(100)), ("A", 28.0, at(100))]
    rows.sort(key=lambda r: r[2])
    path = write_files(spark, rows + SENTINELS, 5)
    found, _ = run(tl.first_move(tick_stream(spark, path), partition_cols=keys))
    expected = tl.first_move(ticks(spark, rows), partition_cols=keys)
    assert_same(found.filter(F.col("timestamp") < F.lit(at(END))), expected)
    assert expected.filter("higher_window > 0 and lower_window is not null").count() > 50


def test_first_move_filled(spark):
    path = write_files(spark, SIX_TICKS + SENTINELS, 2)
    found, _ = run(tl.first_move(tick_stream(spark, path), fill=20.0))
    found = found.filter(F.col("timestamp") < F.lit(at(END)))
    assert_same(found, tl.first_move(ticks(spark), fill=20.0))


def interleaved(spark, rows, files):
    """Folders of ticks and of the statistics as they would be published, file by file."""
    tick_path, moving_path = folder(), folder()
    arrays = tl.stats_array(ticks(spark, rows)).cache()
    step = END / files
    for i in range(files):
        low, high = at(i * step), at((i + 1) * step)
        write_files(spark, [r for r in rows if low <= r[2] < high], 1, tick_path)
        closed = arrays.filter((F.col("timestamp") > F.lit(low)) & (F.col("timestamp") <= F.lit(high)))
        encode(closed.orderBy("timestamp").coalesce(1)).write.mode("append").text(moving_path)
    for s in SENTINELS:
        write_files(spark, [s], 1, tick_path)
        closed = tl.stats_array(ticks(spark, [s]))
        encode(closed.coalesce(1)).write.mode("append").text(moving_path)
    return tick_path, moving_path


def test_zscore_rows_and_array_with_bounded_state(spark):
    rows = feed(300)
    tick_path, moving_path = interleaved(spark, rows, 4)
    prices = tick_stream(spark, tick_path)
    moving = tl.decode(
        tl.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, moving_path),
        schemas.MOVING, LATENESS)
    scored = tl.zscore_rows(prices, tl.explode_stats(moving))
    batch = ticks(spark, rows)
    expected = tl.zscore_rows(batch, tl.window_stats(batch))

    found, _ = run(tl.zscore_array(scored))
    assert_same(real(found), tl.zscore_array(expected))

    found, progress = run(scored)
    assert_same(real(found), expected)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    # Once the watermark is hours past the ticks none of them is kept.
    assert max(kept) > 300 and kept[-1] < 30


def test_state_of_the_score_join_follows_the_windows(spark):
    """Each tick is kept until its windows close: far from six copies for an hour and the two batches it takes."""
    n, files = 1600, 12
    rows = feed(n, 8, symbols="A")
    tick_path, moving_path = interleaved(spark, rows, files)
    moving = tl.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, moving_path)
    scored = tl.zscore_rows(
        tick_stream(spark, tick_path), tl.explode_stats(tl.decode(moving, schemas.MOVING, LATENESS))
    )
    found, progress = run(scored)
    batch = ticks(spark, rows)
    assert_same(real(found), tl.zscore_rows(batch, tl.window_stats(batch)))
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(kept) <= 0.4 * 6 * n * (3600 / END + 2 / files)


def test_ticks_are_read_once(spark):
    """All widths come from one reading and one state; short windows are out before long ones close."""
    rows = [("A", float(i % 7), at(i * 10)) for i in range(180)]
    path = write_files(spark, rows, 6)
    found, progress = run(tl.window_stats(tick_stream(spark, path)))
    assert sum(p["numInputRows"] for p in progress) == len(rows)
    assert all(len(p["stateOperators"]) == 1 for p in progress)
    closed = {r.window: r["count"] for r in found.groupBy("window").count().collect()}
    assert closed["30s"] > 50 and closed["1m"] > 20 and closed["5m"] >= 5 and "1h" not in closed


def test_still_prices_have_no_deviation(spark):
    rows = [("A", 0.1, at(i * 7)) for i in range(400)]
    path = write_files(spark, rows + SENTINELS, 3)
    found, _ = run(tl.window_stats(tick_stream(spark, path)))
    assert {r.std_price for r in real(found).collect()} <= {0.0, None}
    assert real(found).filter("window = '30m' and std_price = 0.0").count() == 2


def test_late_ticks(spark):
    path = folder()
    write_files(spark, [("A", 1.0, at(10)), ("A", 2.0, at(100))], 1, path)
    # A batch is held against the watermark the batch before it began with.
    write_files(spark, [("A", 2.0, at(100))], 1, path)
    # That is 90 s: the first comes inside it, the second too late.
    write_files(spark, [("A", 4.0, at(91)), ("A", 8.0, at(15))], 1, path)
    write_files(spark, SENTINELS, 2, path)
    found, progress = run(tl.window_stats(tick_stream(spark, path), tl.pick("30s")))
    rows = {r.timestamp.astimezone(dt.timezone.utc): r.avg_price for r in real(found).collect()}
    assert rows == {at(30): 1.0, at(120): 8.0 / 3}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    assert dropped == 1


def test_restart_from_checkpoint(spark):
    rows = feed(200)
    path, out, checkpoint = folder(), folder(), folder()

    def work_off():
        query = start_sink(tl.window_stats(tick_stream(spark, path)), "parquet",
                           checkpoint=checkpoint, path=out, available_now=True)
        query.awaitTermination()

    write_files(spark, rows[:100], 2, path)
    work_off()
    write_files(spark, rows[100:] + SENTINELS, 2, path)
    work_off()
    work_off()
    assert_same(real(spark.read.parquet(out)), tl.window_stats(ticks(spark, rows)))


def score_stream(spark):
    rows = feed(50)
    path = folder()
    encode(tl.zscores(ticks(spark, rows)), "symbol").select("value").repartition(3).write.mode(
        "overwrite").text(path)
    messages = tl.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, path)
    stream = tl.explode_zscores(tl.decode(messages, schemas.ZSCORES, LATENESS))
    return stream, tl.explode_zscores(tl.zscores(ticks(spark, rows)))


def test_route_to_folders(spark):
    stream, expected = score_stream(spark)
    out = folder()
    route_by_window(stream, to_folders(out), folder(), available_now=True).awaitTermination()
    found = spark.read.parquet(out)
    assert_same(found.select(*expected.columns), expected)
    # A batch handed over twice replaces itself.
    again = to_folders(out)
    batch = found.filter("batch_id = 1").select(*expected.columns).cache()
    n = batch.count()
    again(batch, 1)
    assert n > 0 and spark.read.parquet(out).count() == expected.count()
    assert spark.read.parquet(f"{out}/batch_id=1/window=5m").count() * 6 == n


def test_route_to_one_output_per_label(spark):
    stream, expected = score_stream(spark)
    out = folder()
    write = to_outputs("json", lambda label: {"path": f"{out}/zscore-{label}"})
    route_by_window(stream, write, folder(), available_now=True).awaitTermination()
    for label in tl.LABELS:
        found = spark.read.schema("window string").json(f"{out}/zscore-{label}")
        assert found.filter(F.col("window") == label).count() == found.count() == expected.count() / 6


def test_jobs_end_to_end(spark):
    rows = feed(150)
    tick_path = write_files(spark, rows + SENTINELS, 1)
    paths = {k: folder() for k in ("stats", "moving", "zscores", "higher", "lower", "routed")}
    state = folder()
    at_once = Endpoint("text", path=tick_path)
    # Text takes one column; topics take the key as well.
    out = {k: Endpoint("text", path=p, keyed=False) for k, p in paths.items()}

    def finish(queries):
        for q in queries:
            q.awaitTermination()

    finish(moving_job(spark, at_once, out["moving"], state, available_now=True))
    finish(zscore_job(spark, at_once, out["moving"], out["zscores"], state, available_now=True))
    finish(first_move_job(spark, at_once, out["higher"], out["lower"], state, available_now=True))
    finish(
        loader_job(spark, out["zscores"], to_folders(paths["routed"]), state, console=True, available_now=True)
    )

    batch = ticks(spark, rows)
    moving = tl.decode(tl.read_messages(spark, "text", path=paths["moving"], streaming=False), schemas.MOVING)
    assert_same(real(moving), tl.stats_array(batch))
    routed = real(spark.read.parquet(paths["routed"]))
    scored = tl.explode_zscores(tl.zscores(batch))
    assert_same(routed.select(*scored.columns), scored)
    for name, schema, pick in (("higher", schemas.HIGHER, tl.first_higher), ("lower", schemas.LOWER, tl.first_lower)):
        sent = tl.decode(tl.read_messages(spark, "text", path=paths[name], streaming=False), schema)
        assert_same(sent, pick(tl.first_move(batch)))


def test_stats_published_and_regrouped(spark):
    rows = feed(100)
    path = write_files(spark, rows + SENTINELS, 1)
    stats, _ = run(tl.window_stats(tick_stream(spark, path)))
    published = folder()
    encode(stats.orderBy("timestamp").coalesce(1)).write.mode("overwrite").text(published)
    stream = tl.decode(tl.read_messages(spark, "text", path=published), schemas.WINDOW_STAT, LATENESS)
    found, _ = run(tl.regroup_stats(stream))
    expected = tl.stats_array(ticks(spark, rows))
    assert_same(real(found), expected)


def test_moving_job_publishes_statistics_first(spark):
    """Both queries of the job, the second fed by the first; run again until it has all."""
    rows = feed(60, 3, 600)
    tick_path, stats, moving, state = write_files(spark, rows + SENTINELS, 1), folder(), folder(), folder()
    ends = [Endpoint("text", path=p, keyed=False) for p in (tick_path, moving, stats)]
    for _ in range(2):
        for q in moving_job(spark, ends[0], ends[1], state, ends[2], available_now=True):
            q.awaitTermination()
    sent = tl.read_messages(spark, "text", path=stats, streaming=False)
    assert_same(real(tl.decode(sent, schemas.WINDOW_STAT)), tl.window_stats(ticks(spark, rows)))
    found = real(tl.decode(tl.read_messages(spark, "text", path=moving, streaming=False), schemas.MOVING))
    expected = tl.stats_array(ticks(spark, rows))
    assert rounded(found).exceptAll(rounded(expected)).count() == 0


def test_keyed_messages(spark):
    """What a topic is sent: the symbol as key, where the endpoint takes one."""
    stats = tl.window_stats(ticks(spark))
    keyed = Endpoint("kafka").messages(stats, "symbol")
    assert keyed.columns == ["key", "value"] and keyed.filter("key = 'A'").count() == stats.count()
    assert Endpoint("text", keyed=False).messages(stats, "symbol").columns == ["value"]


def test_processing_time(spark):
    path = write_files(spark, SIX_TICKS + SENTINELS, 2)
    query = start_sink(
        tl.window_stats(tick_stream(spark, path)), "noop", checkpoint=folder(), processing_time="1 second"
    )
    try:
        query.processAllAvailable()
        assert query.isActive and query.lastProgress is not None
    finally:
        query.stop()


def test_unreadable_messages_are_not_kept(spark):
    """Messages without a time leave no state behind, on a stream, and no row in a batch."""
    path = folder()
    rows = feed(30, 2, 120)
    stats = encode(tl.window_stats(ticks(spark, rows + SENTINELS))).orderBy("value").coalesce(1)
    junk = spark.range(50).selectExpr("concat('junk ', id) AS value").coalesce(1)
    for part in (stats, junk, junk, junk):
        part.write.mode("append").text(path)
    messages = tl.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, path)
    _, progress = run(tl.regroup_stats(tl.decode(messages, schemas.WINDOW_STAT, LATENESS)))
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert kept[-1] <= 7 and kept[-1] == kept[-2]
    read = tl.decode(junk, schemas.WINDOW_STAT)
    assert tl.regroup_stats(read).count() == 0
    scores = read.select("timestamp", "symbol", "window", F.lit(1.0).alias("zscore_price"))
    assert tl.zscore_array(scores).count() == 0


@pytest.mark.parametrize("n", [1000, 4000])
def test_first_move_of_a_falling_price(spark, n):
    """The hardest case: no later price is higher. The work per tick must not grow with the ticks."""
    rows = spark.range(n).select(
        F.lit("A").alias("symbol"),
        (F.lit(n) - F.col("id")).cast("double").alias("price"),
        F.timestamp_micros(F.lit(1_735_689_600_000_000) + (F.col("id") * (19_000_000 // n))).alias("timestamp"),
    )
    found = _stream_search(rows)
    assert_same(found, tl.first_move(rows))


def _stream_search(rows):
    import sys

    module = sys.modules["tickloom.operators.first_move"]

    extremes = rows.groupBy("timestamp").agg(F.min("price").alias("lo"), F.max("price").alias("hi"))
    return module._search_stream(extremes, [], 20).select(
        "timestamp", *[F.col(c).cast("double").alias(c) for c in module._GAPS]
    )


def test_streams_are_not_scored_by_the_batch_path(spark):
    path = write_files(spark, SIX_TICKS, 1)
    with pytest.raises(ValueError):
        tl.tick_zscores(tick_stream(spark, path))


def test_state_in_rocksdb(spark):
    rows = feed(200, 7, 300)
    path = write_files(spark, rows + SENTINELS, 2)
    tl.configure(spark, streaming=True)
    try:
        moves, progress = run(tl.first_move(tick_stream(spark, path)))
        stats, _ = run(tl.stats_array(tick_stream(spark, path)))
    finally:
        for key in tl.session.STREAMING_SETTINGS:
            spark.conf.unset(key)
    assert any("rocksdbGetCount" in op["customMetrics"] for p in progress for op in p["stateOperators"])
    batch = ticks(spark, rows)
    assert_same(moves.filter(F.col("timestamp") < F.lit(at(END))), tl.first_move(batch))
    assert_same(real(stats), tl.stats_array(batch))


def test_validation_of_a_stream(spark):
    path = write_files(spark, SIX_TICKS, 2)
    spark.createDataFrame([("not json",), ('{"symbol":"A"}',)], "value string").write.mode(
        "append").text(path)
    good, rejected = tl.validate_ticks(tl.read_messages(spark, "text", path=path))
    found, _ = run(good.withWatermark("timestamp", LATENESS))
    assert_same(found, ticks(spark).select(*found.columns))
    found, _ = run(rejected)
    assert sorted(r.reason for r in found.collect()) == ["no price", "not JSON"]


def test_dense_ticks_wait_together_for_their_windows(spark):
    """What the score join keeps of a dense feed grows with its windows, not six times with its ticks."""
    rows = [("AB"[i % 2], float(i * 7 % 31), at(i // 500 * 900 + i % 500 * 0.12)) for i in range(4000)]
    rows += [(None, 1.0, at(5)), ("A", None, at(6))]
    tick_path, moving_path = interleaved(spark, rows, 4)
    moving = tl.read_messages(spark, "text", {"maxFilesPerTrigger": "1"}, moving_path)
    scored = tl.zscore_rows(
        tick_stream(spark, tick_path), tl.explode_stats(tl.decode(moving, schemas.MOVING, LATENESS))
    )
    found, progress = run(scored)
    batch = ticks(spark, rows)
    assert_same(real(found), tl.zscore_rows(batch, tl.window_stats(batch)))
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert 0 < max(kept) < 2000


def test_packed_ticks_are_all_there(spark):
    rows = [("AB"[i % 2], float("nan") if i % 9 == 0 else float(i), at(i * 0.01)) for i in range(3000)] + [(None, 1.0, at(1)), ("A", None, at(2))]
    table = zscore.packed(ticks(spark, rows), 7_500_000, most=10, held=500)
    assert table.filter("size(us) > 10 or size(us) <> size(price)").count() == 0
    found = table.select("symbol", "slot", F.inline(F.arrays_zip("us", "price"))).collect()
    assert all(r.slot == r.us - r.us % 7_500_000 for r in found)
    expected = [(s, round(t.timestamp() * 1e6), str(p)) for s, p, t in rows if s and p is not None]
    assert sorted((r.symbol, r.us, str(r.price)) for r in found) == sorted(expected)
    assert zscore.packed(ticks(spark, rows[:0]), 7_500_000).count() == 0


def test_scores_wait_together_for_their_arrays(spark):
    """What `zscore_array` keeps grows with shortest windows, not with ticks; odd labels, scores and symbols as in a batch."""
    r = random.Random(3)
    labels = [*tl.LABELS, None, "odd", "x"]
    times = [0, 0.5, 1, 29.9, 30, 31, 3599, 3600, 5000, -7] + [40 + i / 100 for i in range(900)]
    rows = [
        (at(r.choice(times)), r.choice(["A", "B", None]), r.choice(labels), r.choice([None, float("nan"), 1.5, -2.0, r.random()]))
        for _ in range(3000)
    ] + [(None, "A", "30s", 1.0)]
    closing = [(at(90_000 * day), "~", "30s", 1.0) for day in (1, 2)]
    schema, path = "timestamp timestamp, symbol string, window string, zscore_price double", folder()
    for part in (rows, closing[:1], closing[1:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    found, progress = run(tl.zscore_array(stream.withWatermark("timestamp", LATENESS)))
    expected = tl.zscore_array(spark.createDataFrame(rows, schema))
    assert_same(found.filter("symbol is null or symbol <> '~'"), expected)
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert expected.count() > 1000 and 0 < max(kept) <= 3 * 8 + 2
