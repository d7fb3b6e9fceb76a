"""

`events` plays the tick feed: event_type is the symbol, value the price, ts the time.
Doubles are rounded to 8 places on both sides, and arrays are compared as rows
with their position.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tickloom as tl
from tickloom import schemas
from tickloom.plans import Endpoint, late_job, validation_job
from tickloom.streaming import encode, route_by_window, start_sink, to_folders

LATENESS = "10 seconds"
_BATCH = 5_000_000  # ticks
_DDL = "symbol string, price double, timestamp timestamp"


def entry(spark: SparkSession) -> DataFrame:
    """Every tick of sf0.001 scored against the six windows that hold it."""
    return zscore_rows(spark, "/root/testdata/sf0.001")


# -- helpers ---------------------------------------------------------------------------


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tl.configure(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return tl.ticks_from(events, "event_type", "value", "ts")


def _folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`, which has to be storage the cluster shares.

    Only a local master may leave that out: a temporary folder then, removed at the end.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tickloom-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tickloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _closing_symbol(ticks: DataFrame) -> str:
    """A symbol that the feed does not have: `~`, or more of them than any of its symbols is made of."""
    longest = F.max(F.when(F.col("symbol").rlike(r"\A~+\z"), F.length("symbol")))
    return "~" * (1 + (ticks.agg(longest).first()[0] or 0))


def _arrivals(spark: SparkSession, sf_dir: str, closing: str, late: bool = False, days: int = 2) -> list[DataFrame]:
    """The feed as it arrives: the first half of the time, the second, then ticks long after.

    The last ones, a day after each other, push the watermark past all windows, so that
    streams give whole results; their symbol is `closing`. With `late` every tenth tick of the
    two hours before the middle comes with the second half, and those without event_id do.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    ticks = _ticks(spark, sf_dir)
    bounds = ticks.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    if bounds[0] is None:
        return []
    middle = (bounds[0] + bounds[1]) // 2 // 1_000_000 * 1_000_000
    us = F.unix_micros("timestamp")
    first = us < middle
    if late:
        ticks = events.select(
            F.col("event_type").alias("symbol"),
            F.col("value").alias("price"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            "event_id",
        )
        tenth = F.coalesce(F.col("event_id") % 10 == 0, F.lit(True))
        first &= ~(tenth & (us >= middle - 7_200_000_000))
    columns = ["symbol", "price", "timestamp"]
    after = [
        spark.range(1).select(
            F.lit(closing).alias("symbol"),
            F.lit(0.0).alias("price"),
            F.timestamp_micros(F.lit(bounds[1] + day * 86_400_000_000)).alias("timestamp"),
        )
        for day in range(1, days + 1)
    ]
    return [ticks.filter(first).select(columns), ticks.filter(~first).select(columns), *after]


def _work_off(spark, sf_dir, *stages, late: bool = False, restart: bool = False) -> DataFrame:
    """Let ticks arrive, run the stages over them, and give what the last one has written.

    A stage takes the ticks and the folder in which those before it have left
    their results, as a stream of text or rows, and gives a stream. Each is one query that
    meets an arrival a batch; with `restart` a query ends after each arrival and goes on
    from its checkpoint with the next. So it is with arrivals of more than `_BATCH` ticks, too, which come in
    stretches of time then: state is of a batch and the windows that are open after it. With `late` ticks
    an arrival stays whole, as its end is what they are held against. What comes of the ticks at the end is left out.
    """
    tl.configure(spark)
    folder = _folder(spark)
    closing = _closing_symbol(_ticks(spark, sf_dir))
    # A stage's results close the windows of the next one a day later.
    arrivals = _arrivals(spark, sf_dir, closing, late, days=len(stages))
    if not arrivals:
        schema = stages[-1](_ticks(spark, sf_dir).withWatermark("timestamp", LATENESS), "").schema
        return spark.createDataFrame([], schema)
    first, largest = arrivals[0].count(), max(arrived.count() for arrived in arrivals)
    if largest > _BATCH and not late:
        arrivals, restart = _by_time(arrivals, folder), True
    # So many files for each arrival, which make up a batch; where an arrival may leave one out, a query ends after each.
    files = 1 + min(largest, 2 * _BATCH) // 250_000
    restart = restart or (files > 1 and first < 10_000 * files)
    like = _ticks(spark, sf_dir)
    schema, seen = None, 0
    while seen < len(arrivals):
        for arrived in arrivals[seen : seen + 1] if restart else arrivals:
            arrived.repartition(files).write.mode("append").parquet(f"{folder}/ticks")
            seen += 1
        for i, stage in enumerate(stages):
            stream = stage(_arriving(spark, like, folder, files), f"{folder}/{i - 1}")
            schema = stream.schema
            text = stream.columns == ["value"]
            with _state_partitions(spark, files):
                query = start_sink(
                    stream, "text" if text else "parquet", checkpoint=f"{folder}/state{i}", path=f"{folder}/{i}", available_now=True
                )
            query.awaitTermination()
    rows = spark.read.schema(schema).parquet(f"{folder}/{len(stages) - 1}")
    if "symbol" in rows.columns or "key" in rows.columns:
        return rows.filter(~F.col("symbol" if "symbol" in rows.columns else "key").eqNullSafe(closing))
    last = _ticks(spark, sf_dir).agg(F.max("timestamp")).first()[0]
    return rows.filter(F.col("timestamp") <= F.lit(last))


def _by_time(arrivals: list[DataFrame], folder: str) -> list[DataFrame]:
    """The same ticks in arrivals of about `_BATCH` at most, which follow each other in time; those of one time are together."""
    found = []
    for i, arrived in enumerate(arrivals):
        us, parts = F.unix_micros("timestamp"), -(-arrived.count() // _BATCH)
        if parts <= 1:
            found.append(arrived)
            continue
        shares = [k / parts for k in range(1, parts)]
        bounds = sorted(set(arrived.select(F.percentile_approx(us, shares, 10_000)).first()[0]))
        stretch = sum((us >= bound).cast("int") for bound in bounds)
        # A stretch may be one file, and tasks share a file by its row groups.
        parted = arrived.withColumn("stretch", stretch).write.option("parquet.block.size", 4 << 20)
        parted.partitionBy("stretch").parquet(f"{folder}/feed{i}")
        feed = arrived.sparkSession.read.schema(f"{_DDL}, stretch int").parquet(f"{folder}/feed{i}")
        found += [feed.filter(F.col("stretch") == k).drop("stretch") for k in range(len(bounds) + 1)]
    return found


@contextmanager
def _state_partitions(spark: SparkSession, files: int) -> Iterator[None]:
    """A query started within has state partitions for the cores and files of a batch, and no more than the session's number.

    Each costs several small files a batch, whatever is in it.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), max(spark.sparkContext.defaultParallelism, files)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _arriving(spark: SparkSession, like: DataFrame, folder: str, files: int = 1) -> DataFrame:
    reader = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files)
    return reader.parquet(f"{folder}/ticks").withWatermark("timestamp", LATENESS)


def _rounded(name: str) -> Column:
    value = F.round(F.col(name), 8)
    return F.when(value == 0, F.lit(0.0)).otherwise(value).alias(name)


def _plain(df: DataFrame) -> DataFrame:
    """Rounded doubles, and times without zone (they are UTC) as in the source table."""
    return df.select(
        *[
            _rounded(c) if t == "double" else F.col(c).cast("timestamp_ntz").alias(c)
            if t == "timestamp" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def _positions(df: DataFrame, array: str) -> DataFrame:
    rows = df.select("timestamp", "symbol", F.posexplode(array).alias("position", "e"))
    return rows.select("timestamp", "symbol", F.col("position").cast("long").alias("position"), "e.*")


def _messages(ticks: DataFrame) -> DataFrame:
    """The ticks as JSON messages, some spoilt: errors without a number, large views unnamed."""
    return encode(
        ticks.select(
            F.when(~((F.col("symbol") == "view") & (F.col("price") > 50)), F.col("symbol")).alias(
                "symbol"
            ),
            F.when(F.col("symbol") == "error", F.lit("n/a"))
            .otherwise(F.col("price").cast("string"))
            .alias("price"),
            "timestamp",
        )
    )


# -- queries ---------------------------------------------------------------------------


def ticks_decoded(spark, sf_dir):
    return _plain(tl.decode(encode(_ticks(spark, sf_dir), "symbol"), schemas.TICK))


def ticks_valid(spark, sf_dir):
    good, _ = tl.validate_ticks(_messages(_ticks(spark, sf_dir)))
    return _plain(good)


def ticks_rejected(spark, sf_dir):
    _, rejected = tl.validate_ticks(_messages(_ticks(spark, sf_dir)))
    return rejected.groupBy("reason").agg(F.count("value").alias("messages"))


def window_stats(spark, sf_dir):
    return _plain(tl.window_stats(_ticks(spark, sf_dir)))


def window_stats_rollup(spark, sf_dir):
    return _plain(tl.window_stats(_ticks(spark, sf_dir), rollup=True))


def stats_array(spark, sf_dir):
    return _plain(_positions(tl.stats_array(_ticks(spark, sf_dir)), "windows"))


def zscore_rows(spark, sf_dir):
    return _plain(tl.explode_zscores(tl.tick_zscores(_ticks(spark, sf_dir))))


def zscore_join(spark, sf_dir):
    ticks = _ticks(spark, sf_dir)
    moving = tl.stats_array(ticks)
    return _plain(tl.zscore_rows(ticks, tl.explode_stats(moving)))


def zscore_array(spark, sf_dir):
    return _plain(_positions(tl.zscores(_ticks(spark, sf_dir)), "zscores"))


def zscore_array_of_rows(spark, sf_dir):
    ticks = _ticks(spark, sf_dir)
    rows = tl.zscore_rows(ticks, tl.window_stats(ticks))
    return _plain(_positions(tl.zscore_array(rows), "zscores"))


def _zscore_of(label: str):
    def query(spark, sf_dir):
        scores = tl.tick_zscores(_ticks(spark, sf_dir), tl.pick(label))
        return _plain(tl.explode_zscores(scores))

    return query


def first_move(spark, sf_dir):
    return _plain(tl.first_move(_ticks(spark, sf_dir)))


def first_move_filled(spark, sf_dir):
    return _plain(tl.first_move(_ticks(spark, sf_dir), fill=20.0))


def first_move_by_symbol(spark, sf_dir):
    return _plain(tl.first_move(_ticks(spark, sf_dir), partition_cols=("symbol",)))


def first_move_exact(spark, sf_dir):
    """Gaps to the tick itself, in fractions of seconds."""
    return _plain(tl.first_move(_ticks(spark, sf_dir), exact=True))


def first_move_600s(spark, sf_dir):
    """The first move within ten minutes, symbol by symbol."""
    return _plain(tl.first_move(_ticks(spark, sf_dir), 600, partition_cols=("symbol",)))


def first_higher(spark, sf_dir):
    return _plain(tl.first_higher(tl.first_move(_ticks(spark, sf_dir))))


def first_lower(spark, sf_dir):
    return _plain(tl.first_lower(tl.first_move(_ticks(spark, sf_dir))))


def window_stats_stream(spark, sf_dir):
    return _plain(_work_off(spark, sf_dir, lambda ticks, _: tl.window_stats(ticks)))


def late_ticks_stream(spark, sf_dir):
    """Ticks that come after their window was closed are dropped, others are not; the query is restarted."""
    return _plain(_work_off(spark, sf_dir, lambda ticks, _: tl.window_stats(ticks), late=True, restart=True))


def stats_array_stream(spark, sf_dir):
    return _plain(_positions(_work_off(spark, sf_dir, lambda ticks, _: tl.stats_array(ticks)), "windows"))


def stats_regrouped_stream(spark, sf_dir):
    """Statistics published as messages, with some that cannot be read, and regrouped from there."""

    def published(ticks, _):
        messages = encode(tl.window_stats(ticks))
        spoilt = F.array(F.col("value"), F.when(F.crc32("value") % 50 == 0, F.lit("not JSON")))
        return messages.select(F.explode(F.array_compact(spoilt)).alias("value"))

    def regrouped(_, folder):
        messages = tl.read_messages(spark, "text", path=folder)
        return tl.regroup_stats(tl.decode(messages, schemas.WINDOW_STAT, LATENESS))

    return _plain(_positions(_work_off(spark, sf_dir, published, regrouped), "windows"))


def _scores(ticks, folder):
    """Ticks joined to the window arrays another query has published as messages."""
    messages = tl.read_messages(ticks.sparkSession, "text", path=folder)
    moving = tl.decode(messages, schemas.MOVING, LATENESS)
    return tl.zscore_rows(ticks, tl.explode_stats(moving))


def _arrays_published(ticks, _):
    return encode(tl.stats_array(ticks))


def zscore_stream(spark, sf_dir):
    return _plain(_work_off(spark, sf_dir, _arrays_published, _scores))


def zscore_array_stream(spark, sf_dir):
    def arrays(ticks, folder):
        return tl.zscore_array(_scores(ticks, folder))

    return _plain(_positions(_work_off(spark, sf_dir, _arrays_published, arrays), "zscores"))


def first_move_stream(spark, sf_dir):
    return _plain(_work_off(spark, sf_dir, lambda ticks, _: tl.first_move(ticks)))


def _direction(pick, schema):
    """First moves of one direction, sent as messages without key, as their readers decode them."""

    def query(spark, sf_dir):
        def sent(ticks, _):
            return encode(pick(tl.first_move(ticks)))

        def received(_, folder):
            return tl.decode(tl.read_messages(spark, "text", path=folder), schema)

        return _plain(_work_off(spark, sf_dir, sent, received))

    return query


def window_stats_keyed_stream(spark, sf_dir):
    """Ticks read as messages, statistics sent with the symbol as key, as a topic has them."""

    def sent(ticks, _):
        return encode(ticks)

    def keyed(_, folder):
        messages = tl.read_messages(spark, "text", path=folder)
        return encode(tl.window_stats(tl.decode(messages, schemas.TICK, LATENESS)), "symbol")

    messages = _work_off(spark, sf_dir, sent, keyed)
    decoded = messages.select("key", F.from_json("value", schemas.WINDOW_STAT).alias("data")).select("key", "data.*")
    decoded = decoded.withColumn("timestamp", F.try_to_timestamp("timestamp"))
    return _plain(decoded)


def ticks_checked_stream(spark, sf_dir):
    """Messages, some spoilt, checked by one query: how many are good ticks, and how many rejected for what."""
    tl.configure(spark)
    folder = _folder(spark)
    _messages(_ticks(spark, sf_dir)).write.text(f"{folder}/messages")
    source, good, rejected = (Endpoint("text", path=f"{folder}/{x}", keyed=False) for x in ("messages", "good", "rejected"))
    for query in validation_job(spark, source, good, rejected, f"{folder}/state", available_now=True):
        query.awaitTermination()
    ticks = tl.decode(spark.read.schema("value string").text(f"{folder}/good"), schemas.TICK)
    reasons = spark.read.schema("value string").text(f"{folder}/rejected")
    reasons = reasons.select(F.get_json_object("value", "$.reason").alias("reason"))
    counted = ticks.filter("price IS NOT NULL AND timestamp IS NOT NULL").select(F.lit("good").alias("reason"))
    return counted.unionByName(reasons).groupBy("reason").agg(F.count("reason").alias("messages"))


def late_ticks_aside(spark, sf_dir):
    """Every tick, and the windows that were closed before it came, from the outputs for ticks in time and late ones."""
    tl.configure(spark)
    folder = _folder(spark)
    closing = _closing_symbol(_ticks(spark, sf_dir))
    arrivals = _arrivals(spark, sf_dir, closing, late=True, days=1)
    schema = "symbol string, price double, timestamp timestamp"
    for arrived in arrivals:
        arrived.repartition(1).write.mode("append").parquet(f"{folder}/ticks")

    def to(name):
        return lambda rows, batch_id: rows.write.mode("append").parquet(f"{folder}/{name}")

    if arrivals:
        stream = _arriving(spark, arrivals[0], folder)
        for query in late_job(stream, to("kept"), to("late"), f"{folder}/state", available_now=True):
            query.awaitTermination()
        kept = spark.read.schema(schema).parquet(f"{folder}/kept")
        late = spark.read.schema(f"{schema}, late_for array<string>").parquet(f"{folder}/late")
    else:
        kept = spark.createDataFrame([], schema)
        late = spark.createDataFrame([], f"{schema}, late_for array<string>")
    rows = late.withColumn("late_for", F.array_join("late_for", ",")).unionByName(kept.withColumn("late_for", F.lit("")))
    return _plain(rows.filter(~F.col("symbol").eqNullSafe(closing)))


def zscore_routed_stream(spark, sf_dir):
    """Published score arrays, exploded and routed into one folder per window label."""
    folder = _folder(spark)
    encode(tl.zscores(_ticks(spark, sf_dir)), "symbol").select("value").write.text(
        f"{folder}/zscores"
    )
    messages = tl.read_messages(spark, "text", path=f"{folder}/zscores")
    rows = tl.explode_zscores(tl.decode(messages, schemas.ZSCORES))
    route_by_window(
        rows, to_folders(f"{folder}/routed"), f"{folder}/state", available_now=True
    ).awaitTermination()
    routed = spark.read.schema(
        "timestamp timestamp, symbol string, zscore_price double, batch_id long, window string"
    ).parquet(f"{folder}/routed")
    return _plain(routed.select("timestamp", "symbol", "window", "zscore_price"))


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the subpackage `llm` and its pipeline; none where they are not there."""
    try:
        import corpus_pipeline
        from tickloom.llm.queries import QUERIES, SQL
    except ModuleNotFoundError as missing:
        if missing.name != "corpus_pipeline" and not missing.name.startswith("tickloom.llm"):
            raise
        return {}, {}
    sql = dict(SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator."""
    return {**tick_queries(), **_llm()[0]}


def tick_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The operators over ticks; each reads the whole events table."""
    named = [
        ticks_decoded,
        ticks_valid,
        ticks_rejected,
        window_stats,
        window_stats_rollup,
        stats_array,
        zscore_rows,
        zscore_join,
        zscore_array,
        zscore_array_of_rows,
        first_move,
        first_move_filled,
        first_move_by_symbol,
        first_move_exact,
        first_move_600s,
        first_higher,
        first_lower,
        window_stats_stream,
        stats_array_stream,
        zscore_stream,
        zscore_array_stream,
        zscore_routed_stream,
        first_move_stream,
        late_ticks_stream,
        late_ticks_aside,
        stats_regrouped_stream,
        window_stats_keyed_stream,
        ticks_checked_stream,
    ]
    found = {q.__name__: q for q in named}
    found["first_higher_stream"] = _direction(tl.first_higher, schemas.HIGHER)
    found["first_lower_stream"] = _direction(tl.first_lower, schemas.LOWER)
    found.update({f"zscore_{label}": _zscore_of(label) for label in tl.LABELS})
    return found


# -- the same in SQL -------------------------------------------------------------------

_WIDTHS = "(VALUES " + ", ".join(f"('{w.label}', {w.seconds}::BIGINT)" for w in tl.SIX) + ") w(label, sec)"

_BASE = f"""
WITH ticks AS (
  SELECT event_type AS symbol, value AS price, ts, epoch_us(ts) AS us FROM events
), stats AS (
  SELECT make_timestamp((us // (sec * 1000000) + 1) * sec * 1000000) AS ended,
         symbol, label, sec, avg(price) AS mean, stddev_samp(price) AS dev
  FROM ticks CROSS JOIN {_WIDTHS}
  GROUP BY 1, 2, 3, 4
), scores AS (
  SELECT t.ts, t.symbol, s.label, s.sec, s.ended,
         CASE WHEN s.dev > 0 THEN (t.price - s.mean) / s.dev END AS z
  FROM ticks t JOIN stats s
    ON t.symbol = s.symbol AND t.ts < s.ended AND t.ts >= s.ended - s.sec * INTERVAL 1 SECOND
)"""


def _round_sql(value: str) -> str:
    return f"CASE WHEN round({value}, 8) = 0 THEN 0.0::DOUBLE ELSE round({value}, 8) END"


_STATS = f"""
SELECT ended AS "timestamp", symbol, label AS "window",
       {_round_sql('mean')} AS avg_price, {_round_sql('dev')} AS std_price
FROM stats"""

_STATS_ARRAY = f"""
SELECT ended AS "timestamp", symbol,
       row_number() OVER (PARTITION BY ended, symbol ORDER BY sec) - 1 AS position,
       label AS "window", {_round_sql('mean')} AS avg_price, {_round_sql('dev')} AS std_price
FROM stats"""

_SCORES = f"""
SELECT ts AS "timestamp", symbol, label AS "window", {_round_sql('z')} AS zscore_price
FROM scores"""

_SCORE_ARRAY = f"""
SELECT ts AS "timestamp", symbol,
       row_number() OVER (PARTITION BY ts, symbol ORDER BY sec, z NULLS LAST) - 1 AS position,
       label AS "window", {_round_sql('z')} AS zscore_price
FROM scores"""

_MESSAGES = """
WITH sent AS (
  SELECT CASE WHEN NOT (event_type = 'view' AND value > 50) THEN event_type END AS symbol,
         CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS price,
         ts
  FROM events
)"""


# Late ticks are dropped from the windows that the first half's watermark has closed.
_ARRIVED = f"""
WITH ticks AS (
  SELECT event_type AS symbol, value AS price, event_id, ts, epoch_us(ts) AS us FROM events
), bounds AS (
  SELECT (min(us) + max(us)) // 2 // 1000000 * 1000000 AS middle FROM ticks
), arrived AS (
  SELECT ticks.*, us >= middle OR (event_id % 10 = 0 AND us >= middle - 7200000000) AS second_half
  FROM ticks, bounds
), mark AS (
  SELECT max(us) // 1000 * 1000 - 10000000 AS closed FROM arrived WHERE NOT second_half
), kept AS (
  SELECT *, (us // (sec * 1000000) + 1) * sec * 1000000 AS end_us
  FROM arrived CROSS JOIN {_WIDTHS}
)"""

_LATE = f"""{_ARRIVED}
SELECT make_timestamp(end_us) AS "timestamp", symbol, label AS "window",
       {_round_sql('avg(price)')} AS avg_price, {_round_sql('stddev_samp(price)')} AS std_price
FROM kept, mark WHERE NOT (second_half AND end_us <= closed)
GROUP BY end_us, symbol, label"""

_ASIDE = f"""{_ARRIVED}
SELECT symbol, {_round_sql('price')} AS price, ts AS "timestamp",
       coalesce(string_agg(label, ',' ORDER BY sec) FILTER (second_half AND end_us <= closed), '') AS late_for
FROM kept, mark GROUP BY symbol, price, ts, event_id"""


def _moves(fill: str = "NULL", by_symbol: bool = False, horizon: int = 20, exact: bool = False) -> str:
    symbol = "a.symbol, " if by_symbol else ""
    same = "AND a.symbol = b.symbol" if by_symbol else ""
    gap = "(epoch_us(b.ts) // 1000000 - epoch_us(a.ts) // 1000000)::DOUBLE"
    if exact:
        gap = "(epoch_us(b.ts) - epoch_us(a.ts)) / 1e6"
    return f"""{_BASE}, moves AS (
  SELECT {symbol}a.ts AS "timestamp",
         min({gap}) FILTER (b.price > a.price) AS higher,
         min({gap}) FILTER (b.price < a.price) AS lower
  FROM ticks a LEFT JOIN ticks b
    ON b.ts > a.ts AND b.ts <= a.ts + INTERVAL {horizon} SECOND {same}
  GROUP BY ALL
)
SELECT {symbol.replace('a.', '')}"timestamp", coalesce(higher, {fill})::DOUBLE AS higher_window,
       coalesce(lower, {fill})::DOUBLE AS lower_window
FROM moves"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query, where SQL can say the same."""
    return {**tick_sql(), **_llm()[1]}


def tick_sql() -> dict[str, str]:
    """DuckDB SQL per query over ticks. Streams give what their last watermark has closed."""
    found = {
        "ticks_decoded": """
            SELECT event_type AS symbol, round(value, 8) AS price, ts AS "timestamp" FROM events""",
        "ticks_valid": f"""{_MESSAGES}
            SELECT symbol, round(CAST(price AS DOUBLE), 8) AS price, ts AS "timestamp"
            FROM sent WHERE symbol IS NOT NULL AND price <> 'n/a'""",
        "ticks_rejected": f"""{_MESSAGES}
            SELECT CASE WHEN symbol IS NULL THEN 'no symbol' ELSE 'price is not a number' END
                   AS reason, count(*) AS messages
            FROM sent WHERE symbol IS NULL OR price = 'n/a' GROUP BY 1""",
        "window_stats": _BASE + _STATS,
        "window_stats_rollup": _BASE + _STATS,
        "stats_array": _BASE + _STATS_ARRAY,
        "zscore_rows": _BASE + _SCORES,
        "zscore_join": _BASE + _SCORES,
        "zscore_array": _BASE + _SCORE_ARRAY,
        "zscore_array_of_rows": _BASE + _SCORE_ARRAY,
        "first_move": _moves(),
        "first_move_filled": _moves("20.0"),
        "first_move_by_symbol": _moves(by_symbol=True),
        "first_move_exact": _moves(exact=True),
        "first_move_600s": _moves(by_symbol=True, horizon=600),
        "first_higher": f"""SELECT "timestamp", higher_window
            FROM ({_moves()}) WHERE higher_window IS NOT NULL""",
        "first_lower": f"""SELECT "timestamp", lower_window
            FROM ({_moves()}) WHERE lower_window IS NOT NULL""",
        "window_stats_stream": _BASE + _STATS,
        "stats_array_stream": _BASE + _STATS_ARRAY,
        "stats_regrouped_stream": _BASE + _STATS_ARRAY,
        "zscore_stream": _BASE + _SCORES,
        "zscore_array_stream": _BASE + _SCORE_ARRAY,
        "zscore_routed_stream": _BASE + _SCORES,
        "first_move_stream": _moves(),
        "late_ticks_stream": _LATE,
        "late_ticks_aside": _ASIDE,
        "window_stats_keyed_stream": _BASE + _STATS.replace("SELECT ended", "SELECT symbol AS key, ended"),
        "ticks_checked_stream": f"""{_MESSAGES}
            SELECT CASE WHEN symbol IS NULL THEN 'no symbol' WHEN price = 'n/a' THEN 'price is not a number'
                   ELSE 'good' END AS reason, count(*) AS messages
            FROM sent GROUP BY 1""",
    }
    for way in ("higher", "lower"):
        found[f"first_{way}_stream"] = found[f"first_{way}"]
    found.update(
        {f"zscore_{w}": f"{_BASE} {_SCORES} WHERE label = '{w}'" for w in tl.LABELS}
    )
    return found
