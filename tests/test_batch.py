import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import tickloom as tl
from data import DAY, SIX_MOVES, SIX_SCORES, SIX_STATS, at, near, ticks, utc


@pytest.mark.parametrize("rollup", [False, True])
def test_window_stats_of_six_ticks(spark, rollup):
    rows = tl.window_stats(ticks(spark), rollup=rollup).collect()
    found = {(r.window, utc(r.timestamp)): (r.avg_price, r.std_price) for r in rows}
    assert len(rows) == len(found) == len(SIX_STATS)
    for key, (avg, std) in SIX_STATS.items():
        assert near(found[key][0], avg) and near(found[key][1], std), key


@pytest.mark.parametrize("rollup", [False, True])
def test_still_price_has_no_deviation(spark, rollup):
    rows = [("A", 0.1, at(s)) for s in (1, 2, 3, 31, 32, 65, 700, 701, 702, 703)]
    stats = tl.window_stats(ticks(spark, rows), rollup=rollup)
    stds = {r.std_price for r in stats.filter(F.col("window") == "1h").collect()}
    assert stds == {0.0}
    assert tl.zscores(ticks(spark, rows), rollup=rollup).filter(
        F.exists("zscores", lambda z: z["zscore_price"].isNotNull())
    ).isEmpty()


def random_ticks(n=3000, seconds=7200, symbols="ABC", seed=3, step=1):
    r = random.Random(seed)
    return [
        (
            r.choice(symbols),
            r.choice([None, float(r.randint(1, 40))]) if r.random() < 0.05 else float(r.randint(1, 40)),
            at(r.randint(-seconds * 1_000_000 // step, seconds * 1_000_000 // step) * step / 1e6),
        )
        for _ in range(n)
    ]


def test_rollup_equals_counting_per_width(spark):
    t = ticks(spark, random_ticks()).cache()
    def rounded(df):
        return df.select("timestamp", "symbol", "window",
                         F.round("avg_price", 8).alias("a"), F.round("std_price", 8).alias("s"))
    plain, rolled = rounded(tl.window_stats(t)), rounded(tl.window_stats(t, rollup=True))
    assert plain.count() == rolled.count() > 500
    assert plain.exceptAll(rolled).isEmpty() and rolled.exceptAll(plain).isEmpty()


def test_window_bounds_equal_sparks_window_function(spark):
    t = ticks(spark, random_ticks(500)).cache()
    for w in tl.SIX:
        spark_ends = t.groupBy(F.window("timestamp", f"{w.seconds} seconds"), "symbol").count()
        spark_ends = spark_ends.select(F.col("window.end").alias("timestamp"), "symbol")
        ours = tl.window_stats(t, [w]).select("timestamp", "symbol")
        assert ours.exceptAll(spark_ends).isEmpty() and spark_ends.exceptAll(ours).isEmpty()


def test_stats_array_of_six_ticks(spark):
    rows = tl.stats_array(ticks(spark)).collect()
    found = {utc(r.timestamp): [w.window for w in r.windows] for r in rows}
    assert found == {
        at(30): ["30s"], at(60): ["30s", "1m"], at(90): ["30s"], at(120): ["1m"],
        at(300): ["5m"], at(900): ["15m"], at(1800): ["30m"], at(3600): ["1h"],
    }


def test_all_six_windows_meet_on_the_hour(spark):
    (row,) = tl.stats_array(ticks(spark, [("A", 1.0, at(3599))])).collect()
    assert utc(row.timestamp) == at(3600)
    assert [w.window for w in row.windows] == list(tl.LABELS)


def expected_scores():
    for time, (z30, z60, longer) in SIX_SCORES.items():
        yield from [(time, "30s", z30), (time, "1m", z60)]
        yield from [(time, label, longer) for label in ("5m", "15m", "30m", "1h")]


def test_zscore_rows_of_six_ticks(spark):
    t = ticks(spark)
    for rows in (
        tl.zscore_rows(t, tl.window_stats(t)),
        tl.zscore_rows(t, tl.explode_stats(tl.stats_array(t))),
        tl.explode_zscores(tl.tick_zscores(t)),
        tl.explode_zscores(tl.zscores(t)),
        tl.explode_zscores(tl.zscores(t, rollup=True)),
    ):
        found = {(utc(r.timestamp), r.window): r.zscore_price for r in rows.collect()}
        expected = list(expected_scores())
        assert len(found) == len(expected) == 36
        for time, label, z in expected:
            assert near(found[time, label], z), (time, label)


def test_score_paths_agree_with_the_range_join(spark):
    t = ticks(spark, random_ticks(2000, step=500_000)).cache()
    stats = tl.window_stats(t).cache()
    seconds = {w.label: w.seconds for w in tl.SIX}
    by_symbol = {}
    for r in stats.collect():
        by_symbol.setdefault(r.symbol, []).append(r)
    expected = []
    for r in t.filter("price is not null").collect():
        for m in by_symbol[r.symbol]:
            if m.timestamp - dt.timedelta(seconds=seconds[m.window]) <= r.timestamp < m.timestamp:
                z = (r.price - m.avg_price) / m.std_price if m.std_price else None
                expected.append((r.timestamp, r.symbol, m.window, z and round(z, 6)))

    def key(row):
        return tuple((x is None, x) for x in row)

    for rows in (
        tl.zscore_rows(t, stats),
        tl.explode_zscores(tl.tick_zscores(t)),
        tl.explode_zscores(tl.zscores(t)),
    ):
        found = [
            (r.timestamp, r.symbol, r.window, r.zscore_price and round(r.zscore_price, 6))
            for r in rows.collect()
        ]
        assert sorted(found, key=key) == sorted(expected, key=key)

    a = tl.zscore_array(tl.zscore_rows(t, stats))
    b = tl.zscores(t)
    rounded = lambda df: df.select(
        "timestamp", "symbol",
        F.transform("zscores", lambda z: F.struct(
            z["window"], F.round(z["zscore_price"], 8) + F.lit(0.0))).alias("z"))
    assert rounded(a).exceptAll(rounded(b)).isEmpty()
    assert rounded(b).exceptAll(rounded(a)).isEmpty()


def test_ticks_of_one_time_share_an_array(spark):
    rows = [("A", 10.0, at(1)), ("A", 12.0, at(1)), ("B", 5.0, at(1))]
    found = {r.symbol: r.zscores for r in tl.zscores(ticks(spark, rows)).collect()}
    assert [z.window for z in found["A"]] == [l for l in tl.LABELS for _ in range(2)]
    assert near(found["A"][0].zscore_price, -0.707107)
    assert [z.zscore_price for z in found["B"]] == [None] * 6


def test_first_move_of_six_ticks(spark):
    rows = tl.first_move(ticks(spark)).collect()
    assert {utc(r.timestamp): (r.higher_window, r.lower_window) for r in rows} == SIX_MOVES
    filled = tl.first_move(ticks(spark), fill=20.0).collect()
    assert {utc(r.timestamp): (r.higher_window, r.lower_window) for r in filled} == {
        t: tuple(20.0 if g is None else g for g in gaps) for t, gaps in SIX_MOVES.items()
    }
    moves = tl.first_move(ticks(spark))
    assert tl.first_higher(moves).count() == 3 and tl.first_lower(moves).count() == 2
    assert tl.first_higher(moves).columns == ["timestamp", "higher_window"]


def brute_moves(rows, horizon, by_symbol, exact=False):
    """Every pair compared, as the definition reads."""
    out = {}
    second = lambda t: (t - DAY) // dt.timedelta(seconds=1)
    for s1, p1, t1 in rows:
        key = (s1, t1) if by_symbol else t1
        best = out.setdefault(key, [None, None])
        for s2, p2, t2 in rows:
            if by_symbol and s1 != s2 or p1 is None or p2 is None:
                continue
            if t1 < t2 <= t1 + dt.timedelta(seconds=horizon):
                gap = (t2 - t1) / dt.timedelta(seconds=1) if exact else float(second(t2) - second(t1))
                for i, hit in enumerate((p2 > p1, p2 < p1)):
                    if hit and (best[i] is None or gap < best[i]):
                        best[i] = gap
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize(
    "seed,step,spread,horizon",
    [(1, 1, 120, 20), (2, 250_000, 90, 20), (3, 1_000_000, 200, 20), (4, 100_000, 15, 3), (5, 500_000, 60, 1),
     (6, 1, 900, 600), (7, 500_000, 60, 33)],
)
def test_first_move_equals_comparing_every_pair(spark, seed, step, spread, horizon):
    rows = random_ticks(700, spread, "AB", seed, step)
    found = {
        utc(r.timestamp): (r.higher_window, r.lower_window)
        for r in tl.first_move(ticks(spark, rows), horizon).collect()
    }
    assert found == brute_moves(rows, horizon, False)
    found = {
        (r.symbol, utc(r.timestamp)): (r.higher_window, r.lower_window)
        for r in tl.first_move(ticks(spark, rows), horizon, partition_cols=("symbol",)).collect()
    }
    assert found == brute_moves(rows, horizon, True)


@pytest.mark.parametrize("seed,step,spread,horizon", [(1, 1, 60, 20), (2, 250_000, 30, 7), (3, 1, 900, 600), (4, 1, 3, 1)])
def test_exact_gaps_equal_comparing_every_pair(spark, seed, step, spread, horizon):
    """Fractions of seconds, symbols that may be NULL, and prices that may be."""
    rows = [
        (None if i % 5 == 0 else s, None if i % 37 == 0 else p, t)
        for i, (s, p, t) in enumerate(random_ticks(500, spread, "AB", seed, step))
    ]
    for by_symbol in (False, True):
        keys = ("symbol",) if by_symbol else ()
        moves = tl.first_move(ticks(spark, rows), horizon, partition_cols=keys, exact=True).collect()
        found = {((r.symbol, utc(r.timestamp)) if by_symbol else utc(r.timestamp)): (r.higher_window, r.lower_window) for r in moves}
        assert found == brute_moves(rows, horizon, by_symbol, exact=True) and len(moves) == len(found)


def test_exact_gaps_of_six_ticks(spark):
    rows = tl.first_move(ticks(spark), exact=True).collect()
    found = {utc(r.timestamp): (r.higher_window, r.lower_window) for r in rows}
    assert found[at(29.9)] == (0.1, None) and found[at(10)] == (20.0, 19.9)
    assert {t for t, gaps in found.items() if gaps == (None, None)} == {t for t, g in SIX_MOVES.items() if g == (None, None)}
    assert tl.first_move(ticks(spark, []), exact=True).collect() == []


def test_slow_trends_need_far_lookahead(spark):
    rows = [("A", float(100 - i if i < 60 else i), at(i * 0.7)) for i in range(120)]
    found = {
        utc(r.timestamp): (r.higher_window, r.lower_window)
        for r in tl.first_move(ticks(spark, rows)).collect()
    }
    assert found == brute_moves(rows, 20, False)


def test_widths_must_nest(spark):
    with pytest.raises(ValueError):
        tl.window_stats(ticks(spark), [("a", 30), ("b", 45)])
    with pytest.raises(ValueError):
        tl.pick("2h")
    assert {r.window for r in tl.window_stats(ticks(spark), tl.pick("1m", "1h")).collect()} == {"1m", "1h"}
