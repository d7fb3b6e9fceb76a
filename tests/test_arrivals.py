"""Streams keep ticks without symbol, of the symbol `~` and without event_id, as the SQL does; large arrivals come in stretches."""

import random
from datetime import datetime, timedelta

import duckdb
import pytest

import __spark_entry__ as queries


@pytest.mark.parametrize("name", ["window_stats_stream", "late_ticks_stream"])
def test_odd_symbols_and_ids(spark, tmp_path, name):
    chance = random.Random(4)
    rows = [
        (
            chance.choice([None, i]),
            datetime(2024, 1, 1) + timedelta(seconds=chance.randint(0, 8 * 3600)),
            chance.choice([None, "~", "a"]),
            float(chance.randint(1, 50)),
        )
        for i in range(400)
    ]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double")
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    found = queries.queries()[name](spark, str(tmp_path))
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    expected = sql.execute(queries.oracle_sql()[name]).fetchall()
    columns = [c[0] for c in sql.description]
    got = [tuple(r) for r in found.select(columns).collect()]
    key = [(str(r[:3]), r[3:]) for r in got], [(str(r[:3]), r[3:]) for r in expected]
    a, b = (dict(k) for k in key)
    assert len(got) == len(expected) and a.keys() == b.keys()
    for k, values in b.items():
        assert a[k] == pytest.approx(values, abs=1e-7)
    assert {r[1] for r in got} == {None, "~", "a"}


def test_large_arrivals_come_in_stretches_of_time(spark, tmp_path, monkeypatch):
    """A batch has few ticks, state partitions are for the cores, and the scores are all there."""
    chance = random.Random(9)
    seconds = [chance.randint(0, 8 * 3600) for _ in range(240)] + [4000] * 50 + [20000] * 3
    rows = [
        (i, datetime(2024, 1, 1) + timedelta(seconds=t, microseconds=i % 3), chance.choice("ab"), float(chance.randint(1, 50)))
        for i, t in enumerate(seconds)
    ]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double")
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    started, start = [], queries.start_sink

    def recorded(*args, **options):
        started.append(start(*args, **options))
        return started[-1]

    monkeypatch.setattr(queries, "start_sink", recorded)
    monkeypatch.setattr(queries, "_BATCH", 100, raising=False)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    found = queries.queries()["zscore_array_stream"](spark, str(tmp_path))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "9"
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    expected = sql.execute(queries.oracle_sql()["zscore_array_stream"]).fetchall()
    columns = [c[0] for c in sql.description]
    a, b = ({tuple(map(str, r[:4])): r[4] for r in rows} for rows in ([tuple(r) for r in found.select(columns).collect()], expected))
    assert len(a) == found.count() == len(expected) and a.keys() == b.keys()
    for k, value in b.items():
        assert a[k] == pytest.approx(value, abs=1e-7)
    batches = [p for query in started for p in query.recentProgress]
    assert max(s["numInputRows"] for p in batches for s in p["sources"] if "/ticks" in s["description"]) < 140
    assert {op["numShufflePartitions"] for p in batches for op in p["stateOperators"]} == {spark.sparkContext.defaultParallelism}
