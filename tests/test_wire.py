import datetime as dt

import pytest
from pyspark.sql import functions as F

import tickloom as tl
from data import DAY, at, ticks, utc
from tickloom import schemas
from tickloom.streaming import encode


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def tick(time, price="1.5", symbol='"A"'):
    return f'{{"symbol":{symbol},"price":{price},"timestamp":"{time}"}}'


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "text,expected",
    [
        ("2025-01-01T00:00:00+00:00", DAY),
        ("2025-01-01T00:00:00.123Z", at(0.123)),
        ("2025-01-01T00:00:00.123456+00:00", at(0.123456)),
        ("2025-01-01T00:00:00.1+07:00", at(0.1) - dt.timedelta(hours=7)),
        ("2025-01-01 00:00:05.5", at(5.5)),
        ("junk", None),
    ],
)
def test_times_on_the_wire(spark, ansi, text, expected):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        (row,) = tl.decode(messages(spark, tick(text)), schemas.TICK).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert (utc(row.timestamp) if row.timestamp else None) == expected


def test_undecodable_messages_are_rows_of_nulls(spark):
    bad = tl.decode(messages(spark, "not json", "{}", tick("2025-01-01T00:00:00Z", '"1.5"')), schemas.TICK)
    assert [(r.symbol, r.price) for r in bad.collect()] == [(None, None), (None, None), ("A", None)]


def test_validation_splits_and_gives_reasons(spark):
    good_time = "2025-01-01T00:00:00Z"
    cases = {
        tick(good_time): None,
        tick(good_time, '"2.5"'): None,
        "not json": "not JSON",
        '{"symbol":': "not JSON",
        f'{{"price":1,"timestamp":"{good_time}"}}': "no symbol",
        f'{{"symbol":"A","timestamp":"{good_time}"}}': "no price",
        tick(good_time, '"abc"'): "price is not a number",
        tick(good_time, "NaN"): "price is NaN",
        tick("junk"): "no valid time",
        '{"symbol":"A","price":1}': "no valid time",
    }
    good, rejected = tl.validate_ticks(messages(spark, *cases))
    assert {r.value: r.reason for r in rejected.collect()} == {k: v for k, v in cases.items() if v}
    assert sorted(r.price for r in good.collect()) == [1.5, 2.5]
    assert good.schema.simpleString() == "struct<symbol:string,price:double,timestamp:timestamp>"


def test_null_message_is_rejected(spark):
    good, rejected = tl.validate_ticks(messages(spark, None, tick("2025-01-01T00:00:00Z")))
    assert good.count() == 1 and [r.reason for r in rejected.collect()] == ["not JSON"]


def test_scores_survive_a_round_trip(spark):
    rows = [("A", 10.0, at(1.000001)), ("A", 12.0, at(1.000002)), ("B", 3.0, at(1.000001))]
    arrays = tl.zscores(ticks(spark, rows))
    sent = encode(arrays, "symbol")
    assert sent.columns == ["key", "value"] and {r.key for r in sent.collect()} == {"A", "B"}
    back = tl.decode(sent, schemas.ZSCORES)
    assert back.exceptAll(arrays).isEmpty() and arrays.exceptAll(back).isEmpty()
    assert tl.explode_zscores(back).filter("zscore_price is null").count() == 6


def test_stats_survive_a_round_trip(spark):
    arrays = tl.stats_array(ticks(spark))
    back = tl.decode(encode(arrays, "symbol"), schemas.MOVING)
    assert back.exceptAll(arrays).isEmpty() and arrays.exceptAll(back).isEmpty()


def test_moves_are_sent_without_key(spark):
    sent = encode(tl.first_higher(tl.first_move(ticks(spark))))
    assert sent.columns == ["value"]
    back = tl.decode(sent, schemas.HIGHER)
    assert {(utc(r.timestamp), r.higher_window) for r in back.collect()} == {
        (at(5), 5.0), (at(10), 20.0), (at(29.9), 1.0)}


def test_nan_price_makes_nan_scores(spark):
    rows = [("A", float("nan"), at(1)), ("A", 1.0, at(2))]
    found = tl.explode_zscores(tl.zscores(ticks(spark, rows)))
    assert found.filter(F.isnan("zscore_price")).count() == 12
