"""Shards by sampled splitters: the law of near-equal bytes, whole groups, gapless slots."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickloom.llm import splitters


def check(docs, **settings):
    rows = splitters.shards(docs, **settings).collect()
    texts = Counter((r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter(
        {k: v for k, v in sized(texts).items()}
    )
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8 for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for shard in range(8):
        own = sum(r["size"] for r in rows if r.shard == shard)
        assert abs(own - total / 8) <= largest + 0.01 * total / 8
    return rows


def sized(texts):
    found = Counter()
    for (doc_id, raw), n in texts.items():
        found[doc_id, len(raw) + 1, zlib.crc32(raw)] += n
    return found


@pytest.mark.parametrize("settings", [{}, {"samples": 20, "range_rows": 10}, {"samples": 3}])
def test_law(documents, settings):
    check(documents, **settings)


def test_odd_rows(odd, clashing):
    rows = splitters.shards(odd).collect()
    assert len(rows) == odd.count() and sum(r.doc_id is None for r in rows) == 2
    assert splitters.shards(clashing).count() == odd.count()


def test_nothing(nothing):
    assert splitters.shards(nothing).count() == 0


def test_a_third_are_copies(spark, documents):
    """A hot group is divided by doc_id; small groups stay whole."""
    hot = spark.range(10_000, 10_200).select(F.col("id").alias("doc_id"), F.lit("copy " * 300).alias("text"))
    empty = spark.range(20_000, 21_000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    docs = documents.select("doc_id", "text").unionByName(hot).unionByName(empty)
    rows = check(docs, samples=200)
    shards = defaultdict(set)
    for r in rows:
        shards[r.text_crc32].add(r.shard)
    assert len(shards[zlib.crc32(b"copy " * 300)]) > 1
    divided = [k for k, v in shards.items() if len(v) > 1]
    assert len(divided) <= 8


def test_the_sample_does_not_decide(documents):
    by = [
        sorted(map(tuple, splitters.shards(documents, **s).collect()))
        for s in ({}, {"samples": 7, "rounds": 1})
    ]
    assert by[0] == by[1]


def test_one_row_repeated_is_divided(spark, documents, monkeypatch):
    """A third of all rows alike in doc_id and text: no range has more than four times the mean."""
    n = 2_000
    same = spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit("copy " * 30).alias("text"))
    docs = documents.select("doc_id", "text").unionByName(same)
    counted = []
    counts = splitters._counts
    monkeypatch.setattr(splitters, "_counts", lambda placed: counted.append(counts(placed)) or counted[-1])
    check(docs, samples=400, range_rows=50)
    last = counted[-1]
    mean = sum(r for r, _ in last.values()) / len(last)
    assert max(r for r, _ in last.values()) <= 4 * max(mean, 64)
