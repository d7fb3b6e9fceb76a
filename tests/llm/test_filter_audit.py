"""The audit against a plain simulation of every order, and odd rows."""

import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tickloom.llm import filter_audit

COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def plain(docs, labels):
    """Every document through every order, one by one."""
    first, good, toxic = {}, Counter(), Counter()
    for r in docs:
        t = r.text or ""
        if r.doc_id is not None:
            first[t] = min(first.get(t, r.doc_id), r.doc_id)
    for r in labels:
        good[r.doc_id] |= int(r.quality == 1)
        toxic[r.doc_id] |= int(r.toxic == 1)
    fails = []
    for r in docs:
        t = r.text or ""
        w = re.findall("[^ \t-\r]+", t)
        own = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": r.doc_id is not None and first[t] < r.doc_id,
        }
        named = r.doc_id is not None
        fails.append((r.lang or "", own, good[r.doc_id] if named else 0, toxic[r.doc_id] if named else 0))
    found, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for step, f in enumerate(order):
            for part in {x[0] for x in fails}:
                c = found[part, order, step + 1] = Counter()
                for p, own, g, x in fails:
                    if p != part:
                        continue
                    gone = any(own[e] for e in order[:step])
                    c["kept"] += not gone and not own[f]
                    c["removed"] += not gone and own[f]
                    c["redundant"] += gone and own[f]
                    c["unique_fails"] += own[f] and sum(own.values()) == 1
                    c["good_lost"] += g * (not gone and own[f])
                    c["toxic_lost"] += x * (not gone and own[f])
                shapley[part, f] += c["removed"]
    return sorted(
        (*key, *[int(c[k]) for k in COLUMNS[3:9]], shapley[key[0], key[1][key[2] - 1]]) for key, c in found.items()
    )


def rows(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def test_equals_a_simulation(documents, labels):
    assert rows(filter_audit.filter_audit(documents, labels)) == plain(documents.collect(), labels.collect())


def test_odd_rows(spark, odd, clashing):
    labels = spark.createDataFrame(
        [(5, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (4, 0, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    expected = plain(odd.collect(), labels.collect())
    assert rows(filter_audit.filter_audit(odd, labels)) == expected
    extra = labels.withColumns({c: F.lit(7) for c in ("part", "mask", "n", "good")})
    docs = clashing.withColumns({c: F.lit("own") for c in ("part", "mask", "steps", "good", "digest")})
    assert rows(filter_audit.filter_audit(docs, extra)) == expected
    assert rows(filter_audit.filter_audit(odd, labels.filter("false"))) == plain(odd.collect(), [])


def test_nothing(nothing, labels):
    assert rows(filter_audit.filter_audit(nothing, labels)) == []


def test_a_third_are_copies(spark, documents, labels):
    """One text of many documents, and one row repeated, are a few rows where copies are told."""
    hot = spark.range(3_000).select(F.col("id").alias("doc_id"), F.lit("copy #1").alias("text"), F.lit("en").alias("lang"))
    same = spark.range(500).select(F.lit(7).cast("long").alias("doc_id"), F.lit("copy #1").alias("text"), F.lit("en").alias("lang"))
    docs = hot.unionByName(same)
    cells = {(r.part, r.mask): r.n for r in filter_audit.cells(docs, labels).collect()}
    assert cells == {("en", 0b01001): 1, ("en", 0b11001): 3_499}


@pytest.mark.parametrize("text, mask", [("", 1), (None, 1), ("a " * 300, 2), ("A b c d", 5), ("x|y" + " a" * 300, 10)])
def test_failures(spark, text, mask):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(filter_audit.failures(F.coalesce("text", F.lit("")))).first()[0] == mask
