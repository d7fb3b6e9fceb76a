"""The index against plain search, and contamination against the definition."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import fm_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(lower(text or ""))


def brute(texts, items, width=13):
    """(n_words, hit word numbers, item ids) per text."""
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                of = windows.get(tuple(w[i : i + n]))
                if of:
                    hit.update(range(i, i + n))
                    found |= of
        yield len(w), hit, sorted(found)


def check(docs, bench, **settings):
    rows = fm_index.contamination(docs.select("doc_id", "text"), bench, **settings).collect()
    items = [(r.item_id, r.text) for r in bench.collect() if r.item_id is not None]
    for row, (n, hit, found) in zip(rows, brute([r.text for r in rows], items, settings.get("width", 13))):
        c = row.contamination
        assert (c.n_words, c.n_hit, c["items"]) == (n, len(hit), found)
        assert {i for s in c.spans for i in range(s.first, s.last)} == hit
        assert all(a.last < b.first for a, b in zip(c.spans, c.spans[1:]))
        assert c.contaminated == (bool(hit) and 20 * len(hit) >= n)
    return rows


@pytest.mark.parametrize(
    "settings", [{}, {"shard_words": 200}, {"block_phrases": 300}, {"width": 3, "shard_words": 50}]
)
def test_equals_definition(documents, benchmark, settings):
    rows = check(documents.limit(120), benchmark, **settings)
    assert any(r.contamination.contaminated for r in rows)


def test_short_items_and_odd_texts(spark, odd, clashing):
    bench = spark.createDataFrame(
        [(1, "a few words"), (2, None), (3, "..."), (None, "same text"), (10, "LONGER longer"),
         (10, "to be told apart from others to be told apart from others x"), (4, "ß")],
        "item_id long, text string",
    )
    check(odd, bench)
    check(odd, bench.limit(0))
    found = fm_index.contamination(clashing, bench)
    assert found.columns == [*clashing.columns, "_contamination"]
    assert found.filter(F.col("contamination") != "own").count() == 0


def test_nothing(nothing, benchmark):
    assert fm_index.contamination(nothing, benchmark).count() == 0


def test_index_counts_and_locates():
    chance = np.random.default_rng(1)
    for n, kinds in ((1, 2), (50, 2), (400, 3), (900, 30)):
        text = np.append(chance.integers(1, kinds + 1, n), 0).astype(np.int64)
        assert fm_index.suffix_order(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())
        index = fm_index.FMIndex(text, every=5)
        patterns = [text[i : i + k].tolist() for i in range(0, n, 7) for k in (1, 2, 4) if i + k <= n]
        patterns += [[kinds + 5], [1, kinds + 1, 1]]
        matrix = np.full((len(patterns), 4), -1, np.int64)
        for row, p in enumerate(patterns):
            matrix[row, 4 - len(p) :] = p
        found = {p: (a, b) for p, a, b in zip(*index.search(matrix))}
        for row, p in enumerate(patterns):
            places = [i for i in range(n) if text[i : i + len(p)].tolist() == p]
            low, high = found.get(row, (0, 0))
            assert sorted(index.locate(np.arange(low, high)).tolist()) == places


def test_query(spark):
    from tickloom.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op3_decontamination(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for row, (n, hit, found) in zip(rows, brute([docs[r.doc_id] for r in rows], bench)):
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (n, len(hit), len(found), digest)
