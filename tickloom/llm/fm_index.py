"""Benchmark contamination: an FM-index per shard of documents, searched for test phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

# Lower-cases A-Z and makes every other byte outside words a blank: words are runs of
# digits, letters and bytes of characters beyond ASCII.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_END, _OTHER = 0, 1  # symbols; words of the phrases follow

FOUND = (
    "n_words long, n_hit long, spans array<struct<first: long, last: long>>, items array<string>"
)


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 13,
    percent: int = 5,
    shard_words: int = 1_000_000,
    block_phrases: int = 200_000,
) -> DataFrame:
    """`docs` and one struct column `contamination` (or `_contamination`, where that is taken).

    Its fields: n_words; n_hit, the words inside any occurrence of a phrase; spans,
    those words as merged ranges [first, last) of word numbers; items, the sorted
    ids of the items found; contaminated, whether n_hit is positive and at least
    `percent` per cent of n_words. A phrase is `width` consecutive words of an
    item, or the whole of a shorter one.

    Every row is searched by itself, so repeated rows get equal results, and no
    row moves. NULL and empty texts have no words. Items without id or words are
    not searched for. The phrases are a query set: they pass through the driver
    in blocks of at most `block_phrases`, each block one search of all documents.
    """
    name = fresh(docs, "contamination")
    parts = []
    for i, block in enumerate(phrase_blocks(benchmark, width, block_phrases)):
        parts.append(fresh(docs, f"found_{i}"))
        search = F.pandas_udf(_search(block, shard_words), FOUND)
        docs = docs.withColumn(parts[-1], search(F.col("text")))
    found = F.col(parts[0])
    if len(parts) > 1:
        found = F.pandas_udf(_united, FOUND)(*[F.col(p) for p in parts])
    docs = docs.withColumn(name, found)
    verdict = _verdict(F.col(name), percent)
    return docs.withColumn(name, verdict).drop(*parts)


def _verdict(found: Column, percent: int) -> Column:
    n, hit = found["n_words"], found["n_hit"]
    return F.struct(
        n.alias("n_words"),
        hit.alias("n_hit"),
        found["spans"].alias("spans"),
        F.array_sort(found["items"]).alias("items"),
        ((hit > 0) & (100 * hit >= percent * n)).alias("contaminated"),
    )


@dataclass
class Phrases:
    """A block of distinct phrases: their words numbered, right-aligned in a matrix."""

    number: dict[bytes, int]
    matrix: np.ndarray  # one row a phrase, -1 where it is shorter
    lengths: np.ndarray
    items: list[str]
    first: np.ndarray  # items of phrase p: of[first[p]:first[p + 1]]
    of: np.ndarray
    width: int


def phrase_blocks(benchmark: DataFrame, width: int, most: int) -> Iterator[Phrases]:
    """Phrases of all items, at most about `most` windows a block; one empty block for none."""
    items, size, any_block = [], 0, False
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    for row in rows.filter(F.col("item").isNotNull()).toLocalIterator():
        found = words(row.text)
        if not found:
            continue
        windows = max(1, len(found) - width + 1)
        if items and size + windows > most:
            yield _phrases(items, width)
            items, size, any_block = [], 0, True
        items.append((row.item, found))
        size += windows
    if items or not any_block:
        yield _phrases(items, width)


def _phrases(items: list[tuple[str, list[bytes]]], width: int) -> Phrases:
    number: dict[bytes, int] = {}
    of: dict[tuple, set[int]] = {}
    names = {name: i for i, name in enumerate(dict.fromkeys(name for name, _ in items))}
    for name, found in items:
        ids = [number.setdefault(w, len(number) + 2) for w in found]
        for i in range(max(1, len(ids) - width + 1)):
            of.setdefault(tuple(ids[i : i + width]), set()).add(names[name])
    matrix = np.full((len(of), width), -1, np.int64)
    for row, phrase in enumerate(of):
        matrix[row, width - len(phrase) :] = phrase
    counts = [len(x) for x in of.values()]
    return Phrases(
        number,
        matrix,
        np.array([len(p) for p in of], np.int64),
        list(names),
        np.concatenate([[0], np.cumsum(counts)]).astype(np.int64),
        np.array([i for x in of.values() for i in sorted(x)], np.int64),
        width,
    )


class FMIndex:
    """Counts and locates patterns in a sequence of symbols that ends with its only 0.

    Holds the Burrows-Wheeler transform as a wavelet matrix, the number of smaller
    symbols for each symbol, and every `every`-th suffix position.
    """

    def __init__(self, text: np.ndarray, every: int = 16):
        order = suffix_order(text)
        self.size = len(text)
        self.bits = max(1, int(text.max()).bit_length())
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.bits))])
        self.ones, self.zeros = [], []
        level = text[order - 1].astype(np.int32)
        for bit in reversed(range(self.bits)):
            one = level >> bit & 1
            self.ones.append(np.concatenate([[0], np.cumsum(one, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(level) - int(self.ones[-1][-1]))
            level = np.concatenate([level[one == 0], level[one == 1]])
        sampled = order % every == 0
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - sampled
        self.samples = order[sampled]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its row of the transform."""
        start = np.zeros(len(row), np.int64)
        for level, bit in enumerate(reversed(range(self.bits))):
            ones, one = self.ones[level], (symbol >> bit & 1).astype(bool)
            a, b = ones[start], ones[row]
            start = np.where(one, self.zeros[level] + a, start - a)
            row = np.where(one, self.zeros[level] + b, row - b)
        return row - start

    def step(self, row: np.ndarray) -> np.ndarray:
        """From the row of each suffix to the row of the suffix one symbol longer."""
        at, symbol = row, np.zeros(len(row), np.int64)
        start = np.zeros(len(row), np.int64)
        for level in range(self.bits):
            ones = self.ones[level]
            one = (ones[at + 1] - ones[at]).astype(bool)
            a, b = ones[start], ones[at]
            start = np.where(one, self.zeros[level] + a, start - a)
            at = np.where(one, self.zeros[level] + b, at - b)
            symbol = symbol << 1 | one
        return self.smaller[symbol] + at - start

    def search(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, low, high) of those that occur; matrix rows are right-aligned, -1 before."""
        pattern = np.arange(len(matrix))
        low, high = np.zeros(len(matrix), np.int64), np.full(len(matrix), self.size, np.int64)
        for column in reversed(range(matrix.shape[1])):
            symbol = matrix[pattern, column]
            go = symbol >= 0
            known = go & (symbol < 1 << self.bits)
            at = symbol[known]
            low[known] = self.smaller[at] + self.rank(at, low[known])
            high[known] = self.smaller[at] + self.rank(at, high[known])
            high[go & ~known] = low[go & ~known]
            alive = low < high
            pattern, low, high = pattern[alive], low[alive], high[alive]
        return pattern, low, high

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Text position of each row's suffix: walk back to a sampled one."""
        position, walked = np.zeros(len(row), np.int64), 0
        waiting = np.arange(len(row))
        while len(waiting):
            there = self.sampled[row]
            position[waiting[there]] = self.samples[self.sample_rank[row[there]]] + walked
            waiting, row = waiting[~there], self.step(row[~there])
            walked += 1
        return position


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions of the sorted suffixes, by prefix doubling among those still equal."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    covered = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for i in range(covered):
        key <<= bits
        key[: max(0, n - i)] |= text[i:]
    order = np.argsort(key)
    begins = np.ones(n, bool)
    begins[1:] = np.diff(key[order]) != 0
    rank = np.empty(n, np.int64)
    places = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(begins, places, 0))
    slots = places
    while True:
        ends = np.ones(n, bool)
        ends[:-1] = begins[1:]
        slots = slots[~(begins[slots] & ends[slots])]  # in groups of more than one
        if not len(slots):
            return order
        tied = order[slots]
        after = tied + covered
        key = rank[tied] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        order[slots] = tied
        begins[slots[1:]] |= key[1:] != key[:-1]
        begin = np.where(begins[slots], slots, 0)
        rank[tied] = np.maximum.accumulate(begin)
        covered *= 2


def _search(block: Phrases, shard_words: int):
    def found(texts: pd.Series) -> pd.DataFrame:
        return _search_batch(texts, block, shard_words)

    return found


def _search_batch(texts: pd.Series, block: Phrases, shard_words: int) -> pd.DataFrame:
    """Index the batch in shards of about `shard_words` words; a longer text is cut, overlapping."""
    n = len(texts)
    counts, hits = np.zeros(n, np.int64), np.zeros(n, np.int64)
    spans: list = [[] for _ in range(n)]
    items: list = [set() for _ in range(n)]
    number, shard, size = block.number.get, [], 0

    def flush():
        if shard and len(block.matrix):
            for doc, ranges, names in _search_shard(shard, block):
                spans[doc] += ranges
                items[doc] |= names

    for doc, text in enumerate(texts):
        found = words(text)
        counts[doc] = len(found)
        if not found:
            continue
        ids = np.fromiter((number(w, _OTHER) for w in found), np.int32, len(found))
        for at in range(0, len(ids), shard_words):
            part = ids[at : at + shard_words + block.width - 1]
            shard.append((doc, at, part))
            size += len(part)
            if size >= shard_words:
                flush()
                shard, size = [], 0
    flush()
    for doc in range(n):
        if len(spans[doc]) > 1:
            spans[doc] = _merged(spans[doc])
        hits[doc] = sum(b - a for a, b in spans[doc])
    return pd.DataFrame(
        {
            "n_words": counts,
            "n_hit": hits,
            "spans": [[{"first": a, "last": b} for a, b in x] for x in spans],
            "items": [sorted(x) for x in items],
        }
    )


def _search_shard(shard: list[tuple[int, int, np.ndarray]], block: Phrases):
    """(document, merged word ranges, item ids) of every part with occurrences.

    Words that no phrase has are one symbol, and runs of it one symbol long: no
    occurrence reaches across. `where` leads back to word numbers.
    """
    symbols, where, starts, base = [], [], [], 0
    for _, _, ids in shard:
        keep = np.ones(len(ids), bool)
        keep[1:] = (ids[1:] != _OTHER) | (ids[:-1] != _OTHER)
        symbols += [ids[keep], [_OTHER]]
        where += [np.flatnonzero(keep) + base, [-1]]
        starts.append(base)
        base += len(ids)
    text = np.concatenate([*symbols, [_END]]).astype(np.int64)
    where, starts = np.concatenate(where), np.array(starts)
    index = FMIndex(text)
    pattern, low, high = index.search(block.matrix)
    if not len(pattern):
        return
    counts = high - low
    rows = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    pattern = np.repeat(pattern, counts)
    first = where[index.locate(rows)]
    last = first + block.lengths[pattern]
    part = np.searchsorted(starts, first, side="right") - 1

    edges = np.bincount(first, minlength=base + 1) - np.bincount(last, minlength=base + 1)
    inside = np.cumsum(edges)[:base] > 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | np.isin(np.arange(1, base), starts)
    closes[:-1] &= ~inside[1:] | np.isin(np.arange(1, base), starts)
    ranges = np.stack([np.flatnonzero(opens), np.flatnonzero(closes) + 1], axis=1)
    of_range = np.searchsorted(starts, ranges[:, 0], side="right") - 1

    pairs = np.unique(part * len(block.matrix) + pattern)
    named: dict[int, set[str]] = {}
    for p, phrase in zip((pairs // len(block.matrix)).tolist(), (pairs % len(block.matrix)).tolist()):
        of = block.of[block.first[phrase] : block.first[phrase + 1]]
        named.setdefault(p, set()).update(block.items[i] for i in of.tolist())
    for p, names in named.items():
        doc, at, _ = shard[p]
        own = ranges[of_range == p] - starts[p] + at
        yield doc, [tuple(x) for x in own.tolist()], names


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _united(*found: pd.DataFrame) -> pd.DataFrame:
    """The results of several blocks of phrases as one."""
    n_words = found[0]["n_words"]
    spans, items = [], []
    for parts in zip(*[zip(f["spans"], f["items"]) for f in found]):
        spans.append(_merged([(r["first"], r["last"]) for s, _ in parts for r in s]))
        items.append(sorted({i for _, x in parts for i in x}))
    return pd.DataFrame(
        {
            "n_words": n_words,
            "n_hit": [sum(b - a for a, b in x) for x in spans],
            "spans": [[{"first": a, "last": b} for a, b in x] for x in spans],
            "items": items,
        }
    )
