"""Token ids on disk: Re-Pair grammars per shard, and decoding from any position."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count as count_up

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_and_text
from .tokens import encoder

SHARD = (
    "bucket long, shard long, n_docs long, n_tokens long, "
    "doc_ids binary, starts binary, symbols binary, left binary, right binary, lengths binary"
)
DECODED = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_tokens(
    docs: DataFrame,
    vocabulary: str,
    path: str,
    end_id: int = 0,
    shard_tokens: int = 2_000_000,
    rounds: int | None = None,
) -> None:
    """Encode whole texts and write them in ascending doc_id order as compressed shards.

    One Parquet row is one shard of about `shard_tokens` ids (more where one
    document has more), with

    * `symbols`: the ids after Re-Pair, terminals below `1 << 20`, rules from there on;
    * `left`, `right`: what each rule expands to, and `lengths`: to how many ids;
    * `doc_ids`, `starts`: the documents and their first id within the shard.

    `bucket` and `shard` give the order of the shards. All numbers are
    little-endian, ids and rules 32 bits wide, doc_ids and starts 64. NULL text
    is a document with `end_id` alone; rows without a doc_id come first; rows
    that share one keep no order among them. An empty table writes no shards.
    """
    last = np.array([end_id], "<u4").tobytes()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(vocabulary).encode_all
        packed = lambda *x: pa.RecordBatch.from_pandas(_shard(*x, rounds), preserve_index=False)
        bucket, shard, size, doc_ids, parts = None, 0, 0, [], []
        for batch in batches:
            if batch.num_rows:
                bucket = batch["bucket"][0].as_py()  # of a partition
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode_all(batch["text"])):
                doc_ids.append(_NO_ID if doc_id is None else doc_id)
                parts.append(ids + last)
                size += len(parts[-1])
                if size >= 4 * shard_tokens:
                    yield packed(bucket, shard, doc_ids, parts)
                    shard, size, doc_ids, parts = shard + 1, 0, [], []
        if parts:
            yield packed(bucket, shard, doc_ids, parts)
        # Arrow keeps what it has freed; the worker goes on to other tasks.
        pa.default_memory_pool().release_unused()

    # Ranges of doc_ids, cut by a sample of ids that Spark draws; sorted within. Texts
    # move, not ids: encoding before would be done twice, once for that sample.
    # The number of a row parts those that share a doc_id.
    keys = [F.col("doc_id").asc_nulls_first(), F.col("row").asc()]
    ordered = (
        id_and_text(docs)
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(F.spark_partition_id().cast("long").alias("bucket"), "doc_id", "text")
    )
    ordered.mapInArrow(compress, SHARD).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files at `path`.

    `start` counts the ids of all documents before it: those of earlier shards of
    its bucket, and of earlier buckets, of which there are as many as the
    writer had partitions.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    sizes = shards.select("bucket", "shard", "n_tokens")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        sizes.groupBy("bucket")
        .agg(F.sum("n_tokens").alias("n"))
        .select("bucket", F.sum("n").over(earlier.orderBy("bucket")).alias("base"))
    )
    within = F.sum("n_tokens").over(earlier.partitionBy("bucket").orderBy("shard"))
    first = (
        sizes.withColumn("within", within)
        .join(buckets, "bucket")
        .select(
            "bucket",
            "shard",
            (F.coalesce("within", F.lit(0)) + F.coalesce("base", F.lit(0))).alias("first"),
        )
    )

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield _documents(row)

    # Only short rows are joined; the shards stay where they are read.
    decoded = shards.mapInPandas(decode, f"bucket long, shard long, {DECODED}")
    return decoded.join(first, ["bucket", "shard"]).select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_range(shard, first: int, last: int) -> np.ndarray:
    """Ids [first, last) of one shard row, expanding only the symbols that hold them."""
    symbols, rules = _symbols(shard)
    ends = np.cumsum(rules.lengths(symbols))
    a, b = np.searchsorted(ends, [first, last - 1], side="right") if last > first else (0, -1)
    if b < a:
        return np.empty(0, np.uint32)
    begin = int(ends[a - 1]) if a else 0
    return rules.expand(symbols[a : b + 1])[first - begin : last - begin]


def re_pair(ids: np.ndarray, ends: np.ndarray, rounds: int | None = None, least: int = 8):
    """(symbols, left, right, lengths): `ids` with frequent pairs replaced, round by round.

    Rounds go on until no pair is frequent, or end after `rounds` of them.

    Every round counts all neighbouring pairs, takes the pairs seen `least`
    times or more, makes each a rule, and replaces occurrences from left to
    right where they do not overlap; of two that do, the more frequent pair
    goes first. `ends` marks last ids of documents: no rule spans two documents.
    """
    symbols = ids.astype(np.int64)
    left, right, lengths = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    made = 0
    closed = ends.copy()
    # Where pairs begin that may be frequent. A pair that is not never will be, as rules only take
    # occurrences away; so a round looks at those beside new symbols and at those left over.
    at = np.flatnonzero(~closed[:-1])
    for _ in count_up() if rounds is None else range(rounds):
        kinds, kind, count, frequent = _frequent(symbols[at] << 32 | symbols[at + 1], least)
        if not len(kinds):
            break
        at = at[frequent]
        taken = _chosen(at, count.astype(np.int32)[kind])
        over, at, kind = at[~taken], at[taken], kind[taken]
        present = np.zeros(len(kinds), bool)
        present[kind] = True
        used, rule = kinds[present], (np.cumsum(present) - 1 + _RULES + made)[kind]
        left.append(used >> 32)
        right.append(used & 0xFFFFFFFF)
        known = np.concatenate(lengths)
        size = lambda s: np.where(s >= _RULES, known[np.maximum(s - _RULES, 0)] if made else 1, 1)
        lengths.append(size(left[-1]) + size(right[-1]))
        symbols[at] = rule
        second = at + 1
        closed[at] = closed[second]
        stay = np.ones(len(symbols), bool)
        stay[second] = False
        look = np.zeros(len(symbols), bool)
        look[over] = True
        look[at] = True
        # The symbol before a new one, two places back where that one is new as well.
        before = np.maximum(at - 1, 0)
        before -= ~stay[before]
        look[np.maximum(before, 0)] = True
        look &= ~closed
        stay = np.flatnonzero(stay)
        symbols, closed, look = symbols[stay], closed[stay], look[stay]
        look[-1] = False
        at = np.flatnonzero(look)
        made += len(used)
    return symbols, np.concatenate(left), np.concatenate(right), np.concatenate(lengths)


# Symbols from here on are rules; fixed in the file format.
_RULES = 1 << 20
_MIX = np.int64(-7046029254386353131)  # an odd multiplier, to spread pairs
_NO_ID = -(1 << 63)  # stands for a missing doc_id in the files


def _frequent(pair: np.ndarray, least: int):
    """(kinds, kind, count, frequent): the pairs seen `least` times or more, ascending, which are so, and their kinds."""
    kinds, count = np.unique(pair, return_counts=True)
    kinds, count = kinds[count >= least], count[count >= least]
    if not len(kinds):
        return kinds, kinds, count, np.empty(0, np.int64)
    # A table of hashes, small beside the pairs; kinds that share a place with another are looked up by bisection.
    bits = max(len(kinds).bit_length() + 4, 10)
    place = lambda p: (p * _MIX >> np.int64(64 - bits)) & np.int64((1 << bits) - 1)
    table = np.full(1 << bits, -1, np.int32)
    table[place(kinds)] = np.arange(len(kinds), dtype=np.int32)
    kind = table[place(pair)]
    perhaps = np.flatnonzero(kind >= 0)
    pair, kind = pair[perhaps], kind[perhaps]
    others = np.flatnonzero(kinds[kind] != pair)
    kind[others] = np.minimum(np.searchsorted(kinds, pair[others]), len(kinds) - 1)
    wrong = others[kinds[kind[others]] != pair[others]]
    if len(wrong):
        found = np.ones(len(kind), bool)
        found[wrong] = False
        kind, perhaps = kind[found], perhaps[found]
    return kinds, kind, count, perhaps


def _chosen(at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the occurrences to replace, so that none overlap.

    Neighbouring occurrences overlap. One that is more frequent than both its
    neighbours wins; what stands beside no winner is taken every other time.
    """
    touches = at[1:] == at[:-1] + 1
    wins = np.ones(len(at), bool)
    wins[1:] &= ~touches | (weight[1:] > weight[:-1])
    wins[:-1] &= ~touches | (weight[:-1] >= weight[1:])
    open_ = ~wins
    open_[1:] &= ~(touches & wins[:-1])
    open_[:-1] &= ~(touches & wins[1:])
    # Runs of open neighbours: every other one, from the first.
    left = np.flatnonzero(open_)
    joined = np.zeros(len(left), bool)
    joined[1:] = at[left[1:]] == at[left[:-1]] + 1
    index = np.arange(len(left))
    start = np.maximum.accumulate(np.where(joined, 0, index))
    wins[left[(index - start) % 2 == 0]] = True
    return wins


class _Rules:
    def __init__(self, left: np.ndarray, right: np.ndarray, lengths: np.ndarray):
        self.left, self.right, self.sizes = left, right, lengths

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        sizes = np.ones(len(symbols), np.int64)
        rule = symbols >= _RULES
        sizes[rule] = self.sizes[symbols[rule] - _RULES]
        return sizes

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for; of many, each rule is followed once and then copied."""
        symbols, n = symbols.astype(np.int64), len(self.left)
        if len(symbols) <= n:
            return self._unfolded(symbols)
        rules = self._unfolded(np.arange(_RULES, _RULES + n))
        first = np.cumsum(self.sizes) - self.sizes
        rule = symbols >= _RULES
        begin = np.arange(len(rules), len(rules) + len(symbols))
        begin[rule] = first[symbols[rule] - _RULES]
        sizes = self.lengths(symbols)
        place = np.cumsum(sizes)
        at = np.repeat(begin - (place - sizes), sizes)
        at += np.arange(len(at))
        return np.concatenate([rules, symbols.astype(np.uint32)])[at]

    def _unfolded(self, symbols: np.ndarray) -> np.ndarray:
        while len(symbols):
            rule = symbols >= _RULES
            if not rule.any():
                break
            place = np.cumsum(1 + rule) - 1 - rule  # where each symbol's expansion begins
            wide = np.empty(len(symbols) + int(rule.sum()), np.int64)
            wide[place[~rule]] = symbols[~rule]
            of = symbols[rule] - _RULES
            wide[place[rule]], wide[place[rule] + 1] = self.left[of], self.right[of]
            symbols = wide
        return symbols.astype(np.uint32)


def _shard(bucket, shard, doc_ids, parts, rounds) -> pd.DataFrame:
    ids = np.frombuffer(b"".join(parts), "<u4")
    counts = np.array([len(p) // 4 for p in parts], np.int64)
    last = np.cumsum(counts)
    ends = np.zeros(len(ids), bool)
    ends[last - 1] = True
    symbols, left, right, lengths = re_pair(ids, ends, rounds)
    row = {"bucket": int(bucket), "shard": shard, "n_docs": len(parts), "n_tokens": len(ids)}
    row["doc_ids"] = np.array(doc_ids, "<i8").tobytes()
    row["starts"] = (last - counts).astype("<i8").tobytes()
    for name, values in (("symbols", symbols), ("left", left), ("right", right)):
        row[name] = values.astype("<u4").tobytes()
    row["lengths"] = lengths.astype("<i8").tobytes()
    return pd.DataFrame([row])


def _symbols(shard) -> tuple[np.ndarray, _Rules]:
    left, right = np.frombuffer(shard.left, "<u4"), np.frombuffer(shard.right, "<u4")
    return np.frombuffer(shard.symbols, "<u4"), _Rules(left, right, np.frombuffer(shard.lengths, "<i8"))


def _documents(shard) -> pd.DataFrame:
    symbols, rules = _symbols(shard)
    ids = rules.expand(symbols).astype("<u4")
    doc_ids = np.frombuffer(shard.doc_ids, "<i8")
    starts = np.frombuffer(shard.starts, "<i8")
    ends = np.append(starts[1:], len(ids))
    raw = memoryview(ids.tobytes())
    return pd.DataFrame(
        {
            "bucket": shard.bucket,
            "shard": shard.shard,
            "doc_id": pd.array([None if d == _NO_ID else d for d in doc_ids.tolist()], "Int64"),
            "start": starts,
            "n_tokens": ends - starts,
            "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends)],
        }
    )
