"""Shards of nearly equal bytes: sampled splitters, ranges of keys, overfull ranges subdivided."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

_LEAST = -(1 << 63)


def shards(
    docs: DataFrame,
    shards: int = 8,
    samples: int = 4096,
    range_rows: int = 250_000,
    whole_share: float = 0.005,
    rounds: int = 3,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): one row per document.

    size is the text's UTF-8 bytes plus 1, NULL counting as none; law is `bytes`;
    slot counts gapless from 0 within a shard; grown_shard is NULL under this law.

    Records are put in order of a key: the hash of the text, so that equal texts
    lie together. A group of equal texts above `whole_share` of a shard's bytes,
    or of its rows, may be divided, and its key goes on with the doc_id and the number of the row; there
    are at most 2 * shards / whole_share such groups, which is what is broadcast.

    1. A sample of keys is drawn, each row with a probability in proportion to its
       size: `samples` of them, or 16 per `range_rows` rows if that is more.
    2. Its quantiles split the keys into ranges; rows and bytes of each are counted.
    3. Ranges above four times the mean in rows or bytes are subdivided by a
       sample of their own, at most `rounds` times.
    4. Within each range the rows are ranked and their bytes added up. With the
       sums of the ranges before, each row, or whole group, knows where the middle
       of its bytes lies among all bytes, and so its shard.

    Shards differ from each other by no more than one document or the size of a
    whole group. The sample decides how work is dealt, never the result.
    Randomness is a hash of the row, so a task done again draws the same rows.
    NULL doc_ids come first; repeated rows are rows; nothing gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = saved(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    total = rows.agg(F.count("size").alias("n"), F.sum("size").alias("bytes")).first()
    n, size = total.n, total.bytes or 0
    large = (
        rows.groupBy("h")
        .agg(F.count("size").alias("n"), F.sum("size").alias("bytes"))
        .filter(
            (F.col("bytes") * shards > F.lit(whole_share * size))
            | (F.col("n") * shards > F.lit(whole_share * n))
        )
        .select("h", F.lit(True).alias("divisible"))
    )
    keyed = rows.join(F.broadcast(saved(large)), "h", "left").select(
        "doc_id",
        "size",
        "text_crc32",
        "h",
        F.coalesce("divisible", F.lit(False)).alias("divisible"),
        F.when(F.col("divisible"), F.coalesce("doc_id", F.lit(_LEAST)))
        .otherwise(F.lit(_LEAST))
        .alias("sub"),
        F.when(F.col("divisible"), F.col("row")).otherwise(F.lit(_LEAST)).alias("row"),
    )

    ranges = max(8 * shards, math.ceil(n / range_rows))
    wanted = max(samples, 16 * ranges)
    drawn = _sample(keyed, F.col("size") * (wanted / max(size, 1)), 0)
    splitters = _quantiles(drawn, ranges)
    for again in range(1, rounds + 1):
        placed = keyed.withColumn("range", _range(splitters))
        counts = _counts(placed)
        overfull = [
            k
            for k, (rows_in, bytes_in) in counts.items()
            if rows_in > 4 * max(n / ranges, 64) or bytes_in > 4 * size / ranges
        ]
        if not overfull:
            break
        inside = placed.filter(_one_of(F.col("range"), overfull))
        rows_inside = sum(counts[k][0] for k in overfull)
        parts = math.ceil(sum(max(counts[k][0] * ranges / n, counts[k][1] * ranges / size) for k in overfull))
        more = _sample(inside, F.lit(16 * parts / rows_inside).cast("double"), again)
        grown = sorted({*splitters, *_quantiles(more, parts)})
        if grown == splitters:
            break
        splitters = grown
    placed = keyed.withColumn("range", _range(splitters))
    counts = _counts(placed)

    rows_before, bytes_before, r, b = [], [], 0, 0
    for k in range(len(splitters) + 1):
        rows_before.append(r)
        bytes_before.append(b)
        r, b = r + counts.get(k, (0, 0))[0], b + counts.get(k, (0, 0))[1]

    by_key = Window.partitionBy("range").orderBy("h", "sub", "row", "doc_id", "size")
    up_to = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("range", "h")
    whole_group = Window.partitionBy("range").orderBy("h")
    ranked = placed.select(
        "*",
        (F.row_number().over(by_key).cast("long") - 1 + _at(rows_before)).alias("place"),
        F.when(
            F.col("divisible"),
            2 * F.sum("size").over(up_to) - F.col("size"),
        )
        .otherwise(2 * F.sum("size").over(whole_group) - F.sum("size").over(group))
        .alias("twice_middle"),
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        "place",
        F.least(
            F.lit(shards - 1),
            F.floor(
                (F.col("twice_middle") + 2 * _at(bytes_before)).cast("decimal(38,0)")
                * F.lit(shards)
                / F.lit(max(2 * size, 1)).cast("decimal(20,0)")
            ),
        )
        .cast("int")
        .alias("shard"),
    )
    ranked = saved(ranked)
    first = ranked.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return ranked.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _sample(rows: DataFrame, chance: Column, salt: int) -> list[tuple[int, int, int]]:
    """Sorted keys of the rows drawn, each with its chance; their number is set by the caller."""
    draw = F.pmod(F.xxhash64("doc_id", "h", "size", "row", F.lit(salt)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return sorted((r.h, r.sub, r.row) for r in rows.filter(draw < chance).select("h", "sub", "row").collect())


def _quantiles(keys: list[tuple[int, int, int]], parts: int) -> list[tuple[int, int, int]]:
    return sorted({keys[len(keys) * k // parts] for k in range(1, parts)}) if keys else []


def _range(splitters: list[tuple[int, int, int]]) -> Column:
    """How many splitters are at most the row's key: a binary search, some steps a row."""
    if not splitters:
        return F.lit(0)
    hs, subs, numbers = (_numbers(key[k] for key in splitters) for k in range(3))
    n = len(splitters)

    def step(at, bit):
        i = at + bit - 1
        h, sub, row = F.get(hs, i), F.get(subs, i), F.get(numbers, i)
        within = (sub < F.col("sub")) | ((sub == F.col("sub")) & (row <= F.col("row")))
        fits = (at + bit <= F.lit(n)) & ((h < F.col("h")) | ((h == F.col("h")) & within))
        return F.when(fits, at + bit).otherwise(at)

    bits = [1 << k for k in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*[F.lit(b) for b in bits]), F.lit(0), step)


def _counts(placed: DataFrame) -> dict[int, tuple[int, int]]:
    """Rows and bytes per range; there are as many as splitters, a set number."""
    found = placed.groupBy("range").agg(F.count("size").alias("n"), F.sum("size").alias("bytes"))
    return {r["range"]: (r.n, r.bytes) for r in found.collect()}


def _numbers(values) -> Column:
    """An array literal of many numbers, as text for a short plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _one_of(column: Column, values: list[int]) -> Column:
    return F.array_contains(_numbers(values), column.cast("long"))


def _at(values: list[int]) -> Column:
    return F.get(_numbers(values), F.col("range"))
