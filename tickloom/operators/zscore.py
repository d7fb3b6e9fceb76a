"""How far each tick lies from the mean of every window that holds it, in deviations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_micros, floor_micros, from_micros
from ..widths import SIX, nested
from .window_stats import last_instant, watermark_of, width_seconds, window_stats


def zscore_rows(ticks: DataFrame, stats: DataFrame, widths=SIX) -> DataFrame:
    """(timestamp, symbol, window, zscore_price): ticks joined to given window statistics.

    `stats` has the columns of `window_stats`, with ends on multiples of the
    width. The score is NULL where the deviation is missing or not positive.

    A tick lies in exactly one window per width, so the join is on symbol,
    window and window end, not on a range. As it moves each tick once per
    width, use `tick_zscores` where a batch is scored by its own statistics.

    Of two streams each row is kept until the watermark passes the end of its own
    window, and not for the longest one. Ticks that come together wait together: a row
    that is kept has those of one batch and a quarter of the shortest window, see `packed`. Ticks of a long window
    are dealt over several keys by a hash of that quarter, its few statistics go to all of these. Rows
    come out when their window's statistics are there, so by their `timestamp` they
    are up to the longest width late: group them with `zscore_array`, which knows.
    """
    widths = nested(widths)
    us = as_micros(F.col("timestamp"))

    def spans(of: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(w.label).alias("window"),
                    (floor_micros(of, w.micros) + F.lit(w.micros)).alias("end"),
                    F.lit(_keys_of(w)).alias("keys"),
                )
                for w in widths
            ]
        )

    p = ticks.filter(F.col("price").isNotNull() & F.col("timestamp").isNotNull())
    if not (ticks.isStreaming and stats.isStreaming):
        p = p.select("timestamp", "symbol", "price", F.inline(spans(us))).alias("p")
        m = stats.withColumn("end", us).alias("m")
        if not (ticks.isStreaming or stats.isStreaming):
            # The statistics can outgrow the ticks they are estimated from: no broadcast.
            m = m.hint("merge")
        same = (F.col("p.symbol") == F.col("m.symbol")) & (F.col("p.window") == F.col("m.window"))
        return p.join(m, same & (F.col("p.end") == F.col("m.end"))).select(
            F.col("p.timestamp").alias("timestamp"),
            F.col("p.symbol").alias("symbol"),
            F.col("p.window").alias("window"),
            zscore(F.col("p.price"), F.col("m.avg_price"), F.col("m.std_price")).alias("zscore_price"),
        )
    # Event time is the end of the window on both sides, and nothing else.
    salt = F.pmod(F.xxhash64("slot"), F.col("keys")).cast("int")
    p = packed(p, widths[0].micros // _PARTS).select("symbol", "slot", "us", "price", F.inline(spans(F.col("slot")))).select(
        last_instant(F.col("end"), ticks), "symbol", "window", salt.alias("salt"), "us", "price"
    )
    salts = F.lit(1)
    for w in widths:
        salts = F.when(F.col("window") == w.label, _keys_of(w)).otherwise(salts)
    m = stats.filter(F.col("timestamp").isNotNull()).select(
        last_instant(us, stats), "symbol", "window", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "avg_price", "std_price"
    )
    met = p.join(m, ["last_instant", "symbol", "window", "salt"]).select(
        "symbol", "window", "avg_price", "std_price", F.inline(F.arrays_zip("us", "price"))
    )
    return met.select(
        from_micros(F.col("us")).alias("timestamp", metadata=watermark_of(ticks)),
        "symbol",
        "window",
        zscore(F.col("price"), F.col("avg_price"), F.col("std_price")).alias("zscore_price"),
    )


_PARTS = 4  # divides any whole number of seconds


def packed(ticks: DataFrame, micros: int, most: int = 1024, held: int = 1 << 20) -> DataFrame:
    """(symbol, slot, us, price): ticks of one symbol and stretch of `micros`, side by side in arrays.

    On a stream these are the ticks of one batch. A row has at most `most` of them; a task
    packs `held` ticks at a time. Rows without symbol, time or price are let go.
    """
    us = as_micros(F.col("timestamp"))
    rows = ticks.filter(F.col("symbol").isNotNull() & F.col("price").isNotNull() & us.isNotNull())
    rows = rows.select("symbol", floor_micros(us, micros).alias("slot"), us.alias("us"), "price")

    # All within, as this package need not be installed where tasks run.
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(kept: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(kept).combine_chunks()
            symbol = table["symbol"].combine_chunks().dictionary_encode()
            code, slot = symbol.indices.to_numpy(), table["slot"].to_numpy()
            order = np.lexsort((slot, code))
            code, slot = code[order], slot[order]
            n = len(order)
            new = np.concatenate([[True], (code[1:] != code[:-1]) | (slot[1:] != slot[:-1])])
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            first = np.flatnonzero((np.arange(n) - begin) % most == 0)
            offsets = pa.array(np.append(first, n).astype(np.int32))
            arrays = [pa.ListArray.from_arrays(offsets, pa.array(table[c].to_numpy()[order])) for c in ("us", "price")]
            names = symbol.dictionary.take(pa.array(code[first]))
            return pa.RecordBatch.from_arrays([names, pa.array(slot[first]), *arrays], ["symbol", "slot", "us", "price"])

        kept, n = [], 0
        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                n += batch.num_rows
            if n >= held:
                yield made(kept)
                kept, n = [], 0
        if kept:
            yield made(kept)

    schema = "symbol string, slot long, us array<long>, price array<double>"
    return rows.repartition("symbol", "slot").mapInArrow(pack, schema)


def _keys_of(width) -> int:
    """Over how many keys the ticks of a window are dealt on a stream: one for each quarter of an hour."""
    return max(1, width.seconds // 900)


def tick_zscores(ticks: DataFrame, widths=SIX, rollup: bool = False) -> DataFrame:
    """(timestamp, symbol, zscores): each tick of a batch scored against its own windows.

    One row per tick with an array of (window, zscore_price), one element per width.
    """
    widths = nested(widths)
    scored = _scored(ticks, widths, rollup)
    return scored.select(
        "timestamp", "symbol", F.array(*_labelled(F.col("z"), widths)).alias("zscores")
    )


def zscores(ticks: DataFrame, widths=SIX, rollup: bool = False) -> DataFrame:
    """`zscore_array` of `tick_zscores`, regrouped where the join left the rows.

    Ticks of one time and symbol share block and part, so grouping by these as
    well changes no group and lets Spark reuse the partitioning of the join.
    """
    widths = nested(widths)
    scored = _scored(ticks, widths, rollup)
    grouped = scored.groupBy("symbol", "block", "part", "timestamp").agg(
        F.collect_list("z").alias("zs")
    )
    per_width = [_all_of_width(F.col("zs"), i, w) for i, w in enumerate(widths)]
    single = F.array(*_labelled(F.get(F.col("zs"), F.lit(0)), widths))
    return grouped.select(
        "timestamp",
        "symbol",
        F.when(F.size("zs") == 1, single).otherwise(F.concat(*per_width)).alias("zscores"),
    )


def zscore_array(rows: DataFrame, widths=SIX) -> DataFrame:
    """(timestamp, symbol, zscores): the scores of one tick time in one array.

    Ticks that share time and symbol merge; NULL scores stay as elements.
    Elements are in order of width, then score, NULL last. Rows without a time
    are let go; on a stream they would be kept for ever.

    On a stream a tick time is complete when the longest of `widths` that holds it
    has closed. Until then the scores of one symbol and shortest window wait together, side
    by side in arrays of times and scores, see `_packed_scores`; their times are parted when they come out.
    """
    timed = rows.filter(F.col("timestamp").isNotNull())
    if rows.isStreaming:
        return _arrays_of_stream(timed, nested(widths))
    element = F.struct(
        width_seconds(F.col("window")).alias("seconds"),
        F.col("zscore_price").isNull().alias("missing"),
        "zscore_price",
        "window",
    )
    return timed.groupBy("timestamp", "symbol").agg(
        F.transform(
            F.sort_array(F.collect_list(element)),
            lambda e: F.struct(
                e["window"].alias("window"), e["zscore_price"].alias("zscore_price")
            ),
        ).alias("zscores")
    )


def _arrays_of_stream(rows: DataFrame, widths) -> DataFrame:
    shortest, longest = widths[0], widths[-1]
    end = floor_micros(F.col("slot"), longest.micros) + F.lit(longest.micros)
    # The time itself is no event time here.
    seconds = width_seconds(F.col("window")).alias("seconds")
    packed = _packed_scores(rows, shortest.micros).select(
        last_instant(end, rows), "symbol", "slot", F.struct("window", seconds, "us", "z").alias("scores")
    )
    waiting = packed.groupBy("last_instant", "symbol", "slot").agg(F.collect_list("scores").alias("scores"))

    # All within, as this package need not be installed where tasks run.
    def parted(batch: pa.RecordBatch) -> pa.RecordBatch:
        window, seconds, times, zs = batch["scores"].flatten().flatten()
        of_pack = np.repeat(np.arange(batch.num_rows), batch["scores"].value_lengths().to_numpy())
        pack = np.repeat(np.arange(len(of_pack)), times.value_lengths().to_numpy())
        row, us, z = of_pack[pack], times.flatten().to_numpy(), zs.flatten()
        # Labels of one length in the order of their bytes, NULL first.
        labels = window.dictionary_encode()
        rank = np.argsort(np.argsort([label.encode() for label in labels.dictionary.to_pylist()]))
        rank = np.append(rank, -1)[labels.indices.fill_null(-1).to_numpy()].astype(int)
        missing, value = z.is_null().to_numpy(zero_copy_only=False), z.fill_null(0.0).to_numpy()
        order = np.lexsort((rank[pack], value, missing, seconds.to_numpy()[pack], us, row))
        row, us = row[order], us[order]
        first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (us[1:] != us[:-1])]))
        offsets = pa.array(np.append(first, len(order)).astype(np.int32))
        elements = [window.take(pa.array(pack[order])), z.take(pa.array(order))]
        arrays = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(elements, ["window", "zscore_price"]))
        symbols = batch["symbol"].take(pa.array(row[first]))
        return pa.RecordBatch.from_arrays([pa.array(us[first]), symbols, arrays], ["us", "symbol", "zscores"])

    def part(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Rows of about `most` scores at a time.
            *_, times, _ = batch["scores"].flatten().flatten()
            packs = np.append(0, np.cumsum(times.value_lengths().to_numpy()))
            ends = packs[np.cumsum(batch["scores"].value_lengths().to_numpy())]
            cuts = np.flatnonzero(np.diff(ends // most, append=-1)) + 1
            for begin, end in zip([0, *cuts[:-1]], cuts):
                yield parted(batch.slice(begin, end - begin))

    found = waiting.select("symbol", "scores").mapInArrow(
        part, "us long, symbol string, zscores array<struct<window: string, zscore_price: double>>"
    )
    return found.select(from_micros(F.col("us")).alias("timestamp"), "symbol", "zscores")


def _packed_scores(rows: DataFrame, micros: int, held: int = 1 << 20) -> DataFrame:
    """(symbol, window, slot, us, z): scores of one symbol, window label and stretch of `micros`, side by side.

    They are packed where they lie, `held` at a time.
    """
    # No column more than needed: Spark measures a batch for Arrow anew with each of its rows, column by column.
    flat = rows.select("symbol", "window", as_micros(F.col("timestamp")).alias("us"), F.col("zscore_price").alias("z"))

    # All within, as this package need not be installed where tasks run.
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def coded(column: pa.Array) -> np.ndarray:
            codes = column.dictionary_encode().indices
            return codes.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)

        def made(kept: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            symbol, window, us = coded(whole["symbol"]), coded(whole["window"]), whole["us"].to_numpy()
            name, slot = symbol * (int(window.max()) + 2) + window, us - us % micros
            order = np.lexsort((slot, name))
            name, slot = name[order], slot[order]
            first = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (slot[1:] != slot[:-1])]))
            offsets = pa.array(np.append(first, len(order)).astype(np.int32))
            names = [whole[c].take(pa.array(order[first])) for c in ("symbol", "window")]
            arrays = [pa.ListArray.from_arrays(offsets, whole[c].take(pa.array(order))) for c in ("us", "z")]
            return pa.RecordBatch.from_arrays([*names, pa.array(slot[first]), *arrays], ["symbol", "window", "slot", "us", "z"])

        kept, n = [], 0
        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                n += batch.num_rows
            if n >= held:
                yield made(kept)
                kept, n = [], 0
        if kept:
            yield made(kept)

    return flat.mapInArrow(pack, "symbol string, window string, slot long, us array<long>, z array<double>")


def zscore(price: Column, avg: Column, std: Column) -> Column:
    return F.when(std.isNotNull() & (std > 0), (price - avg) / std)


def _scored(ticks: DataFrame, widths, rollup: bool) -> DataFrame:
    """(timestamp, symbol, block, part, z): scores in order of width.

    The ticks move once, on symbol and a part of the longest width (5 minutes
    for the six widths), not once per width. The statistics of all windows that
    touch a part are one small row, with a place per window (19 for the six
    widths), built from the windows of one symbol and block, which is the
    longest width (at most 199 windows).

    Both sides of the join are shuffled for it, so adaptive skew handling can
    split a hot part. The statistics grow with the data and are larger than what
    Spark estimates from the scan, so they are never broadcast.
    """
    if ticks.isStreaming:
        raise ValueError("streams are scored with zscore_rows, against a stream of statistics")
    ticks = ticks.filter(
        F.col("symbol").isNotNull() & F.col("price").isNotNull() & F.col("timestamp").isNotNull()
    )
    longest = widths[-1]
    part = next((w for w in reversed(widths) if longest.seconds >= 12 * w.seconds), widths[0])
    in_block, in_part, blocks, parts = {}, {}, 0, 0
    for w in widths:
        in_block[w], in_part[w] = blocks, parts
        blocks += longest.seconds // w.seconds
        parts += max(1, part.seconds // w.seconds)

    def steps(us: Column, of: int, width: int) -> Column:
        """In which stretch of `width` within the enclosing one of `of` a time lies."""
        return F.floor(F.pmod(us, F.lit(of)) / F.lit(width)).cast("int")

    last = as_micros(F.col("timestamp")) - 1
    at = F.lit(None).cast("int")
    for w in widths:
        place = F.lit(in_block[w]) + steps(last, longest.micros, w.micros)
        at = F.when(F.col("window") == w.label, place).otherwise(at)
    usable = F.when(F.col("std_price") > 0, F.col("std_price"))
    entry = F.struct(at.alias("at"), F.struct("avg_price", usable.alias("std_price")))
    windows = (
        window_stats(ticks, widths, rollup)
        .groupBy("symbol", floor_micros(last, longest.micros).alias("block"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("windows"))
    )
    # Every tick leaves a window of the shortest width, which tells the parts in use.
    per_part = part.seconds // widths[0].seconds
    shortest = F.filter(
        F.map_keys("windows"), lambda k: k < F.lit(longest.seconds // widths[0].seconds)
    )
    used = F.array_distinct(
        F.transform(shortest, lambda k: F.floor(k / F.lit(per_part)).cast("int"))
    )

    def row_of(field: str) -> Column:
        def value(place: Column) -> Column:
            return F.col("windows")[place][field]

        found = []
        for w in widths:
            n = part.seconds // w.seconds
            if n:
                inside = F.sequence(F.lit(0), F.lit(n - 1))
                first = F.lit(in_block[w]) + F.col("part") * n
                found.append(F.transform(inside, _offset(value, first)))
            else:
                around = F.floor(F.col("part") * part.seconds / F.lit(w.seconds)).cast("int")
                found.append(F.array(value(F.lit(in_block[w]) + around)))
        return F.concat(*found)

    stats = windows.select("symbol", "block", "windows", F.explode(used).alias("part")).select(
        "symbol", "block", "part", row_of("avg_price").alias("avgs"), row_of("std_price").alias("stds")
    )

    us = as_micros(F.col("timestamp"))
    keyed = ticks.select(
        "timestamp",
        "symbol",
        "price",
        floor_micros(us, longest.micros).alias("block"),
        steps(us, longest.micros, part.micros).alias("part"),
    )

    def score(w) -> Column:
        place = F.lit(in_part[w])
        if w.seconds < part.seconds:
            place = place + steps(us, part.micros, w.micros)
        return (F.col("price") - F.get("avgs", place)) / F.get("stds", place)

    return keyed.join(stats.hint("merge"), ["symbol", "block", "part"]).select(
        "timestamp", "symbol", "block", "part", F.array(*[score(w) for w in widths]).alias("z")
    )


def _offset(value, first: Column):
    return lambda i: value(first + i)


def _all_of_width(zs: Column, i: int, w) -> Column:
    scores = F.array_sort(F.transform(zs, lambda z: z[i]))
    return F.transform(
        scores, lambda z: F.struct(F.lit(w.label).alias("window"), z.alias("zscore_price"))
    )


def _labelled(z: Column, widths) -> list[Column]:
    return [
        F.struct(F.lit(w.label).alias("window"), z[i].alias("zscore_price"))
        for i, w in enumerate(widths)
    ]
