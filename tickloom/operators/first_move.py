"""How long after each tick the price first stands higher, and first stands lower."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_micros, from_micros, whole_seconds


def first_move(
    ticks: DataFrame,
    horizon: int = 20,
    fill: float | None = None,
    partition_cols: tuple[str, ...] = (),
    exact: bool = False,
) -> DataFrame:
    """(*partition_cols, timestamp, higher_window, lower_window): one row per tick time.

    Later ticks in (t, t + horizon seconds] count. The gap is the difference of
    the two times, each rounded down to whole seconds. Where the price does not
    move in time the gap is NULL, or `fill`; note that a real move at exactly
    the horizon has the same gap as `fill=20.0`. Ticks of one time are one row,
    whatever their price or, unless partitioned, their symbol. With `exact`, on
    batch tables, the gap is that of the times themselves, in seconds and fractions.

    No pairs of ticks are formed. Per time only the lowest and highest price
    matter: a time sees a higher price when some later highest exceeds its own
    lowest. Batch input is then searched by trees of seconds, see `_search`; a
    stream is searched in rows that hold a second and what it looks ahead at,
    see `_search_stream`.
    """
    if horizon != int(horizon) or horizon < 1:
        raise ValueError("horizon must be a whole number of seconds")
    if exact and ticks.isStreaming:
        raise ValueError("exact gaps are found on batch tables only")
    keys = list(partition_cols)
    extremes = (
        ticks.filter(F.col("timestamp").isNotNull())
        .groupBy(*keys, "timestamp")
        .agg(
            F.min("price").cast("double").alias("lo"),
            F.max("price").cast("double").alias("hi"),
        )
    )
    if ticks.isStreaming:
        gaps = _search_stream(extremes, keys, int(horizon))
    else:
        gaps = _search(extremes, keys, int(horizon), exact)
    fill = F.lit(fill).cast("double")
    return gaps.select(
        *keys,
        "timestamp",
        *[F.coalesce(F.col(c).cast("double"), fill).alias(c) for c in _GAPS],
    )


def first_higher(moves: DataFrame) -> DataFrame:
    """The rows of `first_move` with a higher price, as sent to the consumers of rises."""
    return moves.filter(F.col("higher_window").isNotNull()).drop("lower_window")


def first_lower(moves: DataFrame) -> DataFrame:
    """The rows of `first_move` with a lower price, as sent to the consumers of falls."""
    return moves.filter(F.col("lower_window").isNotNull()).drop("higher_window")


_GAPS = ("higher_window", "lower_window")
_TIMES = "array<struct<us:bigint,lo:double,hi:double>>"


def _search(extremes: DataFrame, keys: list[str], horizon: int, exact: bool) -> DataFrame:
    """Batch search: times by second, and a tree of extremes over the seconds of two horizons.

    A row holds the times of one second, at most one per microsecond, and is what
    tasks are dealt: a crowded stretch of time spreads over its seconds. The first move lies

    * in the rest of the time's own second: running extremes from its end;
    * in one of the seconds in between: seconds are gathered per horizon, with those of
      the next one, and summed up two by two to a tree. A time climbs from its own second
      until a node has the price it looks for and goes down to the first second
      that has it. So the work grows with the logarithm of the horizon;
    * in the last second, which counts only up to t + horizon: running extremes
      from its beginning, joined from the second a horizon later.

    Both joins are between shuffled sides, where adaptive execution splits a hot one.
    With `exact` the second found is asked for its first time, see `_exact`.
    """
    span = horizon * 1_000_000
    key = [F.struct(*keys).alias("key")] if keys else []  # equal also where a key is NULL
    on = ["key"] if keys else []
    us = as_micros(F.col("timestamp"))
    seconds = (
        extremes.select(*key, us.alias("us"), "lo", "hi", _known(whole_seconds(us)).alias("second"))
        .groupBy(*on, "second")
        .agg(
            F.sort_array(F.collect_list(F.struct("us", "lo", "hi"))).alias("own"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
    )
    last = seconds.select(*on, (F.col("second") - horizon).alias("second"), F.col("own").alias("last"))
    block = _known(F.floor(F.col("second") / horizon))
    # One more key than trees are gathered by, so that they are shuffled for the join as well:
    # adaptive execution splits only joins of two shuffles.
    turn = _known(F.pmod(F.col("block"), F.lit(2)))
    trees = (
        seconds.select(*on, "second", "lo", "hi", F.explode(F.array(block, block - 1)).alias("block"))
        .groupBy(*on, "block")
        .agg(F.sort_array(F.collect_list(F.struct("second", "lo", "hi"))).alias("seconds"))
        .select(*on, "block", F.transform("seconds", lambda s: s["second"]).alias("at"), _tree(F.col("seconds")).alias("tree"))
    )
    rows = (
        seconds.select(*on, "second", "own")
        .join(last.hint("merge"), [*on, "second"], "left")
        .withColumns({"block": block, "turn": turn})
        .join(trees.withColumn("turn", turn).hint("merge"), [*on, "block", "turn"])
        .withColumn("last", F.coalesce("last", F.array().cast(_TIMES)))
    )

    def moves(e: Column) -> Column:
        """Per time: in which second a higher and a lower price come first, or when within its own."""
        return F.transform("own", lambda t, i: _let(e, lambda e: found(t, i, e)))

    def found(t: Column, i: Column, e: Column) -> Column:
        rest = F.get(e["rest"], i + 1)

        def gap(exceeds) -> Column:
            place = _first_node(F.col("tree"), e["start"], exceeds)
            between = F.get("at", place) - F.col("second")
            begun = F.get(e["begun"], _up_to(F.col("last"), t["us"] + F.lit(span), "us"))
            # Looked for once, though it is tested and given.
            soon = F.get(F.filter(F.array(between), lambda x: x < horizon), F.lit(0))
            return F.when(exceeds(rest), F.lit(0).cast("long")).otherwise(
                F.coalesce(soon, F.when(exceeds(begun), F.lit(horizon).cast("long")))
            )

        return F.struct(
            t["us"].alias("us"),
            t["lo"].alias("lo"),
            t["hi"].alias("hi"),
            gap(lambda x: x["hi"] > t["lo"]).alias("higher_window"),
            gap(lambda x: x["lo"] < t["hi"]).alias("lower_window"),
        )

    known = F.struct(
        _running(F.col("own"), 1).alias("rest"),
        _running(F.col("last"), -1).alias("begun"),
        (_up_to(F.col("at"), F.col("second"), bits=(2 * horizon).bit_length()) + 1).alias("start"),
    )
    result = _let(known, moves)
    names = [F.col("key")[c].alias(c) for c in keys]
    if exact:
        return _exact(rows.select(*on, "second", "own", result.alias("moves")), seconds, on).select(
            *names, from_micros(F.col("us")).alias("timestamp"), *_GAPS
        )
    return rows.select(*on, F.inline(result)).select(*names, from_micros(F.col("us")).alias("timestamp"), *_GAPS)


def _exact(rows: DataFrame, seconds: DataFrame, on: list[str]) -> DataFrame:
    """(key, us, higher_window, lower_window): gaps to the tick itself, in seconds.

    A move within the own second is looked for in a tree over its times. For others the
    second is known: a probe, with the price to exceed, goes there and finds the first time
    by bisection of the running extremes. Probes of one second for another travel
    as one row; a second that very many ask is split by the join.
    """
    within = {"higher_window": lambda x, q: x["hi"] > q["lo"], "lower_window": lambda x, q: x["lo"] < q["hi"]}

    def own_time(q: Column, i: Column, gap: str, tree: Column) -> Column:
        place = _first_node(tree, i + 1, lambda x: within[gap](x, q))
        return F.when(q[gap] == 0, F.get("own", place)["us"] - q["us"])

    def answered(q: Column, i: Column, tree: Column) -> Column:
        return F.struct(
            q["us"].alias("us"),
            q["lo"].alias("lo"),
            q["hi"].alias("hi"),
            *[F.when(q[gap] > 0, F.col("second") + q[gap]).alias(f"{gap}_in") for gap in _GAPS],
            *[own_time(q, i, gap, tree).alias(gap) for gap in _GAPS],
        )

    asked = _let(_tree(F.col("own")), lambda tree: F.transform("moves", lambda q, i: answered(q, i, tree)))
    asked = rows.select(*on, "second", F.inline(asked))
    price = {"higher_window": F.col("lo"), "lower_window": F.col("hi")}
    probes = asked.select(
        *on,
        "us",
        "second",
        F.inline(
            F.array(
                *[F.struct(F.lit(g).alias("gap"), F.col(f"{g}_in").alias("asks"), price[g].alias("price")) for g in _GAPS]
            )
        ),
    ).filter(F.col("asks").isNotNull())
    probes = probes.groupBy(*on, "second", "asks", "gap").agg(F.collect_list(F.struct("us", "price")).alias("probes"))
    there = seconds.select(*on, F.col("second").alias("asks"), F.col("own").alias("times"))
    met = probes.join(there.hint("merge"), [*on, "asks"])

    def first_time(running: Column, q: Column) -> Column:
        # Up to the last time whose running extreme is not beyond the price; the move is the next one.
        higher = F.col("gap") == "higher_window"
        before = _bisect(
            running,
            lambda x: F.when(higher, F.coalesce(x["hi"], q["price"]) <= q["price"]).otherwise(
                F.coalesce(x["lo"], q["price"]) >= q["price"]
            ),
        )
        return F.struct(
            q["us"].alias("us"), (F.get("times", F.coalesce(before, F.lit(-1)) + 1)["us"] - q["us"]).alias("micros")
        )

    hits = met.select(
        *on,
        "gap",
        F.inline(_let(_running(F.col("times"), -1), lambda r: F.transform("probes", lambda q: first_time(r, q)))),
    )
    gaps = hits.select(*on, "us", *[F.when(F.col("gap") == g, F.col("micros")).alias(g) for g in _GAPS])
    every = asked.select(*on, "us", *_GAPS).unionByName(gaps)
    return every.groupBy(*on, "us").agg(*[(F.max(g) / F.lit(1e6)).alias(g) for g in _GAPS])


def _known(number: Column) -> Column:
    """A number that is never NULL, said so that joins add no test of it and shuffles stay alike."""
    return F.coalesce(number, F.lit(0).cast("long"))


def _tree(entries: Column) -> Column:
    """Extremes of sorted entries, then of two neighbours, of four, up to one node over all."""

    def extremes(x: Column, y: Column | None = None) -> Column:
        if y is None:
            return F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"))
        return F.struct(F.least(x["lo"], y["lo"]).alias("lo"), F.greatest(x["hi"], y["hi"]).alias("hi"))

    def above(tree: Column, _) -> Column:
        return _let(
            F.element_at(tree, -1),
            lambda below: F.concat(
                tree,
                F.array(
                    F.transform(
                        F.sequence(F.lit(0), F.shiftright(F.size(below) - 1, 1)),
                        lambda i: extremes(F.get(below, 2 * i), F.get(below, 2 * i + 1)),
                    )
                ),
            ),
        )

    leaves = F.array(F.transform(entries, lambda x: extremes(x)))
    levels = F.ceil(F.log2(F.size(entries))).cast("int")
    return F.aggregate(F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.array().cast("array<int>")), leaves, above)


def _first_node(tree: Column, start: Column, exceeds) -> Column:
    """The place of the first leaf from `start` on that exceeds, NULL for none."""
    top = F.size(tree) - 1

    def node(level: Column, at: Column) -> Column:
        return F.coalesce(exceeds(F.get(F.get(tree, level), at)), F.lit(False))

    def climb(s: Column, level: Column) -> Column:
        # Right children, and the top, are looked at; a left one is part of its parent.
        looked = (s["level"] < 0) & ((s["at"] % 2 == 1) | (level == top))
        hit = F.when(looked, node(level, s["at"])).otherwise(False)
        return F.struct(
            F.when(hit | (s["level"] >= 0), s["at"]).otherwise(F.shiftright(s["at"] + 1, 1)).alias("at"),
            F.when(hit, level).otherwise(s["level"]).alias("level"),
        )

    def descend(s: Column, level: Column) -> Column:
        left = 2 * s["at"]
        below = F.when(node(level - 1, left), left).otherwise(left + 1)
        return F.struct(F.when(level <= s["level"], below).otherwise(s["at"]).alias("at"), s["level"].alias("level"))

    begin = F.struct(start.cast("int").alias("at"), F.lit(-1).alias("level"))
    found = F.aggregate(F.sequence(F.lit(0), top), begin, climb)
    down = F.when(top > 0, F.sequence(top, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(down, found, descend, lambda s: F.when(s["level"] >= 0, s["at"]))


def _search_stream(extremes: DataFrame, keys: list[str], horizon: int) -> DataFrame:
    """Streaming search by seconds: no self-join, and no row with all ticks of a horizon.

    Times are gathered per second, then each second is sent to the horizon of
    seconds before it: as its extremes only, and with its times to itself and to
    the last of them, where the look-ahead ends within it. So a second's row has
    the times of two seconds and one summary for each second between, and a feed
    spreads over the seconds even where it is not partitioned.

    In that row the times after each one in its second are known by their running
    extremes, from the end; so are those of the last second, from its
    beginning, up to a place found by bisection. The work per time is the
    horizon's summaries and the logarithm of the ticks in a second.
    """
    span = horizon * 1_000_000
    time = F.struct(as_micros(F.col("timestamp")).alias("us"), "lo", "hi")
    per_second = (
        extremes.groupBy(*keys, F.window("timestamp", "1 second").alias("second"))
        .agg(
            F.sort_array(F.collect_list(time)).alias("times"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
        .withColumn("ahead", F.window(F.window_time("second"), f"{horizon + 1} seconds", "1 second"))
    )
    start = F.col("second.start")
    after = whole_seconds(as_micros(start)) - whole_seconds(as_micros(F.col("ahead.start")))
    summary = F.struct(after.alias("after"), "lo", "hi")
    seen = (
        per_second.groupBy(*keys, "ahead")
        .agg(
            F.max(F.when(after == 0, F.col("times"))).alias("own"),
            F.max(F.when(after == horizon, F.col("times"))).alias("last"),
            F.collect_list(F.when((after > 0) & (after < horizon), summary)).alias("between"),
        )
        .filter(F.col("own").isNotNull())
    )
    empty = F.array().cast(_TIMES)
    rows = seen.select(*keys, "own", F.coalesce("last", empty).alias("last"), F.sort_array("between").alias("between"))

    def gaps(own: Column, last: Column, between: Column) -> Column:
        return _let(
            F.struct(_running(own, 1).alias("rest"), _running(last, -1).alias("begun")),
            lambda e: F.transform(own, lambda t, i: found(t, i, e, last, between)),
        )

    def found(t: Column, i: Column, e: Column, last: Column, between: Column) -> Column:
        def gap(same: Column, matches, final: Column) -> Column:
            first = F.get(F.filter(between, matches), F.lit(0))["after"]
            return F.when(same, F.lit(0)).otherwise(F.coalesce(first, F.when(final, F.lit(horizon))))

        def row(place: Column) -> Column:
            rest, begun = F.get(e["rest"], i + 1), F.get(e["begun"], place)
            return F.struct(
                t["us"].alias("us"),
                gap(rest["hi"] > t["lo"], lambda s: s["hi"] > t["lo"], begun["hi"] > t["lo"])
                .cast("long")
                .alias("higher_window"),
                gap(rest["lo"] < t["hi"], lambda s: s["lo"] < t["hi"], begun["lo"] < t["hi"])
                .cast("long")
                .alias("lower_window"),
            )

        return _let(_up_to(last, t["us"] + F.lit(span), "us"), row)

    result = _let(
        F.col("own"),
        lambda own: _let(F.col("last"), lambda last: _let(F.col("between"), lambda b: gaps(own, last, b))),
    )
    return rows.select(*keys, F.inline(result)).select(
        *keys, from_micros(F.col("us")).alias("timestamp"), *_GAPS
    )


# Distinct times within a second are at most 2 to this power.
_BITS = 20


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(times: Column, step: int) -> Column:
    """Extremes of each time and all after it (step 1) or before it (step -1), NULLs left out.

    By doubling: after k rounds each place knows 2 to the k of its neighbours.
    """

    def wider(known: Column, reach: Column) -> Column:
        def both(x: Column, i: Column) -> Column:
            j = i + step * reach
            y = F.when(j >= 0, F.get(known, j))
            return F.struct(F.least(x["lo"], y["lo"]).alias("lo"), F.greatest(x["hi"], y["hi"]).alias("hi"))

        return F.when(F.size(known) <= reach, known).otherwise(F.transform(known, both))

    extremes = F.transform(times, lambda t: F.struct(t["lo"].alias("lo"), t["hi"].alias("hi")))
    reaches = F.array(*[F.lit(1 << b) for b in range(_BITS)])
    # Most seconds have one time, which is its own extreme.
    return F.when(F.size(times) <= 1, extremes).otherwise(F.aggregate(reaches, extremes, wider))


def _up_to(values: Column, most: Column, field: str | None = None, bits: int = 0) -> Column:
    """The place of the last of the sorted values, or of their `field`, at or below `most`, -1 for none."""
    return F.coalesce(_bisect(values, lambda x: (x[field] if field else x) <= most, bits or _BITS), F.lit(-1))


def _bisect(values: Column, holds, bits: int = 0) -> Column:
    """The place of the last value for which `holds` is true; those before it have to be, too. NULL for none."""

    def nearer(place: Column, width: Column) -> Column:
        there = place + width
        return F.when(holds(F.get(values, there)) & (there < F.size(values)), there).otherwise(place)

    widths = F.array(*[F.lit(1 << b) for b in reversed(range(bits or _BITS))])
    return F.nullif(F.aggregate(widths, F.lit(-1), nearer), F.lit(-1))
