"""Near duplicates: every pair of documents whose word shingles overlap enough, and their groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, id_and_text, saved, ship
from .components import components

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
# Per byte: its lower case in A-Z plus one, and whether it is white space.
_LOWER = np.array([b + 33 if 65 <= b <= 90 else b + 1 for b in range(256)], np.uint64)
_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_SEGMENT = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of an odd number, modulo 2 to the 64."""
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), base, np.uint64)]))


class _Powers:
    """Powers of the base of word hashes and of its inverse, as many as the longest stretch so far needs."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(n - 1, 4095).bit_length()
            self.up, self.down = _powers(int(_STEP), size), _powers(pow(int(_STEP), -1, 1 << 64), size)
        return self.up, self.down


_kept = _Powers()


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of a text, in order, the same wherever a word stands.

    Words are lower-cased in A-Z and part at white space. All bytes are taken at once: each
    counts as itself times a power of the base for its place, sums of a
    word's bytes are taken back to where the word begins, and mixed. Long texts go
    stretch by stretch, each ending with a word.
    """
    raw = np.frombuffer(text.encode(), np.uint8) if text else np.empty(0, np.uint8)
    blank = np.ones(len(raw) + 2, bool)
    blank[1:-1] = _BLANK[raw]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    found = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        begin = starts[i]
        j = max(int(np.searchsorted(ends, begin + _SEGMENT, side="right")), i + 1)
        n = int(ends[j - 1] - begin)
        up, down = _kept.of(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LOWER[raw[begin : begin + n]] * up[:n], out=sums[1:])
        a = starts[i:j] - begin
        found[i:j] = (sums[ends[i:j] - begin] - sums[a]) * down[a]
        i = j
    found ^= found >> np.uint64(32)
    found *= _MIX
    found ^= found >> np.uint64(29)
    return found


def shingle_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """Hashes of all shingles of a text in order; fewer than `width` words are one, none are none."""
    h = word_hashes(text)
    if not len(h):
        return np.empty(0, np.int64)
    k = min(width, len(h))
    value = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        value = value * _STEP + h[i : len(h) - k + 1 + i]
    value ^= value >> np.uint64(29)
    value *= _MIX
    value ^= value >> np.uint64(32)
    return value.view(np.int64)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles: a row of the incidence matrix."""
    value = np.sort(shingle_hashes(text, width))
    return value[np.concatenate([[True], value[1:] != value[:-1]])] if len(value) else value


def class_key(row: np.ndarray, doc_id) -> int:
    """The same for equal sets; empty sets are equal to nothing but their own document."""
    if not len(row):
        return _signed(xxhash.xxh64_intdigest(f"empty {doc_id}"))
    return _signed(xxhash.xxh64_intdigest(row.tobytes()))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of `docs`.

    Documents link when the intersection of their shingle sets is at least
    `percent` per cent of the union; component_id is the smallest doc_id in reach.
    Rows with one doc_id are one document, and reach each other. Texts without
    words link with nothing. A row without doc_id has no component.
    """
    ship(docs.sparkSession)
    wide = incidence(docs, width, percent)
    one = wide.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("k").agg(
        *[F.first(c).alias(c) for c in ("n", "prefix", "rare", "bits")], F.min(F.struct("doc_id", "t")).alias("holder")
    )
    one = saved(one)
    table = saved(wide.select("doc_id", "n", "k"))
    discard(wide)
    named = table.filter(F.col("doc_id").isNotNull())
    same_id = (
        named.groupBy("doc_id")
        .agg(F.min("k").alias("a"), F.max("k").alias("z"))
        .filter("a <> z")
        .join(named.select("doc_id", F.col("k").alias("b")), "doc_id")
        .select("a", "b")
    )
    edges = links(docs, one, width, percent, saved(same_id))
    discard(one)
    groups = components(edges)
    discard(edges)
    labelled = named.select("doc_id", "n", "k").join(groups.withColumnRenamed("node", "k"), "k", "left")
    labelled = labelled.select("doc_id", "n", F.coalesce("root", "k").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = labelled.join(smallest, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    nameless = table.filter(F.col("doc_id").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return found.unionByName(nameless)


def incidence(docs: DataFrame, width: int, percent: int, most_common: int = 500_000, often: int = 32) -> DataFrame:
    """(doc_id, t, n, k, prefix, rare, bits): hash of the text, set size, class of equal sets, first columns, bitmap.

    The first `rare` of the columns are not known to be common; for `bits` see there.

    Two sets that link share one of the first n - ceil(percent n / 100) + 1
    columns of either, in any order of the columns that is the same for all. The
    order is by hash, but columns known to be common come last, so that a
    passage shared by many documents brings few of them together. Common are
    those that repeat within batches and add up to `often`; at most the
    `most_common` most frequent are told to all tasks, a bounded array. Which
    ones are known changes the work, never the result.
    """
    texts = id_and_text(docs)

    def repeated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Copies count once; what repeats within a text may count more often here.
            rows = [shingle_hashes(text, width) for text in batch["text"].drop_duplicates()]
            value = np.concatenate([*rows, np.empty(0, np.int64)])
            rows.clear()
            value.sort()
            begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])[: len(value)])
            n = np.diff(np.append(begin, len(value)))
            yield pd.DataFrame({"h": value[begin[n > 1]], "n": n[n > 1]})

    common = (
        texts.mapInPandas(repeated, "h long, n long")
        .groupBy("h")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= often)
        .orderBy(F.desc("n"), "h")
        .limit(most_common)
    )
    last = docs.sparkSession.sparkContext.broadcast(
        np.sort(common.select("h").toPandas()["h"].to_numpy(dtype=np.int64))
    )
    low = np.int64((1 << 22) - 1)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = last.value
        # Most columns are told apart by their last bits alone.
        marked = np.zeros(low + 1, bool)
        marked[known & low] = True
        for batch in batches:
            found = []
            for doc_id, text, t in zip(batch["doc_id"].array, batch["text"], batch["t"]):
                row = shingles(text, width)
                n = len(row)
                common = marked[row & low]
                asked = row[common]
                if len(asked):
                    common[common] = known[np.minimum(np.searchsorted(known, asked), len(known) - 1)] == asked
                take = n - (percent * n + 99) // 100 + 1 if n else 0
                rare = row[~common][:take]
                prefix = np.concatenate([rare, row[common]])[:take]
                found.append((doc_id, t, n, class_key(row, doc_id), prefix, len(rare), bits(row)))
            frame = pd.DataFrame(found, columns=["doc_id", "t", "n", "k", "prefix", "rare", "bits"])
            yield frame.astype({"doc_id": "Int64"})

    schema = "doc_id long, t long, n long, k long, prefix array<long>, rare long, bits array<long>"
    return saved(texts.withColumn("t", F.xxhash64("text")).mapInPandas(rows, schema))


def links(docs: DataFrame, one: DataFrame, width: int, percent: int, first: DataFrame) -> DataFrame:
    """(a, b): classes of equal sets that link, enough of them to connect all that do.

    `one` has a row for each class: k, n, prefix, rare, bits, and the (doc_id, t) of a holder.
    Candidates come from the product of the prefix columns, in two rounds. First
    each column names only its smallest row, which is multiplied with all others: a
    group of near copies, however large, costs a product for each member
    and not for each two. Then, of columns whose rows lie in several components
    still, the rows are multiplied block by block. Pairs within a component
    need no test. Pairs too different in size, with too few columns left after
    the one they share, or with bitmaps too far apart, are never made, and only rows
    that are left in some pair are made again. `first` has edges known from elsewhere; it is
    removed, as is every table once what it is for has been written.
    """
    spread = one.select("k", "n", "rare", F.posexplode("prefix").alias("at", "h"))
    own = F.struct("n", "k", "at")
    by_column = Window.partitionBy("h")
    # Columns not known to be common are met by few rows; common ones, a bounded number, are
    # added up before the shuffle, and their smallest rows are told to all tasks.
    few = (
        spread.filter(F.col("at") < F.col("rare"))
        .select("h", "k", "n", "at", F.count("k").over(by_column).alias("rows"), F.min(own).over(by_column).alias("head"))
        .filter(F.col("rows") > 1)
        .drop("rows")
    )
    many = spread.filter(F.col("at") >= F.col("rare")).select("h", "k", "n", "at")
    heads = many.groupBy("h").agg(F.min(own).alias("head"))
    columns = saved(few.unionByName(many.join(F.broadcast(heads), "h").select(few.columns)))

    head = F.col("head")
    stars = (
        columns.filter((F.col("k") != head["k"]) & _may_link(own, head, percent))
        .select(head["k"].alias("i"), F.col("k").alias("j"))
        .distinct()
    )
    stars = saved(_within_reach(stars, _marks(one), percent).select("i", F.col("j").alias("k"), F.col("j_n").alias("n")))
    matrix = incidence_rows(docs, one, stars.select("k").unionByName(stars.select(F.col("i").alias("k"))).distinct(), width)
    edges = saved(first.unionByName(multiplied(matrix, star_blocks(stars), percent)))
    discard(first, stars, matrix)

    groups = components(edges)
    placed = columns.select("h", "k", "n", "at").join(groups.withColumnRenamed("node", "k"), "k", "left")
    placed = saved(placed.select("h", own.alias("row"), F.coalesce("root", "k").alias("root")))
    mixed = placed.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("h")
    cells = saved(placed.join(mixed, "h").select("h", "row.*", "root"))
    discard(columns, placed)
    members = products(one, cells, percent)
    discard(cells)
    # Bitmaps go to all products, rows only to those where bitmaps leave them in some pair.
    words = F.greatest(F.lit(16), F.ceil(F.col("n") / 64))
    near = _in_rounds(members, words, lambda some: near_members(_marks(one), some, percent))
    left = reduce(DataFrame.unionByName, near)
    matrix = incidence_rows(docs, one, left.select("k").distinct(), width)
    found = _in_rounds(left, F.col("n"), lambda some: multiplied(matrix, some, percent))
    before, edges = edges, saved(reduce(DataFrame.unionByName, found, edges))
    discard(before, members, matrix, *near, *found)
    return edges


def _in_rounds(members: DataFrame, size: Column, work: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """What `work` makes of the members, in one saved table a round.

    What is joined to a member, `size` words, moves once for each product it is in. A round moves
    about four times as much as there is of it, so that what is shuffled at a time stays within that.
    """
    moved = members.agg(F.sum(size)).first()[0] or 0
    there = members.groupBy("k").agg(F.first(size).alias("size")).agg(F.sum("size")).first()[0] or 0
    rounds = max(-(-moved // max(4 * there, 1 << 23)), 1)
    of = F.pmod(F.xxhash64("i", "j"), F.lit(rounds))
    return [saved(work(members.filter(of == k))) for k in range(rounds)]


def products(one: DataFrame, cells: DataFrame, percent: int, rows: int = 256, entries: int = 1_000_000) -> DataFrame:
    """(i, j, side, k, n, root): the rows of each two blocks whose product may hold links between components.

    `cells` is (h, n, k, at, root): the columns that rows of several components
    share. Rows of about one size that have the same smallest such column form
    blocks of about `rows` rows and `entries` shingles, dealt by hash. Two blocks are
    multiplied in one task, once, whatever the number of columns they share; so no
    row is made for a pair of documents. Blocks whose sizes, positions or, for blocks of one
    row, bitmaps rule out every link, and those of one component alone, are not multiplied.
    """
    homes = cells.groupBy("k").agg(F.min("h").alias("home"), F.first("n").alias("n"), F.first("root").alias("root"))
    homes = homes.withColumn("band", F.floor(F.log("n") * 10))
    sizes = homes.groupBy("home", "band").agg(
        F.greatest(F.ceil(F.count("k") / rows), F.ceil(F.sum("n") / entries)).alias("parts")
    )
    part = F.pmod(F.xxhash64("k"), "parts")
    block_of = saved(
        homes.join(sizes, ["home", "band"]).select("k", "n", "root", F.xxhash64("home", "band", part).alias("block"))
    )
    parts = cells.join(block_of.select("k", "block"), "k").groupBy("h", "block").agg(
        F.min("n").alias("least"),
        F.max("n").alias("largest"),
        F.max(F.col("n") - F.col("at")).alias("most"),
        F.min("root").alias("first"),
        F.max("root").alias("last"),
    )
    parts = saved(parts)
    x, y = parts.alias("x"), parts.alias("y")
    p = F.lit(percent)
    sizes_fit = (100 * F.col("x.largest") >= p * F.col("y.least")) & (100 * F.col("y.largest") >= p * F.col("x.least"))
    most = F.least("x.most", "y.most")
    enough = (100 + percent) * most >= p * (F.col("x.least") + F.col("y.least"))
    roots_differ = F.least("x.first", "y.first") != F.greatest("x.last", "y.last")
    pairs = x.join(y, F.col("x.h") == F.col("y.h")).filter(
        (F.col("x.block") <= F.col("y.block")) & sizes_fit & enough & roots_differ
    )
    pairs = saved(pairs.select(F.col("x.block").alias("i"), F.col("y.block").alias("j")).distinct())
    alone = block_of.groupBy("block").agg(F.count("k").alias("rows"), F.first("k").alias("k")).filter("rows = 1")
    marks = saved(alone.select("block", "k").join(_marks(one), "k").select(F.col("block").alias("k"), "bits", "n"))
    near = saved(_within_reach(pairs, marks, percent).select("i", "j"))
    discard(parts, pairs, marks)
    left = near.join(block_of, near["i"] == block_of["block"]).select("i", "j", F.lit(0).alias("side"), "k", "n", "root")
    other = near.filter("i <> j").join(block_of, near["j"] == block_of["block"])
    members = saved(left.unionByName(other.select("i", "j", F.lit(1).alias("side"), "k", "n", "root")))
    discard(near, block_of)
    return members


def star_blocks(stars: DataFrame, rows: int = 256, entries: int = 1_000_000) -> DataFrame:
    """(i, j, side, k, root): the smallest row `i` of a column against the others, some at a time.

    A row that very many others meet is sent to each block `j` of these, so that no
    task holds them all.
    """
    parts = stars.groupBy("i").agg(
        F.greatest(F.ceil(F.count("k") / rows), F.ceil(F.sum("n") / entries)).alias("parts")
    )
    others = stars.join(parts, "i").select("i", F.pmod(F.xxhash64("k"), "parts").alias("j"), F.lit(1).alias("side"), "k")
    heads = parts.select("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("j"))
    heads = heads.select("i", "j", F.lit(0).alias("side"), F.col("i").alias("k"))
    return heads.unionByName(others).withColumn("root", F.col("k"))


def bits(row: np.ndarray) -> np.ndarray:
    """A bitmap in which each shingle sets one bit; as 64-bit words, 16 of them or, for long rows, up to 1024.

    Every bit set here and not in another row's bitmap stands for a shingle, at least,
    that the other row does not have. There is a bit or more for each shingle, so that long rows are
    told apart as well. A bitmap of twice the length folds into the shorter one.
    """
    words = 16
    while words < 1024 and 64 * words < len(row):
        words *= 2
    place = (row.view(np.uint64) & np.uint64(64 * words - 1)).astype(np.int64)
    found = np.zeros(64 * words, np.uint8)
    found[place] = 1
    return np.packbits(found).view(np.int64)


def _apart(x: Column, y: Column) -> Column:
    """How many bits of one bitmap the other lacks, both folded to the shorter length.

    Rows that may link have lengths within one doubling; of others nothing is said.
    """

    def folded(long: Column, short: Column) -> Column:
        half = F.size(short)
        parts = F.zip_with(
            F.slice(long, F.lit(1), half), F.slice(long, half + 1, half), lambda a, b: a.bitwiseOR(b)
        )
        return F.when(F.size(long) == 2 * half, parts).otherwise(long)

    each = F.zip_with(folded(x, y), folded(y, x), lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))))
    return F.aggregate(each, F.lit(0), lambda total, n: total + F.coalesce(n, F.lit(0)))


def _marks(one: DataFrame) -> DataFrame:
    return one.select("k", "bits", "n")


def _within_reach(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """(i, j, i_n, j_n): pairs without those whose bitmaps rule out a link; `marks` is (k, bits, n).

    Bitmaps move here and not rows. A pair of which one has no mark stays.
    """
    x, y = (
        marks.select(F.col("k").alias(c), F.col("bits").alias(f"{c}_bits"), F.col("n").alias(f"{c}_n")) for c in "ij"
    )
    both = pairs.select("i", "j").join(x, "i", "left").join(y, "j", "left")
    most = F.least(
        F.col("i_n") - _apart(F.col("i_bits"), F.col("j_bits")), F.col("j_n") - _apart(F.col("j_bits"), F.col("i_bits"))
    )
    reach = (100 + percent) * most >= percent * (F.col("i_n") + F.col("j_n"))
    return both.filter(F.coalesce(reach, F.lit(True))).select("i", "j", "i_n", "j_n")


def near_members(marks: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(i, j, side, k, n, root): the members that `in_reach` leaves of each group (i, j); `marks` is (k, bits, n)."""
    rows = members.select("i", "j", "side", "k", "root", "n").join(marks.select("k", "bits"), "k")
    rows = rows.select("i", "j", "side", "k", "root", "n", "bits")

    def left(group: tuple, kept: list[tuple]) -> list[tuple]:
        return [(*group, side, k, n, root) for side, k, root, n, _ in in_reach(kept, percent)]

    return _each_product(rows, left, "i long, j long, side long, k long, n long, root long")


def multiplied(matrix: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(a, b): the links `product` finds in each group (i, j) of `members` (i, j, side, k, root)."""
    rows = members.select("i", "j", "side", "k", "root").join(matrix.select("k", "row"), "k")
    rows = rows.select("i", "j", "side", "k", "root", "row")
    return _each_product(rows, lambda group, kept: product(kept, percent), "a long, b long")


def _each_product(rows: DataFrame, work: Callable[[tuple, list[tuple]], list[tuple]], schema: str) -> DataFrame:
    """What `work` finds in each group (i, j) of `rows`, given the group and its other columns; whole numbers."""
    names = [c.split()[0] for c in schema.split(", ")]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, kept = None, []
        for batch in batches:
            found = []
            for i, j, *row in zip(*(batch[c] for c in batch.columns)):
                if (i, j) != now:
                    found += work(now, kept) if kept else []
                    now, kept = (i, j), []
                kept.append(row)
            yield pd.DataFrame(found, columns=names).astype("int64")
        yield pd.DataFrame(work(now, kept) if kept else [], columns=names).astype("int64")

    return rows.repartition("i", "j").sortWithinPartitions("i", "j").mapInPandas(each, schema)


def in_reach(rows: list[tuple], percent: int, width: int = 256) -> list[tuple]:
    """Those of the rows (side, k, root, n, bits) that are in some pair of different roots whose bitmaps allow a link.

    Pairs are of both sides, or of the one there is. Bitmaps are folded to the shortest length there is, and
    what two have in common is added up `width` words at a time. The bound is that of `_within_reach`.
    """
    left = [r for r in rows if r[0] == 0]
    right = [r for r in rows if r[0] == 1] or left
    root_x, root_y = (np.array([r[2] for r in side], np.int64) for side in (left, right))
    open_ = root_x[:, None] != root_y
    if not open_.any():
        return []
    words = min(len(r[4]) for r in rows)
    x, y = (
        # Unsigned: of a negative number numpy counts the bits of its absolute value.
        np.stack([np.bitwise_or.reduce(np.reshape(r[4], (-1, words))) for r in side]).astype(np.int64).view(np.uint64)
        for side in (left, right)
    )
    common = np.zeros(open_.shape, np.int64)
    for begin in range(0, words, width):
        a, b = (
            np.unpackbits(np.ascontiguousarray(m[:, begin : begin + width]).view(np.uint8), axis=1).astype(np.float32)
            for m in (x, y)
        )
        common += (a @ b.T).astype(np.int64)
    n_x, n_y = (np.array([r[3] for r in side], np.int64) for side in (left, right))
    # Besides what is common, a row has a shingle at least for each bit that the other lacks.
    more_x, more_y = n_x - np.bitwise_count(x).sum(axis=1), n_y - np.bitwise_count(y).sum(axis=1)
    most = common + np.minimum(more_x[:, None], more_y)
    open_ &= (100 + percent) * most >= percent * (n_x[:, None] + n_y)
    found = [left[i] for i in np.flatnonzero(open_.any(axis=1))]
    return found if right is left else found + [right[j] for j in np.flatnonzero(open_.any(axis=0))]


def product(rows: list[tuple], percent: int, width: int = 2048) -> list[tuple[int, int]]:
    """Links between rows (side, k, root, shingles) of both sides, or of the one there is.

    Overlaps are added up column block by column block, `width` columns each,
    until no pair of different roots can reach the least overlap that links. Of the
    links only those are given that join roots not joined before.
    """
    left = [r for r in rows if r[0] == 0]
    right = [r for r in rows if r[0] == 1] or left
    if len(left) == len(right) == 1:
        (_, a, root_a, x), (_, b, root_b, y) = left[0], right[0]
        return [(a, b)] if root_a != root_b and overlaps(x, y, percent, 8) else []
    root_x, root_y = (np.array([r[2] for r in side], np.int64) for side in (left, right))
    n_x, n_y = (np.array([len(r[3]) for r in side], np.int64) for side in (left, right))
    need = -(-percent * (n_x[:, None] + n_y) // (100 + percent))
    open_ = (root_x[:, None] != root_y) & (need <= np.minimum(n_x[:, None], n_y))
    if not open_.any():
        return []
    column_x, column_y = (np.concatenate([r[3] for r in side]) for side in (left, right))
    at_x, at_y = np.repeat(np.arange(len(left)), n_x), np.repeat(np.arange(len(right)), n_y)
    if right is left:
        columns, times = np.unique(column_x, return_counts=True)
        columns = columns[times > 1]
    else:
        columns = np.intersect1d(column_x, column_y)
    place_x, at_x = _among(columns, column_x, at_x)
    place_y, at_y = (place_x, at_x) if right is left else _among(columns, column_y, at_y)
    rest_x, rest_y = np.bincount(at_x, minlength=len(left)), np.bincount(at_y, minlength=len(right))
    common = np.zeros(open_.shape, np.int64)
    for begin in range(0, len(columns), width):
        open_ &= common + np.minimum(rest_x[:, None], rest_y) >= need
        if not open_.any():
            return []
        wide = min(width, len(columns) - begin)
        x = _dense(place_x, at_x, begin, wide, len(left), rest_x)
        y = x if right is left else _dense(place_y, at_y, begin, wide, len(right), rest_y)
        common += (x @ y.T).astype(np.int64)
    found, above = [], {}

    def top(root: int) -> int:
        while root in above:
            root = above[root]
        return root

    for i, j in np.argwhere(open_ & (common >= need)).tolist():
        a, b = top(left[i][2]), top(right[j][2])
        if a != b:
            above[max(a, b)] = min(a, b)
            found.append((left[i][1], right[j][1]))
    return found


def _among(columns: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values among sorted `columns`, ascending, and their rows; others are let go."""
    if not len(columns):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.minimum(np.searchsorted(columns, values), len(columns) - 1)
    there = columns[place] == values
    place, at = place[there], at[there]
    order = np.argsort(place, kind="stable")
    return place[order], at[order]


def _dense(place, at, begin: int, width: int, rows: int, rest: np.ndarray) -> np.ndarray:
    """Columns [begin, begin + width) of a sparse block as a dense one; `rest` loses their counts."""
    a, b = np.searchsorted(place, [begin, begin + width])
    block = np.zeros((rows, width), np.float32)
    block[at[a:b], place[a:b] - begin] = 1
    rest -= np.bincount(at[a:b], minlength=rows)
    return block


def _may_link(x: Column, y: Column, percent: int) -> Column:
    """Bounds from sizes, and from how many columns follow the shared one in either row."""
    p = F.lit(percent)
    sizes = (100 * x["n"] >= p * y["n"]) & (100 * y["n"] >= p * x["n"])
    most = F.least(x["n"] - x["at"], y["n"] - y["at"])
    # |x & y| >= percent of |x | y| means (100 + percent) |x & y| >= percent (|x| + |y|).
    return sizes & ((100 + percent) * most >= p * (x["n"] + y["n"]))


def incidence_rows(docs: DataFrame, one: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(k, row): the rows of the given classes, one each, made again from the text of one document.

    Only classes that are left in some pair are asked for. A filter of a fixed size, a bit for
    the hash of each text that is wanted, lets most others go where they are
    read; the rest is joined by a shuffle at every size.
    Of repeated rows one is kept: the first of each task, as the join leaves them side
    by side, then the first of all tasks, where a hot one was split among several.
    """
    holders = saved(one.select("k", "holder.*").join(classes, "k").withColumnRenamed("k", "wanted"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = TaskContext.get().partitionId() << 40
        key, done = None, set()
        columns = ["k", "row", "at"]
        for batch in batches:
            found = []
            for doc_id, t, text, wanted in zip(batch["doc_id"], batch["t"], batch["text"], batch["wanted"]):
                if (doc_id, t) != key:
                    key, done = (doc_id, t), set()
                if wanted in done:
                    continue
                row = shingles(text, width)
                if class_key(row, doc_id) == wanted:  # the hash may stand for another text, too
                    done.add(wanted)
                    found.append((wanted, row, at))
                    at += 1
                if len(found) == 1000:
                    yield pd.DataFrame(found, columns=columns)
                    found = []
            yield pd.DataFrame(found, columns=columns)

    texts = id_and_text(docs).withColumn("t", F.xxhash64("text"))
    texts = texts.filter(_among_hashes(holders)("t")).join(holders.hint("merge"), ["doc_id", "t"])
    made = saved(texts.mapInPandas(rows, "k long, row array<long>, at long"))
    discard(holders)
    again = made.groupBy("k").agg(F.min("at").alias("first"), F.count("k").alias("times")).filter("times > 1")
    again = saved(again.select("k", "first"))
    if again.isEmpty():
        discard(again)
        return made
    single = saved(made.join(again, "k", "left").filter(F.col("at") == F.coalesce("first", "at")).select("k", "row"))
    discard(made, again)
    return single


def _among_hashes(wanted: DataFrame, power: int = 26):
    """A test of hashes `t`: true for all that are wanted, and for few others while these fill few of 2 to the `power` bits.

    The bits, 8 MB at most, are what is broadcast, whatever the number of hashes.
    """
    place = F.col("t").bitwiseAND(F.lit((1 << power) - 1))
    words = wanted.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    found = words.toPandas()
    table = np.zeros(1 << (power - 6), np.int64)
    table[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    sent = wanted.sparkSession.sparkContext.broadcast(table)

    def among(t: pd.Series) -> pd.Series:
        at = t.to_numpy(dtype=np.int64) & ((1 << power) - 1)
        return pd.Series((sent.value[at >> 6] >> (at & 63)) & 1 == 1)

    return F.pandas_udf(among, "boolean")


def overlaps(x: np.ndarray, y: np.ndarray, percent: int, blocks: int) -> bool:
    """The product of two rows, column block by column block, until what is left can add too little."""
    need = -(-percent * (len(x) + len(y)) // (100 + percent))  # the least overlap that links
    edges = np.linspace(-(1 << 63), (1 << 63) - 1024, blocks + 1)[1:-1].astype(np.int64)
    at_x, at_y = ([0, *np.searchsorted(s, edges).tolist(), len(s)] for s in (x, y))
    common = 0
    for i in range(blocks):
        a, b = x[at_x[i] : at_x[i + 1]], y[at_y[i] : at_y[i + 1]]
        common += len(np.intersect1d(a, b, assume_unique=True))
        if common + min(len(x) - at_x[i + 1], len(y) - at_y[i + 1]) < need:
            return False
    return common >= need


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value
