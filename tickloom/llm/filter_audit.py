"""How five text filters interact: what each one removes, at each place of every order they can run in."""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS

# The filters, by letter; the bit of the n-th letter is 2 to the n.
FILTERS = "ABCDE"
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    One row for each part, order of the five filters and step, zeros included. A
    part is a value of lang, NULL being the empty string; parts are those that
    have documents, so an empty table gives no rows. `shapley` is what the step's
    filter removes, added up over all orders.

    Each document is tested once and falls into the cell of its part and of the
    filters it fails: 32 cells a part at most, whatever the corpus. Only cells are
    folded over the orders. NULL texts are empty; repeated rows are documents each.
    A row without doc_id is no copy of anything, but others may be copies only of
    rows that have one. A document is good, or toxic, if any label of its doc_id says so.
    """
    return folded(cells(docs, labels))


def failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.split(trimmed, f"[{BLANKS}]+")
    n = F.when(trimmed == "", 0).otherwise(F.size(words))
    distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        n < 200,
        100 * distinct.cast("long") < 50 * n,
        100 * capitals.cast("long") > 3 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    bits = F.lit(0)
    for i, failed in enumerate(fails):
        bits = bits + F.when(failed, 1 << i).otherwise(0)
    return bits


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the filters they fail, as bits.

    Texts are compared by their SHA-256. Rows are counted per text, part and doc_id before
    the first shuffle and per text, part and label before the second, so a text that
    very many documents have is a handful of rows where its smallest doc_id is looked up.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        failures(text).alias("mask"),
    )
    documents = rows.groupBy("digest", "mask", "part", "doc_id").agg(F.count("part").alias("n"))
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
    )
    no = F.lit(False)
    # Rows without doc_id have no label; left out of the join, they are no hot key of it.
    named = documents.filter(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left")
    named = named.withColumns({c: F.coalesce(c, no) for c in ("good", "toxic")})
    nameless = documents.filter(F.col("doc_id").isNull()).withColumns({"good": no, "toxic": no})

    def when_named(value: Column) -> Column:
        return F.when(F.col("doc_id").isNotNull(), value)

    groups = (
        named.unionByName(nameless)
        .groupBy("digest", "mask", "part", "good", "toxic")
        .agg(
            F.min(when_named(F.struct("doc_id", "n"))).alias("first"),
            F.sum("n").alias("n"),
            F.coalesce(F.sum(when_named(F.col("n"))), F.lit(0)).alias("named"),
        )
    )
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("first.doc_id") == F.col("smallest"), F.col("first.n")).otherwise(0)
    copy = 1 << FILTERS.index("E")
    split = (
        groups.withColumn("smallest", smallest)
        .withColumn("copies", F.col("named") - F.coalesce(firsts, F.lit(0)))
        .select(
            "part",
            "good",
            "toxic",
            F.inline(
                F.array(
                    F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
                    F.struct((F.col("mask") + copy).alias("mask"), F.col("copies").alias("n")),
                )
            ),
        )
        .filter("n > 0")
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def order_array() -> Column:
    """All orders of the filters, as (filter_order, bits): one constant that goes along with the plan."""
    orders = [
        {"filter_order": "".join(o), "bits": [1 << FILTERS.index(f) for f in o]} for o in permutations(FILTERS)
    ]
    return F.from_json(F.lit(json.dumps(orders)), "array<struct<filter_order:string,bits:array<int>>>")


def folded(cells: DataFrame) -> DataFrame:
    """The result, from the cells: each folds over all orders, and their structs are added up by place.

    A cell becomes an array of 600 structs, one per order and step; of each part
    at most 32 such arrays meet, whatever the number of documents.
    """
    steps = cells.select("part", F.flatten(F.transform(order_array(), _steps)).alias("steps"))
    merged = steps.groupBy("part").agg(F.collect_list("steps").alias("all")).select("part", _added("all").alias("steps"))
    totals = F.transform(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), _removed_by)
    rows = merged.withColumn("totals", totals).select("part", "totals", F.posexplode("steps").alias("at", "s"))
    n = len(FILTERS)
    place = F.log2(F.col("s.bit")).cast("int")
    return rows.select(
        "part",
        F.get(order_array(), F.floor(F.col("at") / n).cast("int"))["filter_order"].alias("filter_order"),
        (F.col("at") % n + 1).cast("int").alias("step"),
        *[F.col("s")[c].alias(c) for c in _COUNTS],
        F.get("totals", place).alias("shapley"),
    )


def _steps(order: Column) -> Column:
    """What a cell's documents add to each step of one order."""
    mask = F.col("mask")
    kind = "array<struct<bit:int," + ",".join(f"{c}:bigint" for c in _COUNTS) + ">>"
    start = F.struct(F.lit(0).alias("seen"), F.array().cast(kind).alias("steps"))

    def step(done: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        gone = mask.bitwiseAND(done["seen"]) != 0

        def counted(condition: Column, column: str = "n") -> Column:
            return F.when(condition, F.col(column)).otherwise(F.lit(0).cast("long"))

        here = fails & ~gone
        values = (
            counted(~fails & ~gone),
            counted(here),
            counted(fails & gone),
            counted(mask == bit),
            counted(here, "good"),
            counted(here, "toxic"),
        )
        added = F.struct(bit.alias("bit"), *[v.alias(c) for c, v in zip(_COUNTS, values)])
        return F.struct((done["seen"] + bit).alias("seen"), F.concat(done["steps"], F.array(added)).alias("steps"))

    return F.aggregate(order["bits"], start, step)["steps"]


def _added(arrays: str) -> Column:
    """Arrays of one length, added up element by element."""

    def both(x: Column, y: Column) -> Column:
        return F.struct(x["bit"].alias("bit"), *[(x[c] + y[c]).alias(c) for c in _COUNTS])

    rest = F.slice(arrays, F.lit(2), F.size(arrays))
    return F.aggregate(rest, F.get(arrays, F.lit(0)), lambda x, y: F.zip_with(x, y, both))


def _removed_by(bit: Column) -> Column:
    def add(total: Column, s: Column) -> Column:
        return total + F.when(s["bit"] == bit, s["removed"]).otherwise(F.lit(0).cast("long"))

    return F.aggregate("steps", F.lit(0).cast("long"), add)


# The same in SQL.
AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS least FROM texts GROUP BY t
), marks AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), worded AS (
  SELECT texts.doc_id, part, t, least, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w
  FROM texts JOIN firsts USING (t)
), fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
         + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(worded.doc_id > least, false)::INT AS mask
  FROM worded LEFT JOIN marks ON worded.doc_id = marks.doc_id
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, bit)
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, f, bit,
         coalesce((SELECT sum(x.bit) FROM letters x WHERE strpos(filter_order, x.f) < step), 0)::INT AS seen
  FROM orders, range(1, 6) AS r(step), letters WHERE substr(filter_order, step, 1) = f
), counted AS (
  SELECT part, filter_order, step::INT AS step, f,
         sum((mask & bit = 0 AND mask & seen = 0)::INT)::BIGINT AS kept,
         sum((mask & bit > 0 AND mask & seen = 0)::INT)::BIGINT AS removed,
         sum((mask & bit > 0 AND mask & seen > 0)::INT)::BIGINT AS redundant,
         sum((mask = bit)::INT)::BIGINT AS unique_fails,
         sum((mask & bit > 0 AND mask & seen = 0)::INT * good)::BIGINT AS good_lost,
         sum((mask & bit > 0 AND mask & seen = 0)::INT * toxic)::BIGINT AS toxic_lost
  FROM fails, steps GROUP BY ALL
)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counted"""
