"""Quality rules: counts per text, fixed limits, and robust multivariate outliers."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, saved

_WHITE = " \t\n\x0b\x0c\r"
# Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"

# What the distances are measured on: logarithms of counts and of percentages.
_VECTOR = ("length", "word_length", "symbols", "repeats", "same_lines", "not_letters", "capitals")


def quality_rules(
    docs: DataFrame,
    least_words: int = 10,
    most_repeats: int = 20,
    core: float = 0.75,
    steps: int = 3,
    least_rows: int = 100,
    cut: float = 1e-7,
) -> DataFrame:
    """(doc_id, counts, base_failed, distance, kept): one row per row of `docs`.

    The counts are n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.
    base_failed: fewer than `least_words` words, or more than `most_repeats` per
    cent of them in repeated five-word windows. NULL text has no words.

    Rows that pass are compared with others of their language and source. A vector of
    transformed counts gets its distance from the minimum-covariance-determinant
    estimate of its cell: from a start by medians, `steps` times the share `core` of
    rows nearest to the estimate so far gives the next mean and covariance, whose
    determinant never grows. Distances are scaled to the median expected of
    normal vectors; beyond the chi-square quantile 1 - `cut` a row is not kept.
    Every variance is raised by a small floor, so cells with constant counts
    have an estimate. Languages and sources that are NULL are cells of their own;
    cells below `least_rows` rows are pooled by language, then over all. A pool
    still below that rejects nothing, and its distances are NULL.

    Only DataFrame functions: cells are aggregated before the shuffle, so there a hot
    one is no more than a row per task; estimates are joined back, not collected. As written
    tables of known size they are broadcast while small; beyond that both sides of the join are
    shuffled, where adaptive execution splits a hot cell.
    """
    rows = saved(_counts(docs, least_words, most_repeats))
    passed = rows.filter(~F.col("base_failed"))
    cells = saved(_cells(passed, least_rows))
    vectors = passed.join(cells, ["lang", "source"]).select("row", "cell", *_vector())
    estimate = saved(_estimate(vectors.select("cell", *_VECTOR), core, steps, least_rows))
    found = _distances(vectors, estimate).select(
        "row", (F.col("d2") / F.col("scale")).alias("distance")
    )
    limit = chi_square(len(_VECTOR), 1 - cut)
    joined = rows.join(found, "row", "left")
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.sqrt("distance").alias("distance"),
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"),
    )


def chi_square(degrees: int, share: float) -> float:
    """The chi-square quantile, by Wilson and Hilferty's approximation."""
    part = 2 / (9 * degrees)
    return degrees * (1 - part + NormalDist().inv_cdf(share) * part**0.5) ** 3


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, width: int = 5) -> Column:
    """How many words lie in windows of `width` words that are found twice or more."""

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - width)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))

    def covered(hashes: Column) -> Column:
        def again(pairs: Column) -> Column:
            def twice(pair: Column, k: Column) -> Column:
                same = [
                    F.coalesce(F.get(pairs, at)["h"] == pair["h"], F.lit(False)) for at in (k - 1, k + 1)
                ]
                return F.when(same[0] | same[1], pair["i"])

            places = F.sort_array(F.array_compact(F.transform(pairs, twice)))
            start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
            return F.aggregate(
                places,
                start,
                lambda acc, i: F.struct(
                    i.alias("last"), (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n")
                ),
                lambda acc: acc["n"],
            )

        numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, _let(F.sort_array(numbered), again)).otherwise(F.lit(0))

    return _let(
        words,
        lambda w: F.when(F.size(w) >= width, _let(windows(w), covered)).otherwise(F.lit(0)),
    )


def _counts(docs: DataFrame, least_words: int, most_repeats: int) -> DataFrame:
    text = F.col("text")
    words = F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")
    lines = F.transform(
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_WHITE)) != ""),
        lambda x: F.xxhash64(x),
    )
    of_words = _let(
        words,
        lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")),
    )
    of_lines = _let(
        lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("kinds"))
    )
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang"), F.lit("\0")).alias("lang"),
        F.coalesce(F.col("source"), F.lit("\0")).alias("source"),
    )
    counted = plain.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "lang",
        "source",
        of_words.alias("words"),
        of_lines.alias("lines"),
        F.length(F.translate(text, _WHITE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
    )
    n, again = F.col("words.n").cast("long"), F.col("words.again").cast("long")
    return counted.select(
        "row",
        "doc_id",
        "lang",
        "source",
        n.alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("lines.n") - F.col("lines.kinds")).cast("long").alias("n_dup_lines"),
        again.alias("n_repeat_words"),
        F.col("lines.n").cast("long").alias("n_lines"),
        "n_letters",
        "n_capitals",
        ((n < least_words) | (100 * again > most_repeats * n)).alias("base_failed"),
    )


def _vector() -> list[Column]:
    def per_cent(part: Column, whole: str) -> Column:
        return F.log1p(100 * part / F.greatest(F.col(whole), F.lit(1)))

    return [
        F.log1p(F.col("n_words").cast("double")).alias("length"),
        F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))).alias("word_length"),
        per_cent(F.col("n_symbols"), "word_chars").alias("symbols"),
        per_cent(F.col("n_repeat_words"), "n_words").alias("repeats"),
        per_cent(F.col("n_dup_lines"), "n_lines").alias("same_lines"),
        per_cent(F.col("word_chars") - F.col("n_letters"), "word_chars").alias("not_letters"),
        per_cent(F.col("n_capitals"), "n_letters").alias("capitals"),
    ]


def _cells(rows: DataFrame, least: int) -> DataFrame:
    """(lang, source, cell): cells of few rows are pooled. A row per pair, not per document."""
    pairs = rows.groupBy("lang", "source").count()
    small = pairs.filter(F.col("count") < least)
    pools = small.groupBy("lang").agg((F.sum("count") >= least).alias("pooled"))
    return pairs.join(pools, "lang", "left").select(
        "lang",
        "source",
        F.when(F.col("count") >= least, F.concat(F.lit("source\1"), "lang", F.lit("\1"), "source"))
        .when(F.col("pooled"), F.concat(F.lit("lang\1"), "lang"))
        .otherwise(F.lit("all"))
        .alias("cell"),
    )


# In units of the logarithms: the deviation that any cell has at least. Shares of repeats and
# symbols are 0 in most texts; without it, a text with a few would stand far out. Repeats have a
# limit of their own, so here only the combination with others should tell.
_FLOORS = {c: 0.7 if c in ("repeats", "same_lines") else 0.35 for c in _VECTOR}


def _estimate(vectors: DataFrame, core: float, steps: int, least: int) -> DataFrame:
    """Mean, Cholesky factor and scale per cell, as columns m_i, l_i_j and scale."""
    d = range(len(_VECTOR))
    middles = saved(
        vectors.groupBy("cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.percentile_approx(c, F.lit(0.5), F.lit(1000)).alias(f"m_{i}") for i, c in enumerate(_VECTOR)],
        )
        .filter(F.col("n") >= least)
    )
    spreads = vectors.join(middles, "cell").groupBy("cell").agg(
        *[
            F.percentile_approx(F.abs(F.col(c) - F.col(f"m_{i}")), F.lit(0.5), F.lit(1000)).alias(f"s_{i}")
            for i, c in enumerate(_VECTOR)
        ]
    )
    # The start: a diagonal covariance from the median deviations.
    now = middles.join(spreads, "cell").select(
        "cell",
        "n",
        *[f"m_{i}" for i in d],
        *[
            (F.greatest(1.4826 * F.col(f"s_{i}"), F.lit(_FLOORS[_VECTOR[i]])) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}")
            for i in d
            for j in range(i + 1)
        ],
    )
    for _ in range(steps):
        now = saved(now)
        limits = _distances(vectors, now).groupBy("cell").agg(
            F.percentile_approx("d2", F.lit(core), F.lit(1000)).alias("limit")
        )
        # Written, so that Spark knows its size before it plans the join: a few rows are broadcast, more are not.
        limited = saved(now.join(limits, "cell"))
        inside = _distances(vectors, limited).filter(F.col("d2") <= F.col("limit"))
        moments = inside.groupBy("cell").agg(
            F.first("n").alias("n"),
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(_VECTOR)],
            *[
                (F.covar_pop(a, _VECTOR[j]) + F.lit(_FLOORS[a] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}")
                for i, a in enumerate(_VECTOR)
                for j in range(i + 1)
            ],
        )
        now = _cholesky(moments)
    now = saved(now)
    middle = _distances(vectors, now).groupBy("cell").agg(
        F.percentile_approx("d2", F.lit(0.5), F.lit(1000)).alias("middle")
    )
    expected = chi_square(len(_VECTOR), 0.5)
    return now.join(middle, "cell").withColumn(
        "scale", F.greatest(F.col("middle") / F.lit(expected), F.lit(1.0))
    )


def _cholesky(moments: DataFrame) -> DataFrame:
    """Columns c_i_j to l_i_j, column by column; one projection each, so nothing is repeated."""
    d = len(_VECTOR)
    for j in range(d):
        diagonal = F.col(f"c_{j}_{j}") - sum((F.col(f"l_{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        moments = moments.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(diagonal, F.lit(1e-9))))
        moments = moments.withColumns(
            {
                f"l_{i}_{j}": (
                    F.col(f"c_{i}_{j}")
                    - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
                )
                / F.col(f"l_{j}_{j}")
                for i in range(j + 1, d)
            }
        )
    return moments.drop(*[f"c_{i}_{j}" for i in range(d) for j in range(i + 1)])


def _distances(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """`vectors` with the squared distance d2 from their cell's estimate, by forward substitution."""
    rows = vectors.join(estimate, "cell")
    for i, c in enumerate(_VECTOR):
        rest = F.col(c) - F.col(f"m_{i}") - sum((F.col(f"l_{i}_{k}") * F.col(f"y_{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(f"y_{i}") ** 2 for i in range(len(_VECTOR))), F.lit(0.0)))
