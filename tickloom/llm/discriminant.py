"""Quality classifier: regularised quadratic discriminant on statistics of a text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_and_text, one_label

_KEEP_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128))
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
# Characters counted as symbols, and as marks of a sentence.
_SYMBOLS, _MARKS = b"#*$%&|<>=_~^\\", b".,;:!?'\"()-"
_WIDE_CAPITAL = re.compile("[À-ÖØ-Þ]")
STATISTICS = 12


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text; of an empty one all zero."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    raw = text.encode()
    size = len(raw)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = len(raw.translate(None, _KEEP_LETTERS))
    capitals = size - len(raw.translate(None, _CAPITALS)) + len(_WIDE_CAPITAL.findall(text))

    def per_cent(part: float, whole: float) -> float:
        return np.log1p(100 * part / max(whole, 1))

    return [
        np.log1p(n),
        np.log1p(sum(map(len, words)) / n),
        per_cent(n - len(set(words)), n) * min(1.0, 20 / n**0.5),
        per_cent(n - 1 - len(set(zip(words, words[1:]))), n - 1),
        per_cent(sum(map(eq, words, words[1:])), n - 1),
        per_cent(size - len(raw.translate(None, _SYMBOLS)), n),
        per_cent(size - len(raw.translate(None, _MARKS)), n),
        per_cent(text.count("!"), n),
        per_cent(capitals, letters),
        per_cent(size - len(raw.translate(None, _DIGITS)), n),
        per_cent(len(lines) - len(set(lines)), len(lines)),
        np.log1p(n / len(lines)),
    ]


@dataclass
class Discriminant:
    """Two normal densities and their log prior odds; None where a class was never seen."""

    means: np.ndarray | None
    factors: np.ndarray | None  # inverses of the Cholesky factors, kept for scoring
    log_dets: np.ndarray | None
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row, from the difference of log densities."""
        odds = np.full(len(x), self.log_odds)
        if self.means is not None:
            sign = (-1, 1)
            for c in (0, 1):
                y = (x - self.means[c]) @ self.factors[c].T
                odds += sign[c] * -0.5 * ((y * y).sum(axis=1) + self.log_dets[c])
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    rows: Column | None = None,
    most: int = 50_000,
    to_pooled: float = 0.1,
    to_sphere: float = 0.01,
) -> Discriminant:
    """Fit on labelled documents; `rows` restricts which, as a condition on doc_id.

    `labels` is (doc_id, label) with one label a document, as from `one_label`.
    At most about `most` of them are used, chosen by a hash of doc_id: this
    bounds the labels that are broadcast. Their moments per class are added up
    by Spark, and only these reach the driver. A class covariance is drawn by
    `to_pooled` towards the pooled one, then by `to_sphere` towards a multiple
    of the unit matrix, so it can be inverted whatever the sample.
    """
    if rows is not None:
        labels = labels.filter(rows)
    share = most / max(labels.count(), 1)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    chosen = id_and_text(docs).join(F.broadcast(labels.filter(draw)), "doc_id")

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for label, own in batch.groupby("label"):
                x = np.array([statistics(t) for t in own["text"]])
                values = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                yield pd.DataFrame({"label": label, "place": np.arange(len(values)), "value": values})

    added = (
        chosen.mapInPandas(moments, "label double, place int, value double")
        .groupBy("label", "place")
        .agg(F.sum("value").alias("value"))
    )
    d = STATISTICS
    sums = np.zeros((2, 1 + d + d * d))
    for r in added.collect():  # two classes, a number for each place
        sums[int(r.label), r.place] = r.value
    n = sums[:, 0]
    if not n.all():
        certain = {(False, False): 0.0, (True, False): -20.0, (False, True): 20.0}
        return Discriminant(None, None, None, certain[bool(n[0]), bool(n[1])])
    means = sums[:, 1 : 1 + d] / n[:, None]
    spreads = sums[:, 1 + d :].reshape(2, d, d) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (spreads * n[:, None, None]).sum(axis=0) / n.sum()
    factors, log_dets = [], []
    for spread in spreads:
        spread = (1 - to_pooled) * spread + to_pooled * pooled
        spread = (1 - to_sphere) * spread + to_sphere * max(np.trace(spread) / d, 1e-3) * np.eye(d)
        low = np.linalg.cholesky(spread)
        factors.append(np.linalg.inv(low))
        log_dets.append(2 * np.log(np.diag(low)).sum())
    return Discriminant(means, np.array(factors), np.array(log_dets), float(np.log(n[1] / n[0])))


def score(text: Column, model: Discriminant) -> Column:
    """The model's probability of label 1 for a text, row by row."""

    def scored(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts]).reshape(-1, STATISTICS)
        return pd.Series(model.score(x))

    return F.pandas_udf(scored, "double")(text)


def quality(docs: DataFrame, labels: DataFrame, parts: int = 3, left_out: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`.

    Labels are learnt from documents that are not held out: crc32 of doc_id as
    text, modulo `parts`, is `left_out` for those that are. A NULL id counts as
    empty text there, NULL texts score as empty ones, repeated rows score alike.
    Without any label every score is 0.5.
    """
    known = one_label(labels, "quality")
    model = train(docs, known, ~held_out(F.col("doc_id"), parts, left_out))
    scored = id_and_text(docs).select(
        "doc_id", held_out(F.col("doc_id"), parts, left_out).alias("held_out"), score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
