"""Counts against their definitions, and the robust distances against numpy."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import outliers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {
        i + k for i in range(len(words) - 4) for k in range(5) if windows[tuple(words[i : i + 5])] > 1
    }
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
        n < 10 or 100 * len(repeated) > 20 * n,
    )


def check(docs):
    rows = outliers.quality_rules(docs).collect()
    expected = Counter((r.doc_id, *counts(r.text)) for r in docs.select("doc_id", "text").collect())
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in rows) == expected
    assert not any(r.kept and r.base_failed for r in rows)
    return rows


def test_documents(documents):
    rows = check(documents)
    assert sum(r.kept for r in rows) > 0.5 * len(rows)


def test_odd_rows(odd, clashing, spark):
    check(odd)
    check(clashing)
    chance = random.Random(4)
    texts = [(i, "".join(chance.choices("ab \n\t\x0b|#é", k=chance.randint(0, 120)))) for i in range(60)]
    texts += [(100, "a b c d e " * 3), (101, "a a a a a a"), (102, "a b c d e f a b c d e"), (103, "\x85 \xa0x")]
    check(spark.createDataFrame(texts, "doc_id long, text string").withColumns({"lang": F.lit("x"), "source": F.lit("y")}))


def test_nothing(nothing):
    assert outliers.quality_rules(nothing).count() == 0


@pytest.fixture(scope="module")
def cells(spark):
    """Normal vectors in two cells, a fifth of one replaced by a far cloud."""
    chance = np.random.default_rng(2)
    d = len(outliers._VECTOR)
    rows = []
    for cell, n in (("a", 1000), ("b", 400)):
        mix = chance.normal(size=(d, d))
        x = chance.normal(size=(n, d)) @ mix + chance.normal(size=d)
        far = np.zeros(n, bool)
        if cell == "a":
            far[:200] = True
            x[far] += 40
        rows += [(cell, bool(f), *map(float, v)) for f, v in zip(far, x)]
    return spark.createDataFrame(rows, "cell string, far boolean, " + ", ".join(f"{c} double" for c in outliers._VECTOR))


def test_robust_estimate(cells):
    estimate = outliers._estimate(cells.drop("far"), 0.75, 3, 100)
    found = outliers._distances(cells, estimate).toPandas()
    distance = found["d2"] / found["scale"]
    limit = outliers.chi_square(len(outliers._VECTOR), 1 - 1e-7)
    assert (distance[found["far"]] > limit).all()
    assert (distance[~found["far"]] <= limit).all()
    # The distance is Mahalanobis': the factors are those of the covariance.
    one = estimate.filter("cell = 'b'").first()
    d = len(outliers._VECTOR)
    low = np.array([[one[f"l_{i}_{j}"] if j <= i else 0 for j in range(d)] for i in range(d)])
    mean = np.array([one[f"m_{i}"] for i in range(d)])
    own = found[found["cell"] == "b"]
    x = own[list(outliers._VECTOR)].to_numpy() - mean
    plain = (x @ np.linalg.inv(low @ low.T) * x).sum(axis=1)
    assert np.allclose(plain, own["d2"])


def test_determinant_never_grows(cells):
    dets = []
    for steps in (1, 2, 3):
        one = outliers._estimate(cells.drop("far").filter("cell = 'b'"), 0.75, steps, 100).first()
        dets.append(np.prod([one[f"l_{i}_{i}"] for i in range(len(outliers._VECTOR))]))
    assert dets[2] <= dets[1] * 1.02 and dets[1] <= dets[0] * 1.02


def test_chi_square():
    for d, p, value in ((7, 0.5, 6.3458), (7, 0.99, 18.4753), (3, 0.95, 7.8147)):
        assert abs(outliers.chi_square(d, p) / value - 1) < 0.01
