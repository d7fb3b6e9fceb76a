"""Kneser-Ney models against dictionaries, held-out accuracy, rejection, and odd rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import kneser_ney
from tickloom.llm.common import held_out

WORDS = {"banana": 5, "bandana": 2, "an": 9, "ananas": 1, "nab": 3, "ß": 1, "a": 4}


def plain(counts, order):
    """The same model from its definition, with dictionaries of strings."""
    raw = [Counter() for _ in range(order + 2)]
    for word, n in counts.items():
        marked = f"<{word}>"
        for k in range(1, order + 2):
            for end in range(max(k, 2), len(marked) + 1):
                raw[k][marked[end - k : end]] += n
    adjusted = [None]
    for k in range(1, order + 1):
        before = defaultdict(set)
        for gram in raw[k + 1]:
            before[gram[1:]].add(gram[0])
        adjusted.append({g: n if k == order or g[0] == "<" else len(before[g]) for g, n in raw[k].items()})
    discounts = [None]
    for k in range(1, order + 1):
        n1, n2 = (sum(v == i for v in adjusted[k].values()) for i in (1, 2))
        discounts.append(min(max(n1 / max(n1 + 2 * n2, 1), 0.1), 0.9))

    def probability(gram, alphabet):
        if not gram:
            return 1 / alphabet
        k = len(gram)
        mass = {g: n for g, n in adjusted[k].items() if g[:-1] == gram[:-1]}
        below = probability(gram[1:], alphabet)
        total = sum(mass.values())
        if not total:
            return below
        d = discounts[k]
        left = sum(min(n, d) for n in mass.values())
        return max(mass.get(gram, 0) - d, 0) / total + left / total * below

    def surprise(word, alphabet):
        marked = f"<{word}>"
        return -sum(math.log(probability(marked[max(0, i - order + 1) : i + 1], alphabet)) for i in range(1, len(marked)))

    return surprise


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_equals_dictionaries(order):
    model = kneser_ney.fit(list(WORDS), np.array(list(WORDS.values())), order)
    asked = [*WORDS, "bananas", "nan", "zzz", "b", "anbandana"]
    got = model.surprise(kneser_ney.Characters.of(asked), 30)
    expected = plain(WORDS, order)
    assert np.allclose(got, [expected(w, 30) for w in asked], rtol=1e-9)


def test_probabilities_add_up():
    """The shares of a context's grams and what is left of it are 1."""
    alphabet = sorted(set("".join(WORDS)))
    expected = plain(WORDS, 4)
    model = kneser_ney.fit(list(WORDS), np.array(list(WORDS.values())), 4)
    n = len(alphabet) + 2  # letters, the end, and what was never seen
    for start in ("", "b", "ban", "nad", "ß", "x"):
        asked = [start, *[start + c for c in alphabet], start + "?"]
        got = model.surprise(kneser_ney.Characters.of(asked), n)
        assert np.allclose(got, [expected(w, n) for w in asked])
    for k, level in enumerate(model.levels):
        at = np.searchsorted(level.contexts, _contexts(model, k))
        mass = np.bincount(at, level.share, len(level.contexts)) + level.rest
        assert np.allclose(mass, 1)


def _contexts(model, k):
    """The context of each gram of a level, found again from the words."""
    chars = kneser_ney.Characters.of(list(WORDS))
    grams = chars.grams(k + 1)
    here = np.flatnonzero(chars.offset >= max(k, 1))
    keys, first = np.unique(grams[k + 1][here], return_index=True)
    assert np.array_equal(keys, model.levels[k].grams)
    return grams[k][here[first] - 1] if k else grams[0][here[first]]


def test_words():
    assert kneser_ney.words("Ab1c_d é! ²m² İx") == ["ab", "c", "d", "é", "m", "i", "x"]
    assert kneser_ney.words(None) == kneser_ney.words("²³ 12 __") == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = kneser_ney.languages(docs)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in docs.filter(held_out(F.col("doc_id"), 3, 1)).collect()}
    assert sum(r.lang_pred == r.lang for r in out) >= 0.99 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_other_languages_are_rejected(spark, documents):
    """Texts of languages that were not learnt name the nearest one with a low score."""
    texts = [
        "Всем привет как дела сегодня хорошая погода и мы идём гулять в парк",
        "Minden ember szabadon születik és egyenlő méltósága és joga van " * 3,
        "zqx xqz wvvk kkzt qqqqx zzxxw qwrtp vvbnm xxcvw",
    ]
    known = documents.select("doc_id", "text", "lang")
    foreign = spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(texts)], known.schema)
    rows = {r.doc_id: r for r in kneser_ney.languages(known.unionByName(foreign)).collect()}
    assert all(rows[10**6 + i].rejected and rows[10**6 + i].lang_pred != "und" for i in range(len(texts)))


def test_odd_rows(odd, clashing):
    rows = kneser_ney.languages(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    for i in (1, 2, 3):
        assert (by[i].lang_pred, by[i].score, by[i].rejected, by[i].cross_entropy) == ("und", 0.0, True, None)
    assert all(r.lang_pred in ("en", "de", "fr") for r in rows if r.doc_id in (4, 5, 6, -7, 9_000_000_000))
    assert sum(r.doc_id is None for r in rows) == 2
    again = kneser_ney.languages(clashing).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_nothing_to_learn_from(nothing, documents):
    assert kneser_ney.languages(nothing).collect() == []
    blank = documents.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in kneser_ney.languages(blank).collect()} == {("und", 0.0)}
    one = documents.withColumn("lang", F.lit("xx"))
    assert {r.lang_pred for r in kneser_ney.languages(one).collect()} <= {"xx", "und"}


def test_copies_count_once(spark, documents):
    """A text that very many rows repeat is one text of the sample, and the sample stays bounded."""
    hot = documents.limit(1).select("text", "lang").crossJoin(spark.range(10**6, 10**6 + 3_000)).withColumnRenamed("id", "doc_id")
    docs = documents.select("doc_id", "text", "lang")
    every = F.lit(True)
    a, b = kneser_ney.train(docs, every), kneser_ney.train(docs.unionByName(hot), every)
    assert a.languages == b.languages and np.array_equal(a.weights, b.weights)
    small = kneser_ney.train(docs, every, most=40)
    assert sum(len(m.levels[0].grams) for m in small.models) <= sum(len(m.levels[0].grams) for m in a.models)
