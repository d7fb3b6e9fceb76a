"""The base score by its definition, the forward recursion over all paths, and training."""

import itertools
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from tickloom.llm import hmm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = object()


def tokens(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), END]


def held(doc_id):
    return crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def check(docs, **settings):
    rows = hmm.language_model_scores(docs, **settings).collect()
    texts = docs.select("doc_id", "text").collect()
    counts = Counter(t for r in texts if not held(r.doc_id) for t in tokens(r.text))
    n, v = sum(counts.values()), len(counts)

    def base(text):
        found = tokens(text)
        known = sum(counts[t] > 0 for t in found)
        return len(found), known, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in found)

    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in rows), key=str)
    expected = sorted(((r.doc_id, held(r.doc_id), *base(r.text)) for r in texts), key=str)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4] for g in got], [e[4] for e in expected])
    assert {r.train_tokens for r in rows} <= {n}
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in rows)
    return rows


@pytest.mark.parametrize("settings", [{}, {"own_symbols": 50, "states": 3, "rounds": 2}])
def test_documents(documents, settings):
    rows = check(documents, **settings)
    out = [r for r in rows if r.held_out]
    # Per token the model predicts texts it has not seen better than single words do.
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * 1.02


def test_odd_rows(odd, clashing):
    check(odd, own_symbols=5, states=2, rounds=1)
    check(clashing, states=2, rounds=1)
    check(odd.filter("doc_id in (4)"), states=2, rounds=1)


def test_nothing(nothing):
    assert hmm.language_model_scores(nothing).count() == 0


def test_only_held_out(odd):
    rows = [r.doc_id for r in odd.collect() if held(r.doc_id)]
    check(odd.filter(odd.doc_id.isin(rows)), states=2, rounds=1)


def model(states=3, symbols=4, seed=1):
    chance = np.random.default_rng(seed)
    return hmm._normal(chance.random((2, states)), chance.random((states, states)), chance.random((symbols, states)))


def paths(m, text, start=0):
    for path in itertools.product(range(len(m.move)), repeat=len(text)):
        p = m.start[start, path[0]] * m.emit[text[0], path[0]]
        for a, b, x in zip(path, path[1:], text[1:]):
            p *= m.move[a, b] * m.emit[x, b]
        yield path, p


def test_likelihood_sums_over_paths():
    m = model()
    texts = [np.array(t) for t in ([0], [1, 2], [3, 3, 0, 1, 2], [2] * 6, [0, 1])]
    expected = [math.log10(sum(p for _, p in paths(m, t))) for t in texts]
    assert np.allclose(m.log10_likelihood(texts), expected)
    assert len(m.log10_likelihood([])) == 0


def test_expected_counts():
    m = model(2, 3)
    texts = [[0, 1, 2, 2], [2, 0, 1], [1]]
    first = np.array([True, False, True])
    padded = np.zeros((3, 4), int)
    for row, t in enumerate(texts):
        padded[row, : len(t)] = t
    starts, moves, emitted = m.expected(padded, np.array([4, 3, 1]), first)
    own = [np.zeros((2, 2)), np.zeros((2, 2)), np.zeros((3, 2))]
    for text, begins in zip(texts, first):
        kind = 0 if begins else 1
        total = sum(p for _, p in paths(m, text, kind))
        for path, p in paths(m, text, kind):
            own[0][kind, path[0]] += p / total
            for a, b in zip(path, path[1:]):
                own[1][a, b] += p / total
            for x, s in zip(text, path):
                own[2][x, s] += p / total
    for got, expected in zip((starts, moves, emitted), own):
        assert np.allclose(got, expected)
