"""Base spans against the contract's patterns, and what the trees add."""

import random
import re
import time
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from tickloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    if kind == "phone":
        return 8 <= len(digits) <= 15
    return True


def brute(text):
    return [
        (kind, *m.span())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    ]


def test_base_spans():
    chance = random.Random(2)
    texts = ["".join(chance.choices("0123456789" * k + "@.+- ()ab%é", k=chance.randint(0, 60))) for k in (1, 1, 3) for _ in range(6000)]
    texts += ["4111 1111 1111 1111", "x4111-1111-1111-1111-", "+1 (555) 555-1234.", "1.2.3.4.5.6.7.8", "001.002.003.255", "a@b.c@d.e", "@a.b", "a@b", "256.1.1.1"]
    for text in texts:
        assert pii.base_spans(text) == brute(text), text


def check(docs):
    rows = pii.find_personal_data(docs).collect()
    expected = Counter()
    for r in docs.select("doc_id", "text").collect():
        base = brute(r.text)
        counts = Counter(k for k, _, _ in base)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        expected[r.doc_id, *(counts[k] for k in PATTERNS), sha256(listed.encode()).hexdigest(), listed] += 1
    got = Counter()
    for r in rows:
        spans = [(x.kind, x.start, x.end) for x in r.found]
        assert r.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        text = next(k for k in expected if k[0] == r.doc_id and k[5] == r.base_sha256)[6]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))
        got[r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, text] += 1
    assert got == expected
    return rows


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = check(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    added = [(r.doc_id, x) for r in rows for x in r.found if x.kind == "secret"]
    hidden = [d for d, t in texts.items() if re.search(r'token = "[0-9a-f]{40}"', t)]
    assert {d for d, _ in added} >= set(hidden)
    assert all(len(texts[d][x.start : x.end]) >= 16 for d, x in added)
    # Texts without digits or @ are left alone.
    assert not any(r.spans for r in rows if not re.search("[0-9@]", texts[r.doc_id]))


def test_odd_rows(odd, clashing, nothing):
    check(odd)
    check(clashing)
    assert pii.find_personal_data(nothing).count() == 0


def test_trees_learn_a_rule_of_two_features():
    chance = np.random.default_rng(4)
    x = chance.random((2000, 5))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = pii.fit_trees(x[:1500], y[:1500])
    model.scale = pii._platt(model.raw(x[:1500]), y[:1500])
    assert np.mean((model.probability(x[1500:]) > 0.5) == y[1500:]) > 0.95


@pytest.mark.parametrize("text", ["", "a@b.co x", "1.2.3.4 a@b.co"])
def test_redaction(text):
    spans = pii.base_spans(text)
    hidden = pii.redact_text(text, spans)
    assert not pii.base_spans(hidden)
    assert hidden.count("[") == len(spans)


def test_overlapping_spans_are_one():
    text = "+1 555 555 1234 5678 9012 x"
    assert pii.redact_text(text, [("card", 1, 20), ("phone", 0, 15)]) == "[PHONE] 9012 x"


def test_copies_of_a_text_are_drawn_once(spark, monkeypatch):
    rows = [("token = '%040x' and 12.%d" % (7 * i, i), 1) for i in range(40)] + [("call 1.2.3.4 or a@b.co 17 171 555 1234", 3000)]
    docs = spark.createDataFrame([(i, t) for t, n in rows for i in range(n)], "doc_id long, text string").repartition(6)
    sizes, whole = [], pii.fit_trees

    def fit(x, y):
        sizes.append(len(x))
        return whole(x, y)

    monkeypatch.setattr(pii, "fit_trees", fit)
    pii.train(docs)
    assert 0 < sizes[0] < 41 * 8


@pytest.mark.parametrize("value", ["q" * 60 + "7" + "x" * 9, "4" * 60 + "z" * 9, "_" * 50 + "a1" * 9])
def test_long_secrets_are_candidates(value):
    text = f"token = {value} end"
    found = [text[c.start : c.end] for c in pii.candidates(text) if c.kind == "secret"]
    assert found == [value]
    assert not [c for c in pii.candidates("4 " + "q" * 90) if c.kind == "secret"]


@pytest.mark.parametrize(
    "text",
    [
        "a1b2c3d4" * 125_000,
        "".join(f"user{i}@example{i}.org " for i in range(50_000)),
        "1" * 300_000,
        "a.b-1" * 100_000 + "@",
        "+1 " + "(" * 500_000 + " 9" + "0.0.0." * 100_000,
    ],
    ids=["word", "addresses", "digits", "local part", "marks"],
)
def test_work_grows_with_the_text_only(text):
    """A megabyte of any kind takes seconds, whatever the generators propose in it."""
    trees = pii.Trees([np.array([0.5])] * pii.FEATURES, [([(0, 0), (0, 0), (0, 0)], np.full(8, 3.0))])
    selector = pii.Selector(trees, {kind: 0.5 for kind in pii.KINDS})
    start = time.process_time()
    spans = selector.spans(text)
    assert time.process_time() - start < 5
    assert [s for s in spans if s[0] != "secret"] or "@" not in text[:100]


def test_taken_places():
    chance = random.Random(6)
    for _ in range(200):
        base = [(a, a + chance.randint(1, 6)) for a in chance.sample(range(60), 5)]
        taken, plain = pii._Taken(base), list(base)
        for _ in range(20):
            a = chance.randint(0, 60)
            b = a + chance.randint(1, 5)
            free = all(y <= a or b <= x for x, y in plain)
            assert taken.free(a, b) == free
            if free:
                taken.add(a, b)
                plain.append((a, b))


@pytest.mark.parametrize(
    "kind, span, before, label",
    [
        ("phone", "0171 555 1234", "please call ", True),
        ("phone", "0171 555 1234", "lot number ", None),
        ("phone", "10.0.0.12", "see ", False),
        ("card", "371449635398431", "my card: ", True),
        ("card", "371449635398431", "item ", None),
        ("card", "371449635398432", "my card: ", False),
        ("email", "@nobody", "", False),
        ("email", "näme@exämple.org", "", None),
    ],
)
def test_labels_by_context(kind, span, before, label):
    assert pii._weak(kind, span, before) is label


def test_phones_and_cards_by_context_are_learnt(spark):
    """Numbers announced by words teach the trees, which then find those beside other words as well."""
    chance = random.Random(8)

    def number(n):
        return "".join(chance.choices("0123456789", k=n))

    rows = []
    for i in range(600):
        phone = f"0{number(3)} {number(3)} {number(4)}"
        rows.append((i, f"some words here and phone {phone} then words {number(18)} and words"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find_personal_data(docs).collect()
    assert sum(any(x.kind == "phone" for x in r.found) for r in found) > 500
    assert all(r.n_spans == len(r.found) and r.n_phone == 0 for r in found)


def _numbered(n):
    """Texts with candidates of several kinds, some of them wrong ones."""
    chance = random.Random(5)
    lines = ["token = '%040x' and 12.%d", "call 0%010d or 10.0.0.%d", "user%d@example.org %d.300.1.2", "%016d or no%d@body"]
    return [(i, " ".join(chance.choice(lines) % (chance.randrange(10**9), i) for _ in range(12))) for i in range(n)]


def test_all_distinct_texts_train(spark, monkeypatch):
    """No bound on texts, nor on the candidates of one: what is fitted has half of them, and the other half calibrates."""
    rows = _numbered(400)
    known = [[c for c in pii.candidates(t) if c.weak is not None] for _, t in rows]
    assert max(map(len, known)) > 8
    sizes, whole = [], pii.fit_trees
    counts, platt = [], pii._platt

    def fit(x, y):
        sizes.append(len(x))
        return whole(x, y, trees=2)

    def calibrate(raw, y, n):
        counts.append(int(n.sum()))
        return platt(raw, y, n)

    monkeypatch.setattr(pii, "fit_trees", fit)
    monkeypatch.setattr(pii, "_platt", calibrate)
    pii.train(spark.createDataFrame(rows + rows[:100], "doc_id long, text string"))
    assert sizes[0] + counts[0] == sum(map(len, known))


def test_spread_candidates_give_the_same_trees(spark, monkeypatch):
    """Whether sums are made by tasks or in memory, and however rows are parted, the selector is the same."""
    whole = pii.fit_trees
    monkeypatch.setattr(pii, "fit_trees", lambda x, y: whole(x, y, trees=4))
    docs = spark.createDataFrame(_numbered(300), "doc_id long, text string")
    a = pii.train(docs.coalesce(1))
    b = pii.train(docs.repartition(5), held=0)
    assert a.thresholds and a.thresholds == b.thresholds
    assert a.trees.scale == b.trees.scale
    for (splits, leaves), (others, same) in zip(a.trees.trees, b.trees.trees, strict=True):
        assert splits == others and (leaves == same).all()
