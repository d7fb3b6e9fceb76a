"""Near duplicates against all pairs by the definition, and components against union-find."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickloom.llm import components, jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def roots(nodes, edges):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    edges = []
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i == j or (a and b and 100 * len(a & b) >= 80 * len(a | b)):
                edges.append((i, j))
    root = roots({i for i, _ in sets}, edges)
    return Counter((i, len(shingle_set(t)), None if i is None else root[i]) for i, t in rows)


def check(docs, limit=None):
    found = Counter(tuple(r) for r in jaccard.near_duplicates(docs).collect())
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert found == expected
    return found


def edited(words, chance, share):
    return [("new%d" % chance.randint(0, 9999)) if chance.random() < share else w for w in words]


@pytest.fixture(scope="module")
def planted(spark):
    """Chains, near copies at the limit, and one passage in most documents."""
    chance = random.Random(8)
    passage = ["common%d" % i for i in range(60)]
    rows, n = [], 0
    for group in range(12):
        words = ["w%d" % chance.randint(0, 5000) for _ in range(chance.choice([6, 20, 120, 300]))]
        for _ in range(chance.randint(1, 9)):
            words = edited(words, chance, chance.choice([0, 0.01, 0.02, 0.04]))
            text = " ".join(words + (passage if chance.random() < 0.7 else []))
            rows.append((n, text.upper() if chance.random() < 0.2 else text))
            n += 1
    base = ["t%d" % i for i in range(100)]
    rows += [(n + i, " ".join(edited(base, chance, 0.012))) for i in range(60)]
    rows += [(1000 + i, " ".join(passage[:40] + edited(base[:30], chance, 0.5))) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_planted(planted):
    found = check(planted)
    assert len({c for _, _, c in found}) < 0.7 * len(found)


def test_documents(documents):
    check(documents)


def test_odd_rows(odd, clashing):
    check(odd)
    check(clashing)


def test_one_id_for_two_texts(spark):
    texts = ["one two three four five six", "seven eight nine ten eleven twelve", "one two three four five six"]
    check(spark.createDataFrame(list(zip([5, 5, 3], texts)), "doc_id long, text string"))


@pytest.mark.parametrize("split", [False, True])
def test_repeated_rows_are_one_row_of_the_matrix(spark, split):
    """One (doc_id, text) held by most rows, its near copies, and one doc_id with many texts."""
    if split:  # as a hot key is at full size
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.0")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    words = ["w%d" % i for i in range(120)]
    near = [" ".join([*words, "end%d" % i]) for i in range(3)]
    rows = [(7, near[0])] * 900 + [(8, near[1]), (9, near[2])]
    rows += [(50, " ".join([*words[: 60 + i], *["x%d_%d" % (i, j) for j in range(60)]])) for i in range(40)]
    rows += [(100 + i, "other text number %d of these" % i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    named = jaccard.incidence(docs, 5, 80)
    one = named.groupBy("k").agg(F.min(F.struct("doc_id", "t")).alias("holder"))
    made = [r.k for r in jaccard.incidence_rows(docs, one, named.select("k").distinct(), 5).collect()]
    assert Counter(made) == Counter({r.k for r in named.collect()})
    found = Counter(tuple(r) for r in jaccard.near_duplicates(docs).collect())
    assert found[7, 117, 7] == 900 and found[8, 117, 7] == found[9, 117, 7] == 1
    assert len({c for i, _, c in found if i == 50}) == 1


def test_nothing(nothing):
    assert jaccard.near_duplicates(nothing).count() == 0


def test_overlaps_at_the_limit():
    import numpy as np

    chance = np.random.default_rng(2)
    for _ in range(300):
        whole = chance.integers(-(2**63), 2**63 - 1, 45)
        x, y = np.unique(whole[: chance.integers(30, 45)]), np.unique(whole[chance.integers(0, 9) :])
        a, b = set(x.tolist()), set(y.tolist())
        assert jaccard.overlaps(x, y, 80, 8) == (100 * len(a & b) >= 80 * len(a | b))


def test_components(spark):
    chance = random.Random(3)
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(200, i) for i in range(201, 260)]
    any_ = [(chance.randint(300, 400), chance.randint(300, 400)) for _ in range(60)]
    edges = path + star + any_
    frame = spark.createDataFrame([(b, a) for a, b in edges], "a long, b long")
    found = {r.node: r.root for r in components.components(frame).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == roots(nodes, [e for e in edges if e[0] != e[1]])
    assert components.components(frame.limit(0)).count() == 0


def test_bitmaps_bound_what_two_rows_share(spark):
    """Never more bits apart than shingles, whatever the lengths; and enough of them to tell long rows apart."""
    import numpy as np

    chance = np.random.default_rng(5)
    rows = []
    for n in (1, 5, 300, 900, 1100, 2000, 2100, 5000, 70_000):
        x = np.unique(chance.integers(-(2**63), 2**63 - 1, n))
        y = np.unique(np.concatenate([x[: int(n * chance.choice([0, 0.5, 0.9, 1]))], chance.integers(-(2**63), 2**63 - 1, n // 5 + 1)]))
        rows += [(a.tolist(), b.tolist(), jaccard.bits(a).tolist(), jaccard.bits(b).tolist()) for a, b in ((x, y), (y, x))]
    frame = spark.createDataFrame([(len(set(a) - set(b)), len(a), p, q) for a, b, p, q in rows], "less int, n int, p array<long>, q array<long>")
    for r in frame.select("less", "n", jaccard._apart(F.col("p"), F.col("q")).alias("bits")).collect():
        assert r.bits <= r.less
        assert r.n > 70_000 or r.less < r.n or r.bits > 0.2 * r.n


def test_bitmaps_keep_every_link_of_a_product():
    chance = random.Random(31)
    for two_sides in (False, True):
        rows, sets = [], []
        for k in range(60):
            base = random.Random(k % 15)
            n = base.choice([3, 40, 900, 1020, 1150])  # bitmaps of 16 words and of 32
            values = [base.randint(-(1 << 62), 1 << 62) for _ in range(n)]
            row = sorted({v if chance.random() < 0.95 else chance.randint(-(1 << 62), 1 << 62) for v in values})
            side = k % 2 if two_sides else 0
            rows.append((side, k, k // 2, len(row), jaccard.bits(jaccard.np.array(row))))
            sets.append((side, k // 2, set(row)))
        linked = {
            k
            for k, (side, root, x) in enumerate(sets)
            for other, root_y, y in sets
            if root != root_y and side != (other if two_sides else 1) and 100 * len(x & y) >= 80 * len(x | y)
        }
        left = {r[1] for r in jaccard.in_reach(rows, 80)}
        assert linked and linked <= left


def test_rows_that_no_pair_needs_are_not_moved(spark, monkeypatch):
    """Unlike texts share a passage, so that they meet in blocks; their bitmaps go there, their rows do not."""
    chance = random.Random(7)
    passage = ["same%d" % i for i in range(40)]
    texts = [" ".join(passage + ["x%d" % chance.randint(0, 10**9) for _ in range(60)]) for _ in range(28)]
    copy = ["y%d" % i for i in range(100)]
    texts += [" ".join(copy[:i] + ["z"] + copy[i:]) for i in (50, 60)]
    moved = []
    multiplied = jaccard.multiplied

    def counted(matrix, members, percent):
        moved.append(members.count())
        return multiplied(matrix, members, percent)

    monkeypatch.setattr(jaccard, "multiplied", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = check(docs)
    assert sum(moved) <= 6 and len({root for _, _, root in found}) == 29
