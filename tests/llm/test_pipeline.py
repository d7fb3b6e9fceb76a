"""Each stage against a plain version of its rule, on its own input, and the whole run."""

from collections import Counter

import pytest
from test_fm_index import brute as contaminated
from test_jaccard import brute as grouped
from test_tokens import expected_pieces

import corpus_pipeline
from tickloom.llm import pii

SF_DIR = "/root/testdata/sf0.001"


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def test_quality(spark, documents):
    kept = corpus_pipeline.keep_quality(spark, documents, SF_DIR)
    assert kept.columns == documents.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    left = set(ids(kept))
    known = [d for d in ids(documents) if d in labels]
    assert sum((d in left) == (labels[d] == 1) for d in known) > 0.93 * len(known)


def test_one_of_each_group(spark, documents, odd):
    for docs in (documents, odd):
        kept = corpus_pipeline.keep_one_of_each_group(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        groups = {(i, c) for i, _, c in grouped(rows)}
        expected = {i for i, c in groups if i is not None and i == c}
        named = [i for i in ids(kept) if i is not None]
        assert len(named) == len(set(named)) and set(named) == expected
        assert len(ids(kept)) - len(named) == sum(i is None for i, _ in rows)
        assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}


def test_contaminated(spark, documents, benchmark):
    kept = corpus_pipeline.drop_contaminated(spark, documents, SF_DIR)
    assert kept.columns == documents.columns
    rows = documents.collect()
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    found = contaminated([r.text for r in rows], items)
    assert ids(kept) == ids_of(r.doc_id for r, (n, hit, _) in zip(rows, found) if not (hit and 20 * len(hit) >= n))


def ids_of(values):
    return sorted(values, key=str)


def test_personal_data(spark, documents):
    hidden = corpus_pipeline.hide_personal_data(spark, documents, SF_DIR)
    assert hidden.columns == documents.columns
    before = {r.doc_id: r for r in documents.collect()}
    for r in hidden.collect():
        assert not pii.base_spans(r.text)
        assert r.n_chars == len(r.text)
        if not pii.candidates(before[r.doc_id].text) and not pii.base_spans(before[r.doc_id].text):
            assert r == before[r.doc_id]


@pytest.mark.parametrize("which", ["odd", "nothing", "clashing"])
def test_odd_rows(request, spark, which):
    docs = request.getfixturevalue(which)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        names = docs.columns
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == names
    assert corpus_pipeline.pack(spark, docs, SF_DIR).count() >= 0


def test_run(spark, documents):
    packed = corpus_pipeline.run(spark, SF_DIR)
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
    rows = packed.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == expected_pieces(docs, 2048)
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    assert len(fill) <= -(-sum(fill.values()) // 2048) + 2
    assert {r.doc_id for r in rows} < set(ids(documents))
