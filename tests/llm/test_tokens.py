"""Token ids against the library, packing against its rules, and files against a round trip."""

import inspect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tickloom.llm import packing, token_files, tokens
from tickloom.llm.tokens import Encoder

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))

# Texts at the limits of the rule by which texts are cut.
EDGES = [
    "", " ", "a  b", " a", "a ", "a\n\nb", "\na", "x\t y", "<|endoftext|> hi", "foo<|endoftext|>bar",
    "<|startoftext|> Ab", "it's we'LL don't", "ΑΣ ΟΔΟΣ.", "İstanbul I", "é ́x", "a\x1cb c",
    "a b c　d", "数字 123 4½ ² x²", "!?.. a.b,c ,d .e", "A.\nB.,\nC", "Ⅷ ① foo", "🙂🙂 ok",
    "foo.\n bar", "foo \nbar", "a'sb 'S 's", "le*** antre$$$ ai%%%\nOui!! É,",
]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_equal_the_library(path):
    chance = random.Random(1)
    texts = EDGES + ["".join(chance.choices("ab cé .,\n'sßÀ1²\t!İΣ", k=n % 30)) for n in range(3000)]
    whole, encoder = Tokenizer.from_file(path), Encoder(path, remember=500)
    for text in texts * 2:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode(text) == ids, text


MORE_EDGES = [
    "×a ÷b a×b é÷", "a\x00b c\x00", "abc123 4x, x4", "\x85 a", " 1 x", "a1b22 3.c", "\n", "Ā ÿ À\nÖ", "x" * 500 + " y",
    "<|endoftext|>", "a <|endoftext|>", "a\u2028b c", "naïve café's 12:30", "a\n<b>\nc 'd",
]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_of_many_texts_equal_the_library(path, monkeypatch):
    """Many texts at once, also where few are cut or remembered at a time, and of a slice of a column."""
    chance = random.Random(2)
    texts = EDGES + MORE_EDGES
    texts += ["".join(chance.choices("ab cé .,\n'sßÀ1²\t!İΣ×3\x00<|\xa0", k=n % 30)) for n in range(2000)]
    texts += [" ".join("".join(chance.choices("abcé.1,\n!", k=1 + n % 7)) for _ in range(n % 12)) for n in range(2000)]
    whole = Tokenizer.from_file(path)
    expected = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for at_once in (4_000_000, 700):
        monkeypatch.setattr(tokens, "_AT_ONCE", at_once)
        encoder = Encoder(path, remember=200)
        for column in (pa.array(texts), pa.array(["zz", *texts, "", "q"]).slice(1, len(texts))):
            found = list(encoder.encode_all(column))
            assert [t for t, a, b in zip(texts, found, expected) if a != b] == [] and len(found) == len(texts)
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []
    assert list(encoder.encode_all(pa.array(["", ""]))) == [b"", b""]


def test_each_run_goes_to_the_library_once_and_with_others():
    """Few calls of the library's model, however many different words there are."""
    chance = random.Random(4)
    words = ["".join(chance.choices("etaoinshrdlu", k=9)) for _ in range(3000)]
    texts = [" ".join(chance.choices(words, k=200)) + "." for _ in range(60)]
    encoder, calls = Encoder(BYTES), []
    model = encoder.model.tokenize

    class Counted:
        def tokenize(self, text):
            calls.append(text)
            return model(text)

    encoder.model = Counted()
    encoder.plain.tokenize = encoder.first.tokenize = encoder.later.tokenize = encoder.model.tokenize
    encoder.runs.tokenize = encoder.model.tokenize
    found = list(encoder.encode_all(pa.array(texts)))
    runs = {w if k == 0 else " " + w for t in texts for k, w in enumerate(t[:-1].split(" "))} | {"."}
    assert sum(c.count(encoder.names[0]) for c in calls) == len(runs) and len(calls) <= len(runs) / 100
    whole = Tokenizer.from_file(BYTES)
    assert found == [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    list(encoder.encode_all(pa.array(texts)))
    assert len(calls) <= len(runs) / 100


def test_what_is_remembered_is_bounded():
    """Neither a long text nor ever new words stay in memory."""
    chance = random.Random(5)
    encoder = Encoder(BYTES, remember=300)
    for _ in range(40):
        texts = [" ".join("".join(chance.choices("etaoin", k=8)) for _ in range(100)) for _ in range(3)]
        list(encoder.encode_all(pa.array([*texts, "x  " * 9000])))
    kept = [encoder.runs.now, encoder.runs.before]
    assert 0 < sum(len(k.numbers) for k in kept) < 2000 and max(len(run) for k in kept for run in k.numbers) <= 64
    assert sum(len(k.ids) for k in kept) < 20_000


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def expected_pieces(docs, capacity):
    whole = Tokenizer.from_file(WORDS)
    found = []
    for doc in docs.collect():
        ids = whole.encode(doc.text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            found.append((doc.doc_id, k, at, len(part), crc(part)))
    return sorted(found, key=str)


@pytest.mark.parametrize("which, block", [("documents", 32_768), ("documents", 100), ("odd", 32_768)])
def test_packing(request, which, block):
    docs = request.getfixturevalue(which)
    rows = packing.pack(docs, WORDS, block=block).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == expected_pieces(docs, 2048)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r.length for r in rows) // 2048)
    blocks = max(1, -(-len(rows) // block))
    assert len(sequences) <= least + 2 * blocks


def test_sum_of_squares_takes_the_smallest_sum():
    chance = np.random.default_rng(3)
    lengths = chance.integers(1, 30, 400)
    sequence, offset = packing.sum_of_squares(lengths, 30)
    gaps = {}
    for size, at, begin in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        def total(gap):
            after = list(gaps.values())
            after.remove(gap)
            after += [gap - size]
            return sum(after.count(g) ** 2 for g in set(after) if g)
        fitting = {g for g in gaps.values() if g >= size}
        if fitting:
            assert 30 - begin == gaps[at]
            assert total(gaps[at]) == min(map(total, fitting))
        else:
            assert begin == 0 and at not in gaps
        gaps[at] = 30 - begin - size


def test_rows_repeated_are_dealt_over_blocks(spark, documents, monkeypatch):
    """A third of all rows alike in doc_id and text: no block has more than its share."""
    n, block = documents.count(), 100
    same = documents.limit(1).crossJoin(spark.range(2 * n)).drop("id")
    rows = packing.pack(documents.unionByName(same), WORDS, block=block).collect()
    blocks = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) >= 3 * n and max(blocks.values()) <= 2 * block
    assert max(blocks.values()) <= 4 * sorted(blocks.values())[len(blocks) // 2]


def test_files_of_rows_repeated(spark, documents, tmp_path):
    """Rows that share a doc_id are parted between tasks, and are all read back."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    n = documents.count()
    same = documents.filter("doc_id = 3").crossJoin(spark.range(2 * n)).drop("id")
    docs = documents.unionByName(same).repartition(4)
    path = str(tmp_path / "files")
    token_files.write_tokens(docs, BYTES, path, shard_tokens=1000)
    found = token_files.read_tokens(spark, path).collect()
    buckets = Counter(r.bucket for r in spark.read.parquet(path).select("bucket").collect())
    assert len(found) == 3 * n and sum(r.doc_id == 3 for r in found) == 2 * n + 1
    assert len({r.start for r in found}) == len(found) and len(buckets) > 2
    ordered = sorted(found, key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start and a.doc_id <= b.doc_id for a, b in zip(ordered, ordered[1:]))


def test_packing_nothing(nothing):
    assert packing.pack(nothing, WORDS).count() == 0


@pytest.mark.parametrize("which, shard", [("documents", 50_000), ("odd", 1_000), ("clashing", 10**6)])
def test_files(spark, request, tmp_path, which, shard):
    docs = request.getfixturevalue(which)
    path = str(tmp_path / "files")
    token_files.write_tokens(docs, BYTES, path, shard_tokens=shard)
    rows = token_files.read_tokens(spark, path).collect()
    whole = Tokenizer.from_file(BYTES)
    expected = defaultdict(list)
    for doc in docs.collect():
        ids = whole.encode(doc.text or "", add_special_tokens=False).ids + [0]
        expected[doc.doc_id].append((len(ids), crc(ids)))
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_files_of_nothing(spark, nothing, tmp_path):
    token_files.write_tokens(nothing, BYTES, str(tmp_path / "files"))
    assert token_files.read_tokens(spark, str(tmp_path / "files")).count() == 0


def test_files_are_smaller_and_read_at_random(spark, documents, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_tokens(documents, BYTES, path)
    for shard in spark.read.parquet(path).collect():
        ids = token_files.token_range(shard, 0, shard.n_tokens)
        assert len(ids) == shard.n_tokens
        assert len(shard.symbols) + len(shard.left) * 2 < 4 * shard.n_tokens
        for a, b in ((0, 1), (5, 5), (17, 900), (shard.n_tokens - 3, shard.n_tokens)):
            assert (token_files.token_range(shard, a, b) == ids[a:b]).all()


def test_re_pair_round_trip():
    chance = np.random.default_rng(5)
    for n, kinds in ((1, 2), (2, 1), (500, 1), (3000, 2), (5000, 40)):
        ids = chance.integers(0, kinds, n).astype(np.uint32)
        ends = chance.random(n) < 0.01
        ends[-1] = True
        symbols, left, right, lengths = token_files.re_pair(ids, ends, 6)
        rules = token_files._Rules(left, right, lengths)
        assert (rules.expand(symbols) == ids).all()
        sizes = rules.lengths(symbols)
        assert sizes.sum() == n
        # No rule spans two documents.
        assert set(np.cumsum(sizes) - 1) >= set(np.flatnonzero(ends))
        assert n < 1000 or len(symbols) < n


def test_re_pair_leaves_no_frequent_pair():
    """A passage of 100 ids in 300 documents is one symbol in the end, as the production value has it."""
    chance = np.random.default_rng(6)
    passage = chance.integers(0, 5000, 100)
    parts = [np.concatenate([chance.integers(0, 5000, 20), passage, [0]]) for _ in range(300)]
    ids = np.concatenate(parts).astype(np.uint32)
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum([len(p) for p in parts]) - 1] = True
    row = token_files._shard(0, 0, list(range(300)), [p.astype("<u4").tobytes() for p in parts], production_rounds())
    symbols, rules = token_files._symbols(row.iloc[0])
    assert (rules.expand(symbols) == ids).all()
    assert rules.sizes.max() >= 100
    last = np.isin(np.cumsum(rules.lengths(symbols)) - 1, np.flatnonzero(ends))
    pairs = (symbols[:-1].astype(np.int64) << 32 | symbols[1:])[~last[:-1]]
    assert np.unique(pairs, return_counts=True)[1].max() < 8


def production_rounds():
    return inspect.signature(token_files.write_tokens).parameters["rounds"].default


def test_rounds_look_at_what_can_have_become_frequent(monkeypatch):
    """Rounds after the first look at neighbours of new symbols only, and still leave no frequent pair."""
    chance = np.random.default_rng(3)
    words = [chance.integers(0, 4000, chance.integers(2, 9)) for _ in range(600)]
    ids = np.concatenate([words[min(int(k), 599)] for k in chance.zipf(1.3, 12_000)]).astype("<u4")
    ends = chance.random(len(ids)) < 0.01
    ends[-1] = True
    looked, frequent = [], token_files._frequent

    def counted(pair, least):
        looked.append(len(pair))
        return frequent(pair, least)

    monkeypatch.setattr(token_files, "_frequent", counted)
    symbols, left, right, lengths = token_files.re_pair(ids, ends)
    assert len(looked) > 5 and sum(looked[1:]) < 2 * looked[0]
    rules = token_files._Rules(left, right, lengths)
    assert np.array_equal(rules.expand(symbols), ids)
    assert np.array_equal(rules.expand(symbols[:3]), ids[: int(rules.lengths(symbols[:3]).sum())])
    last = np.isin(np.cumsum(rules.lengths(symbols)) - 1, np.flatnonzero(ends))
    pairs = Counter(zip(symbols[:-1][~last[:-1]].tolist(), symbols[1:][~last[:-1]].tolist()))
    assert max(pairs.values(), default=0) < 8 or all(a == b for (a, b), n in pairs.items() if n >= 8)
