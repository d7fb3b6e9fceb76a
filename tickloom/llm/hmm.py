"""Language-model scores: a hidden Markov model trained by Baum-Welch over all partitions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_and_text, saved

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LENGTHS = 16  # classes of rarer words, by bytes; longer words are in the last
_END = np.int64(xxhash.xxh64_intdigest(b" end of text ") - (1 << 63))  # no word has a blank



class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return value


_words = _Words()


def tokens(text: str) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and length class of every token of a whole text, its end last."""
    words = text.encode().translate(_LOWER).split()
    n = len(words) + 1
    keys, kinds = np.empty(n, np.int64), np.zeros(n, np.int64)
    if words:
        keys[:-1] = np.fromiter(map(_words.__getitem__, words), np.int64, n - 1)
        kinds[:-1] = np.fromiter(map(len, words), np.int64, n - 1)
    keys[-1] = _END
    return keys, np.clip(kinds, 1, _LENGTHS) - 1


def language_model_scores(
    docs: DataFrame,
    parts: int = 5,
    left_out: int = 1,
    states: int = 8,
    own_symbols: int = 20_000,
    rounds: int = 4,
) -> DataFrame:
    """One row per row of `docs`: counts, the unigram base score and the model's, in log10.

    Learns from documents whose crc32 of doc_id as text, modulo `parts`, is not
    `left_out`. NULL texts are empty: their end is their only token. A NULL id
    counts as empty text in that rule; repeated rows are learnt and scored each.
    With nothing to learn from, every unigram probability is 1.

    The hidden states emit symbols: each of the `own_symbols` most frequent words
    is one, the end is one, and rarer words share one for each length. A rarer
    word's probability within its symbol comes from its count, with half a count
    more for each word and for one unknown, so the probabilities add up to 1.
    That keeps the model to states * own_symbols numbers whatever the
    vocabulary, and these are all that tasks are told. Counts of rarer words
    are joined to the documents that have them.

    Words are told apart by 64-bit hashes. All training documents take part in
    every round of Baum-Welch; for the expected counts, and only there, a text is
    taken in stretches of 256 tokens, each with a start of its own.
    """
    texts = id_and_text(docs).withColumn("held_out", held_out(F.col("doc_id"), parts, left_out))
    counts = saved(_count(texts.filter(~F.col("held_out"))))
    total = counts.agg(F.sum("c").alias("n"), F.count("c").alias("v")).first()
    n, v = total.n or 0, total.v
    frequent = (
        counts.filter(F.col("h") != int(_END)).orderBy(F.desc("c"), "h").limit(own_symbols).toPandas()
    ).sort_values("h")
    end = counts.filter(F.col("h") == int(_END)).agg(F.sum("c")).first()[0] or 0
    rare = counts.filter(F.col("h") != int(_END))
    if len(frequent) == own_symbols:
        # Words as frequent as the last of these may be rare ones; no row is both.
        rare = rare.join(
            F.broadcast(docs.sparkSession.createDataFrame(frequent[["h"]])), "h", "left_anti"
        )
    else:
        rare = rare.limit(0)
    kinds = {r.kind: (r.n, r.v) for r in rare.groupBy("kind").agg(F.sum("c").alias("n"), F.count("c").alias("v")).collect()}
    vocabulary = Vocabulary(
        frequent["h"].to_numpy(np.int64), frequent["c"].to_numpy(np.int64), int(end), int(n), int(v), kinds
    )
    encoded = saved(_encode(texts, vocabulary))
    model = train(encoded.filter(~F.col("held_out")), vocabulary, states, rounds)

    pairs = encoded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("h"), F.col("x.times").alias("times")
    )
    # Counts are the smaller side of each partition; a rarer word is no hot key.
    of_rare = (
        pairs.join(rare.select("h", "c").hint("shuffle_hash"), "h", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("rare_log"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    found = _forward(encoded, vocabulary, model).join(of_rare, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    base = F.col("own_log") + rare_log - F.col("n_tokens") * F.lit(log10(n + 0.5 * (v + 1)))
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("own_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("symbols_log") + rare_log).alias("score"),
    )


@dataclass
class Vocabulary:
    """Symbols: frequent words in order of their hash, the end, then a class for each length."""

    h: np.ndarray
    c: np.ndarray
    end: int
    n: int
    v: int
    kinds: dict[int, tuple[int, int]]

    @property
    def size(self) -> int:
        return len(self.h) + 1 + _LENGTHS

    def symbols(self, keys: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        m = len(self.h)
        at = np.minimum(np.searchsorted(self.h, keys), max(m - 1, 0))
        own = self.h[at] == keys if m else np.zeros(len(keys), bool)
        return np.where(own, at, np.where(keys == _END, m, m + 1 + kinds))

    def counts(self) -> np.ndarray:
        return np.concatenate(
            [self.c, [self.end], [self.kinds.get(k, (0, 0))[0] for k in range(_LENGTHS)]]
        ).astype(float)

    def own_logs(self) -> np.ndarray:
        """log10 of count and a half per symbol of one word; 0 for classes, whose words are joined."""
        logs = np.zeros(self.size)
        logs[: len(self.h)] = np.log10(self.c + 0.5)
        logs[len(self.h)] = log10(self.end + 0.5)
        return logs

    def class_logs(self) -> np.ndarray:
        """What log10 of count and a half is reduced by to be a probability within a class."""
        logs = np.zeros(self.size)
        for k in range(_LENGTHS):
            n, v = self.kinds.get(k, (0, 0))
            logs[len(self.h) + 1 + k] = log10(n + 0.5 * (v + 1))
        return logs


@dataclass
class HMM:
    start: np.ndarray  # of texts, and of later stretches
    move: np.ndarray
    emit: np.ndarray  # symbol, state

    def log10_likelihood(self, texts: list[np.ndarray]) -> np.ndarray:
        """Exact, by forward recursion over whole texts, scaled at each token."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order])
        found = np.zeros(len(texts))
        flat = np.concatenate([texts[i] for i in order]) if texts else np.empty(0, int)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        a = np.tile(self.start[0], (len(texts), 1))
        for t in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -t, side="left"))  # those longer than t
            a = (a[:live] @ self.move if t else a[:live]) * self.emit[flat[begin[:live] + t]]
            scale = a.sum(axis=1)
            a /= scale[:, None]
            found[order[:live]] += np.log10(scale)
        return found

    def expected(self, stretches: np.ndarray, lengths: np.ndarray, first: np.ndarray):
        """Expected counts of starts, moves and emissions of a block of stretches, longest first."""
        b, longest = stretches.shape
        k = len(self.move)
        alpha = np.empty((longest, b, k))
        scales = np.ones((longest, b))
        live = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(longest + 1)]
        for t in range(longest):
            m = live[t]
            before = alpha[t - 1, :m] @ self.move if t else self.start[np.where(first, 0, 1)]
            a = before * self.emit[stretches[:m, t]]
            scales[t, :m] = a.sum(axis=1)
            alpha[t, :m] = a / scales[t, :m, None]
        moves, starts = np.zeros((k, k)), np.zeros((2, k))
        beta = np.ones((b, k))
        # What a token's state is thought to be, in place of alpha.
        for t in range(longest - 1, -1, -1):
            m = live[t]
            if t + 1 < longest and (after := live[t + 1]):
                ahead = beta[:after] * self.emit[stretches[:after, t + 1]] / scales[t + 1, :after, None]
                moves += alpha[t, :after].T @ ahead
                beta[:after] = ahead @ self.move.T
            alpha[t, :m] *= beta[:m]
        moves *= self.move
        starts[0] = alpha[0][first].sum(axis=0)
        starts[1] = alpha[0][~first].sum(axis=0)
        used = np.arange(longest)[:, None] < lengths[None, :]
        seen, weights = stretches.T[used], alpha[used]
        emitted = np.stack(
            [np.bincount(seen, weights[:, s], minlength=len(self.emit)) for s in range(k)], axis=1
        )
        return starts, moves, emitted


def _count(texts: DataFrame) -> DataFrame:
    """(h, kind, c): tokens of the training texts; counted per batch, then added up."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            parts = [tokens(t) for t in batch["text"]]
            keys, kinds = (np.concatenate(x) for x in zip(*parts))
            h, at, c = np.unique(keys, return_index=True, return_counts=True)
            yield pd.DataFrame({"h": h, "kind": kinds[at].astype(np.int32), "c": c})

    return (
        texts.mapInPandas(count, "h long, kind int, c long")
        .groupBy("h")
        .agg(F.min("kind").alias("kind"), F.sum("c").alias("c"))
    )


def _encode(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Symbols of every text as packed numbers, and its rarer words with how often each."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, symbols binary, "
        "rare array<long>, times array<int>"
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = shared.value
        row = TaskContext.get().partitionId() << 40
        classes = len(vocabulary.h) + 1
        for batch in batches:
            found = []
            for doc_id, out, text in zip(batch["doc_id"].array, batch["held_out"], batch["text"]):
                keys, kinds = tokens(text)
                symbols = vocabulary.symbols(keys, kinds)
                rare, times = np.unique(keys[symbols >= classes], return_counts=True)
                found.append(
                    (row, doc_id, out, len(keys), symbols.astype("<u4").tobytes(), rare, times.astype(np.int32))
                )
                row += 1
            columns = ["row", "doc_id", "held_out", "n_tokens", "symbols", "rare", "times"]
            yield pd.DataFrame(found, columns=columns).astype({"doc_id": "Int64"})

    return texts.mapInPandas(encode, schema)


def train(encoded: DataFrame, vocabulary: Vocabulary, states: int, rounds: int, stretch: int = 256) -> HMM:
    """Baum-Welch: each round adds up expected counts of all rows; only these sums reach the driver."""
    size = vocabulary.size
    unigram = (vocabulary.counts() + 0.5) / (vocabulary.counts() + 0.5).sum()
    chance = np.random.default_rng(9)
    emit = unigram[:, None] * (0.5 + chance.random((size, states)))
    move = np.full((states, states), 1.0) + chance.random((states, states))
    start = np.ones((2, states))
    model = _normal(start, move, emit)
    context = encoded.sparkSession.sparkContext
    columns = [f"x{s}" for s in range(states)]
    for _ in range(rounds):
        shared = context.broadcast(model)

        def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = shared.value  # noqa: B023
            starts, moves = np.zeros((2, states)), np.zeros((states, states))
            emitted = np.zeros((size, states))
            for batch in batches:
                for block in _blocks(batch["symbols"], stretch):
                    for total, part in zip((starts, moves, emitted), model.expected(*block)):
                        total += part
            seen = np.flatnonzero(emitted.sum(axis=1) > 0)
            if len(seen):
                numbers = np.concatenate([emitted[seen], starts, moves])
                place = np.concatenate([seen, size + np.arange(2 + states)])
                yield pd.DataFrame(numbers, columns=columns).assign(place=place)

        schema = ", ".join(f"{c} double" for c in columns) + ", place long"
        sums = encoded.select("symbols").mapInPandas(expect, schema).groupBy("place").agg(
            *[F.sum(c).alias(c) for c in columns]
        ).toPandas()
        added = np.zeros((size + 2 + states, states))
        added[sums["place"].to_numpy(int)] = sums[columns].to_numpy()
        # A little of the unigram distribution, so that no state rules a symbol out.
        model = _normal(
            added[size : size + 2] + 1, added[size + 2 :] + 1, added[:size] + 10 * unigram[:, None]
        )
        shared.unpersist()
    return model


def _normal(start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> HMM:
    return HMM(
        start / start.sum(axis=1, keepdims=True), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    )


def _blocks(texts: pd.Series, stretch: int, block: int = 1024):
    """Stretches of all texts, longest first, in blocks: symbols, lengths, whether a text begins."""
    parts, first = [], []
    for raw in texts:
        symbols = np.frombuffer(raw, "<u4").astype(np.int64)
        for at in range(0, len(symbols), stretch):
            parts.append(symbols[at : at + stretch])
            first.append(at == 0)
    order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
    for begin in range(0, len(order), block):
        chosen = order[begin : begin + block]
        lengths = np.array([len(parts[i]) for i in chosen])
        padded = np.zeros((len(chosen), lengths[0]), np.int64)
        for row, i in enumerate(chosen):
            padded[row, : lengths[row]] = parts[i]
        yield padded, lengths, np.array([first[i] for i in chosen])


def _forward(encoded: DataFrame, vocabulary: Vocabulary, model: HMM) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast((vocabulary, model))
    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, own_known long, own_log double, "
        "symbols_log double"
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, model = shared.value
        own, within = vocabulary.own_logs(), vocabulary.class_logs()
        known = np.zeros(vocabulary.size, np.int64)
        known[: len(vocabulary.h)] = 1
        known[len(vocabulary.h)] = vocabulary.end > 0
        for batch in batches:
            texts = [np.frombuffer(s, "<u4").astype(np.int64) for s in batch["symbols"]]
            logs = model.log10_likelihood(texts)
            yield batch[["row", "doc_id", "held_out", "n_tokens"]].astype({"doc_id": "Int64"}).assign(
                own_known=[int(known[t].sum()) for t in texts],
                own_log=[float(own[t].sum()) for t in texts],
                symbols_log=[float(x - within[t].sum()) for x, t in zip(logs, texts)],
            )

    return encoded.drop("rare", "times").mapInPandas(score, schema)
