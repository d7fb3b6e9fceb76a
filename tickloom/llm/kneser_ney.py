"""Language of a text: interpolated Kneser-Ney models over characters, one per language."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, id_and_text, saved, ship

_WORD = re.compile(r"[^\W\d_]+")
_START, _END = 2, 3  # marks before and after a word; no letter has these codes
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
UNKNOWN = "und"


def words(text: str | None) -> list[str]:
    """The runs of letters of a text, in lower case."""
    found = _WORD.findall(text.lower()) if text else []
    return found if all(map(str.isalpha, found)) else [w for w in map(_letters, found) if w]


def _letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


class _Numbers(dict):
    """Words by number, in the order they are met."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


@dataclass
class Characters:
    """The characters of words one after the other, each word between a start and an end mark."""

    symbol: np.ndarray
    offset: np.ndarray  # place within its word, 0 for the start mark
    begin: np.ndarray  # where each word begins

    @staticmethod
    def of(words: list[str]) -> Characters:
        text = "".join(f"{chr(_START)}{w}{chr(_END)}" for w in words)
        symbol = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        length = np.fromiter(map(len, words), np.int64, len(words)) + 2
        begin = np.cumsum(length) - length
        return Characters(symbol, np.arange(len(symbol)) - np.repeat(begin, length), begin)

    def grams(self, order: int) -> list[np.ndarray]:
        """Hashes of the 0, 1, ... `order` characters that end at each place; those across words mean nothing."""
        found = [np.zeros(len(self.symbol), np.uint64)]
        for _ in range(order):
            shifted = np.concatenate([[np.uint64(0)], found[-1][:-1]])
            h = shifted * _BASE + self.symbol
            h ^= h >> np.uint64(29)
            found.append(h * _MIX)
        return found


    def asked(self, order: int) -> list[tuple[np.ndarray, ...]]:
        """Per order the places that a model predicts, and their grams and contexts: each once, and which is where.

        This is the same for all models; what repeats is looked up once in each.
        """
        grams = self.grams(order)
        found = []
        for k in range(1, order + 1):
            here = np.flatnonzero(self.offset >= max(k - 1, 1))
            contexts = grams[k - 1][here - 1] if k > 1 else grams[0][:1]
            found.append((here, *np.unique(grams[k][here], return_inverse=True), *np.unique(contexts, return_inverse=True)))
        return found


@dataclass
class Level:
    """One order of a model: sorted hash arrays of grams and of their contexts.

    `share` is what a gram has of its context's mass after the discount, `rest`
    what is left of a context for the order below.
    """

    grams: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray


@dataclass
class KneserNey:
    """An interpolated Kneser-Ney model of the words of one language."""

    levels: list[Level]

    def surprise(self, chars: Characters, alphabet: int, asked: list[tuple[np.ndarray, ...]] | None = None) -> np.ndarray:
        """Minus the natural logarithm of each word's probability, its end included.

        `asked` is `chars.asked(order)`, for those who ask several models.
        """
        p = np.full(len(chars.symbol), 1 / alphabet)
        for level, (here, grams, of_gram, contexts, of_context) in zip(self.levels, asked or chars.asked(len(self.levels))):
            # A context that was never seen leaves all to the order below.
            share = _look_up(level.grams, level.share, grams, 0.0)[of_gram]
            p[here] = share + _look_up(level.contexts, level.rest, contexts, 1.0)[of_context] * p[here]
        p[chars.offset == 0] = 1
        return -np.add.reduceat(np.log(p), chars.begin) if len(chars.begin) else np.empty(0)


def _look_up(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, none: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(asked), none)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], none)


def fit(words: list[str], times: np.ndarray, order: int = 5) -> KneserNey:
    """The model of words seen so many `times`.

    The highest order, and grams that begin with a word, count occurrences; others count the
    different characters before them. Each order has one discount, n1 / (n1 + 2 n2) of the
    grams counted once and twice, kept within 0.1 and 0.9.
    """
    chars = Characters.of(words)
    grams = chars.grams(order)
    weight = np.repeat(np.asarray(times, np.float64), np.diff(np.append(chars.begin, len(chars.symbol))))
    levels = []
    for k in range(1, order + 1):
        here = np.flatnonzero(chars.offset >= max(k - 1, 1))
        keys, first, back = np.unique(grams[k][here], return_index=True, return_inverse=True)
        count = np.bincount(back, weight[here], len(keys))
        if k < order:
            # Grams one longer, once each: what stands before this one, where anything does.
            longer = np.flatnonzero(chars.offset >= k)
            _, once = np.unique(grams[k + 1][longer], return_index=True)
            endings, different = np.unique(grams[k][longer[once]], return_counts=True)
            inside = chars.offset[here[first]] != k - 1
            at = np.minimum(np.searchsorted(endings, keys), max(len(endings) - 1, 0))
            count = np.where(inside, different[at] if len(endings) else 0, count)
        context = grams[k - 1][here[first] - 1] if k > 1 else grams[0][here[first]]
        contexts, of = np.unique(context, return_inverse=True)
        total = np.bincount(of, count, len(contexts))
        kinds = np.bincount(of, minlength=len(contexts))
        once, twice = (count == 1).sum(), (count == 2).sum()
        discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
        share = np.maximum(count - discount, 0) / total[of]
        # What discounts take from a context, also where a count is below the discount.
        rest = np.bincount(of, np.minimum(count, discount), len(contexts)) / total
        levels.append(Level(keys, share, contexts, np.where(kinds > 0, rest, 1)))
    return KneserNey(levels)


@dataclass
class LanguageModel:
    """A model per language, and what turns their cross-entropies into a calibrated score."""

    languages: list[str]
    models: list[KneserNey]
    alphabet: int
    usual: np.ndarray  # mean cross-entropy of each language's own texts
    weights: np.ndarray  # of the features in `_features`, the last one constant

    def entropies(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(text, language) nats a character, and characters per text: letters and word ends."""
        number = _Numbers()
        counts = np.zeros(len(texts), np.int64)
        found = []
        for i, text in enumerate(texts):
            own = words(text)
            counts[i] = len(own)
            found.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
        ids = np.concatenate([*found, np.empty(0, np.int32)])
        del found
        distinct = list(number)
        length = np.fromiter(map(len, distinct), np.int64, len(distinct)) + 1
        text_of = np.repeat(np.arange(len(texts)), counts)
        size = np.bincount(text_of, length[ids] if len(ids) else None, len(texts))
        total = np.zeros((len(texts), len(self.models)))
        # Words in parts, so that what is looked up at once is bounded.
        for begin in range(0, len(distinct), 50_000):
            part = distinct[begin : begin + 50_000]
            chars = Characters.of(part)
            asked = chars.asked(len(self.models[0].levels)) if self.models else []
            within = (ids >= begin) & (ids < begin + len(part))
            for j, model in enumerate(self.models):
                nats = model.surprise(chars, self.alphabet, asked)
                total[:, j] += np.bincount(text_of[within], nats[ids[within] - begin], len(texts))
        return total / np.maximum(size, 1)[:, None], size

    def best(self, entropies: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language with the lowest cross-entropy, the first of equals, and its score."""
        if not self.models:
            return np.full(len(sizes), -1), np.zeros(len(sizes))
        chosen = entropies.argmin(axis=1)
        x = _features(entropies, sizes, chosen, self.usual)
        score = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
        return np.where(sizes > 0, chosen, -1), np.where(sizes > 0, score, 0.0)


def _features(entropies: np.ndarray, sizes: np.ndarray, chosen: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """How far the best language lies before the next, how unusual the text is for it, and how long it is."""
    rows = np.arange(len(sizes))
    best = entropies[rows, chosen]
    others = entropies.copy()
    others[rows, chosen] = np.inf
    margin = others.min(axis=1) - best if entropies.shape[1] > 1 else np.zeros(len(sizes))
    unusual = best - usual[chosen]
    long = np.log1p(sizes) / 10
    return np.stack([margin, unusual, np.minimum(margin, 2) * long, unusual * long, long, np.ones(len(sizes))], axis=1)


def _calibrated(entropies: np.ndarray, sizes: np.ndarray, own: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Weights of a logistic score: is the best language the text's own?

    Texts are judged once by all models, and once without the model of their own
    language, where the best one is wrong: so the score learns to reject texts
    of languages that no model knows.
    """
    n_lang = entropies.shape[1]
    if not len(sizes):
        return np.zeros(6)
    chosen = entropies.argmin(axis=1)
    x, y = [_features(entropies, sizes, chosen, usual)], [(chosen == own).astype(float)]
    if n_lang > 2:
        without = entropies.copy()
        without[np.arange(len(sizes)), own] = np.inf
        chosen = without.argmin(axis=1)
        x.append(_features(without, sizes, chosen, usual))
        y.append(np.zeros(len(sizes)))
    x, y = np.concatenate(x), np.concatenate(y)
    # Platt's targets keep probabilities off 0 and 1.
    right = y.sum()
    y = np.where(y == 1, (right + 1) / (right + 2), 1 / (len(y) - right + 2))
    w = np.zeros(x.shape[1])
    ridge = np.array([1e-2] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(
    docs: DataFrame,
    rows: Column | None = None,
    most: int = 12_000,
    most_languages: int = 200,
    most_words: int = 100_000,
    order: int = 5,
) -> LanguageModel:
    """Fit on documents with a language; `rows` restricts which, as a condition on doc_id.

    About `most` distinct texts are used, the same number of each language, chosen by a hash of
    the text; a fifth of them calibrates the score and the others make the models. A
    language's model knows its `most_words` most frequent words of these, and is fitted in a task. The
    `most_languages` most frequent languages are learnt. These bound the models that the driver
    collects and broadcasts. Texts count once, however many rows repeat them.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("own"))
    known = known.filter(F.col("own").isNotNull() & F.col("text").isNotNull())
    if rows is not None:
        known = known.filter(rows)
    known = known.withColumn("h", F.xxhash64("text"))
    sizes = known.select("own", "h").distinct().groupBy("own").agg(F.count("h").alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "own").limit(most_languages).collect()
    if not sizes:
        return LanguageModel([], [], 2, np.empty(0), np.zeros(6))
    share = {r.own: min(1.0, most / len(sizes) / r.n) for r in sizes}
    limits = F.create_map(*[x for own in share for x in (F.lit(own), F.lit(int(share[own] * (1 << 30))))])
    drawn = known.filter(F.pmod(F.xxhash64("h", F.lit(12)), F.lit(1 << 30)) < limits[F.col("own")])
    # A text can be that of another with the same hash only by chance; both count then.
    drawn = drawn.groupBy("own", "h", "text").agg(F.lit(1).alias("one")).drop("one")
    drawn = saved(drawn.withColumn("fits", F.pmod(F.xxhash64("h", F.lit(13)), F.lit(5)) > 0))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for own, texts in batch.groupby("own")["text"]:
                found: dict[str, int] = {}
                for text in texts:
                    for w in words(text):
                        found[w] = found.get(w, 0) + 1
                yield pd.DataFrame({"own": own, "word": list(found), "n": list(found.values())})

    counts = drawn.filter("fits").mapInPandas(counted, "own string, word string, n long")
    counts = counts.groupBy("own", "word").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("own").orderBy(F.desc("n"), "word")
    counts = counts.withColumn("place", F.row_number().over(by_count)).filter(F.col("place") <= most_words)

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("word")
        words, times = frame["word"].to_list(), frame["n"].to_numpy(dtype=float)
        model = pickle.dumps(fit(words, times, order))
        return pd.DataFrame({"own": frame["own"].iloc[:1].to_list(), "letters": "".join({*"".join(words)}), "model": [model]})

    found = counts.groupBy("own").applyInPandas(fitted, "own string, letters string, model binary")
    found = sorted(found.collect(), key=lambda r: r.own)
    if not found:
        return LanguageModel([], [], 2, np.empty(0), np.zeros(6))
    languages, models = [r.own for r in found], [pickle.loads(r.model) for r in found]
    letters = set("".join(r.letters for r in found))
    model = LanguageModel(languages, models, len(letters) + 2, np.zeros(len(models)), np.zeros(6))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            entropies, sizes = sent.value.entropies(batch["text"])
            yield pd.DataFrame({"own": batch["own"], "size": sizes, "entropies": list(entropies)})

    held = drawn.filter(~F.col("fits") & F.col("own").isin(languages)).mapInPandas(judged, "own string, size long, entropies array<double>")
    found = held.filter("size > 0").toPandas()
    if len(found):
        entropies = np.stack(found["entropies"].to_list())
        own = found["own"].map(languages.index).to_numpy()
        at_home = entropies[np.arange(len(own)), own]
        n = np.bincount(own, minlength=len(languages))
        model.usual = np.where(n > 0, np.bincount(own, at_home, len(languages)) / np.maximum(n, 1), at_home.mean())
        model.weights = _calibrated(entropies, found["size"].to_numpy(), own, model.usual)
    return model


def languages(
    docs: DataFrame, parts: int = 3, left_out: int = 1, reject: float = 0.5, **settings
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected, cross_entropy) of every row of `docs`.

    The language with the lowest cross-entropy, in nats a letter or word end, over all words of the
    text. The score is the calibrated probability that it is right; below `reject`
    the text is `rejected`, as of a language that was not learnt, and still names the nearest.
    A text that is NULL or has no letter is `und`, with score 0, rejected, without a
    cross-entropy; so is every text if there is nothing to learn from.

    Languages are learnt from documents that are not held out: crc32 of doc_id as
    text, modulo `parts`, is `left_out` for those that are. A NULL id counts as empty text
    there. Repeated rows are scored alike; nothing gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(train(docs, ~held_out(F.col("doc_id"), parts, left_out), **settings))

    def told(texts: pd.Series) -> pd.DataFrame:
        known = model.value
        found = [pd.DataFrame({"lang_pred": [], "score": [], "cross_entropy": []})]
        for begin in range(0, len(texts), 2000):
            entropies, sizes = known.entropies(texts.iloc[begin : begin + 2000])
            chosen, score = known.best(entropies, sizes)
            least = entropies.min(axis=1) if known.models else np.full(len(sizes), np.nan)
            frame = {
                "lang_pred": [known.languages[c] if c >= 0 else UNKNOWN for c in chosen],
                "score": score,
                "cross_entropy": [float(e) if c >= 0 else None for e, c in zip(least, chosen)],
            }
            found.append(pd.DataFrame(frame))
        return pd.concat(found[1:] or found, ignore_index=True)

    told = F.pandas_udf(told, "lang_pred string, score double, cross_entropy double")
    found = id_and_text(docs).select(
        "doc_id", held_out(F.col("doc_id"), parts, left_out).alias("held_out"), told("text").alias("told")
    )
    return found.select(
        "doc_id",
        "held_out",
        "told.lang_pred",
        "told.score",
        (F.col("told.score") < reject).alias("rejected"),
        "told.cross_entropy",
    )
