"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_and_text, one_label, saved

_WORD = re.compile(r"[^\W\d_]+")

# Insults that make a lexicon voter each.
INSULTS = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless",
    "disgusting", "dumb", "fool", "garbage", "imbecile", "jerk", "filthy", "vermin", "coward",
    "dummkopf", "abschaum", "versager", "trottel", "connard", "ordure", "imbécile", "minable",
    "idiota", "estúpido", "basura", "escoria",
)
_PREFIXES = (4, 5, 6)


def _features(text: str | None) -> tuple[set[str], set[str]]:
    """Distinct words of a whole text, and their beginnings of some lengths, marked `4:` and so on."""
    words = set(_WORD.findall((text or "").lower()))
    starts = {f"{k}:{w[:k]}" for k in _PREFIXES for w in words if len(w) > k}
    return words, starts


@dataclass
class Voters:
    """Voter v votes for toxic where a text has one of its terms; pattern voters come last."""

    voter_of: dict[str, int]
    n_terms: int

    @property
    def n(self) -> int:
        return self.n_terms + 3

    def votes(self, text: str | None) -> np.ndarray:
        """1 for toxic, -1 for not toxic, 0 for no opinion."""
        found = np.zeros(self.n, np.int8)
        if text:
            get, lengths = self.voter_of.get, _PREFIXES
            for w in set(_WORD.findall(text.lower())):
                v = get(w)
                if v is not None:
                    found[v] = 1
                for k in lengths:
                    v = get(f"{k}:{w[:k]}") if len(w) > k else None
                    if v is not None:
                        found[v] = 1
        hits = int(found[: self.n_terms].sum())
        found[self.n_terms] = 1 if hits >= 3 else 0 if hits else -1
        found[self.n_terms + 1] = 0 if hits else -1
        text = text or ""
        found[self.n_terms + 2] = 1 if text.count("!") > 0.2 * (1 + text.count(" ")) else 0
        return found


def _mine(chosen: DataFrame, most: int) -> Voters:
    """Lexicon voters: the fixed insults, and terms that stand out in texts labelled toxic.

    Terms are words and beginnings of words. They are counted per batch and added
    up by Spark, in clean texts each time that a term of toxic ones is seen; the `most`
    with the surest association are kept, a bound of the model.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = Counter()
            for text in batch["text"]:
                for terms in _features(text):
                    seen.update(terms)
            yield pd.DataFrame({"term": list(seen), "n": list(seen.values())})

    bad, good = (chosen.filter(F.col("label") == x).mapInPandas(count, "term string, n long") for x in (1, 0))
    bad = saved(bad.groupBy("term").agg(F.sum("n").alias("bad")).filter(F.col("bad") >= 2))
    good = good.join(bad, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("good"))
    counted = saved(
        bad.join(good, "term", "left")
        .select("term", "bad", F.coalesce("good", F.lit(0)).alias("good"))
        .withColumn("sure", _surely(F.col("bad"), F.col("bad") + F.col("good")))
        .filter(F.col("bad") >= 4 * F.col("good"))
    )
    # A beginning counts if several words share it; else it is but one of these words.
    word = F.col("term")
    shared = (
        counted.filter(~word.contains(":"))
        .select(F.explode(F.array(*[_start(word, k) for k in _PREFIXES])).alias("term"))
        .groupBy("term")
        .agg(F.count("term").alias("kinds"))
    )
    counted = (
        counted.join(shared, "term", "left")
        .filter((F.col("sure") >= 0.55) & (~word.contains(":") | (F.col("kinds") >= 4)))
        .orderBy(F.desc(F.col("bad") * F.col("sure")), "term")
        .limit(most)
    )
    terms = [r.term for r in counted.collect()]
    # Insults that nobody labelled are voters too; a word and its beginning vote apart.
    terms += [w for w in INSULTS if w not in terms]
    return Voters({t: i for i, t in enumerate(terms)}, len(terms))


def _start(word: Column, k: int) -> Column:
    return F.when(F.length(word) > k, F.concat(F.lit(f"{k}:"), F.substring(word, 1, k)))


def _surely(part: Column, whole: Column, z: float = 1.96) -> Column:
    """Wilson's lower bound of a share."""
    share = part / whole
    spread = z * F.sqrt(share * (1 - share) / whole + z * z / (4 * whole * whole))
    return (share + z * z / (2 * whole) - spread) / (1 + z * z / whole)


def _unlike(chosen: DataFrame) -> DataFrame:
    """One text of each group of near copies: texts that agree in the least and the largest hash.

    Else the rare words of a toxic text that was copied would look like insults.
    """

    @F.pandas_udf("a long, b long")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        found = []
        for text in texts:
            words = (text or "").split()
            hashes = {crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))}
            found.append((min(hashes), max(hashes)))
        return pd.DataFrame(found, columns=["a", "b"])

    row = F.struct("doc_id", "label", "text")
    chosen = chosen.withColumn("sketch", sketch("text"))
    return chosen.groupBy("sketch.a", "sketch.b").agg(F.min(row).alias("row")).select("row.*")


@dataclass
class LabelModel:
    """Votes given the class: P(vote | class) per voter, and how much each voter counts.

    Voters that agree more than their accuracies explain would be counted several
    times; `weight` divides each by the number of voters it goes along with.
    """

    log_prior: np.ndarray
    log_vote: np.ndarray  # voter, vote + 1, class
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        at = votes.astype(int) + 1
        logs = self.log_prior + np.stack(
            [(self.log_vote[np.arange(votes.shape[1]), at, c] * self.weight).sum(axis=1) for c in (0, 1)], axis=1
        )
        logs -= logs.max(axis=1, keepdims=True)
        p = np.exp(logs)
        return p[:, 1] / p.sum(axis=1)


def fit_label_model(votes: np.ndarray, gold: np.ndarray, rounds: int = 10, noise: float = 0.1) -> LabelModel:
    """Expectation maximisation over the votes; a gold label is one more voter, wrong `noise` of the time.

    Each round takes accuracies from the posterior, then correlations: the
    dependence of two voters left within a class, as a phi coefficient.
    """
    n, m = votes.shape
    if not n:
        return LabelModel(np.log([0.5, 0.5]), np.zeros((m, 3, 2)), np.ones(m))
    start = np.where(gold == 1, 1 - noise, noise)
    p, weight = start, np.ones(m)
    one_hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(np.float32)  # row, voter, vote
    model = None
    for _ in range(rounds):
        by_class = np.stack([1 - p, p], axis=1)
        total = by_class.sum(axis=0)
        counts = np.einsum("rvk,rc->vkc", one_hot, by_class) + 0.5
        log_vote = np.log(counts / counts.sum(axis=1, keepdims=True))
        # Correlations: phi of every pair of voters within each class, averaged over classes.
        x, together = (votes > 0).astype(np.float64), np.zeros((m, m))
        for c in (0, 1):
            mean = (x * by_class[:, c : c + 1]).sum(axis=0) / max(total[c], 1e-9)
            cross = (x * by_class[:, c : c + 1]).T @ x / max(total[c], 1e-9) - np.outer(mean, mean)
            sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
            together += np.clip(cross / np.outer(sd, sd), 0, 1) * (total[c] / total.sum())
        np.fill_diagonal(together, 0)
        weight = 1 / (1 + np.where(together > 0.1, together, 0).sum(axis=1))
        model = LabelModel(np.log((total + 1) / (total.sum() + 2)), log_vote, weight)
        by_votes = model.posterior(votes)
        odds = np.log(by_votes.clip(1e-9, 1 - 1e-9) / (1 - by_votes).clip(1e-9)) + np.where(
            gold == 1, 1, -1
        ) * np.log((1 - noise) / noise)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return model


@dataclass
class ToxicityModel:
    voters: Voters
    label_model: LabelModel
    coefficients: np.ndarray
    intercept: float

    def score(self, texts) -> np.ndarray:
        votes = [self.voters.votes(t) for t in texts]
        x = _inputs(np.array(votes, np.float32).reshape(-1, self.voters.n), self.voters)
        return 1 / (1 + np.exp(-np.clip(x @ self.coefficients + self.intercept, -30, 30)))


def _inputs(votes: np.ndarray, voters: Voters) -> np.ndarray:
    """What the classifier sees: the votes, and how many terms voted."""
    hits = votes[:, : voters.n_terms].sum(axis=1, keepdims=True)
    return np.concatenate([votes, np.log1p(hits), hits > 0], axis=1).astype(np.float64)


def _logistic(x: np.ndarray, p: np.ndarray, penalty: float = 1.0, rounds: int = 30):
    """Newton's method for soft labels p, with a ridge penalty except on the intercept."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (q - p) + ridge * w
        bend = (x * (q * (1 - q) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(
    docs: DataFrame, labels: DataFrame, rows: Column | None = None, most: int = 20_000, most_terms: int = 150
) -> ToxicityModel:
    """Fit on labelled documents; `rows` restricts which, as a condition on doc_id.

    `labels` is (doc_id, label) with one label a document. At most about `most`
    of them are used, chosen by a hash of doc_id, which bounds the labels that
    are broadcast; where a doc_id has many texts, about as many texts are used, chosen by
    their hash, which bounds the votes that the driver collects, a byte for each voter.
    """
    if rows is not None:
        labels = labels.filter(rows)
    share = most / max(labels.count(), 1)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    chosen = id_and_text(docs).join(F.broadcast(labels.filter(draw)), "doc_id")
    chosen = saved(_unlike(chosen))
    # A label may hold for many unlike texts of one doc_id: the texts are bounded as well.
    share = most / max(chosen.count(), 1)
    if share < 0.5:
        draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(5)), F.lit(1 << 30))
        chosen = saved(chosen.filter(draw < F.lit(int(share * (1 << 30)))))
    voters = _mine(chosen, most_terms)

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "votes": [voters.votes(t).tobytes() for t in batch["text"]],
                    "label": batch["label"],
                }
            )

    found = chosen.mapInPandas(vote, "doc_id long, votes binary, label double").collect()
    found.sort(key=lambda r: (r.doc_id, r.votes))
    votes = np.frombuffer(b"".join(r.votes for r in found), np.int8).reshape(-1, voters.n)
    gold = np.array([r.label for r in found])
    model = fit_label_model(votes, gold)
    posterior = model.posterior(votes) if len(votes) else np.empty(0)
    coefficients, intercept = _logistic(_inputs(votes.astype(np.float32), voters), posterior)
    return ToxicityModel(voters, model, coefficients, intercept)


def score(text: Column, model: ToxicityModel) -> Column:
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))

    return F.pandas_udf(scored, "double")(text)


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, left_out: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`.

    Labels are learnt from documents that are not held out: crc32 of doc_id as
    text, modulo `parts`, is `left_out` for those that are. A NULL id counts as
    empty text there, NULL texts score as empty ones, repeated rows score alike.
    Without labels the insults alone vote, and the score is 0.5.
    """
    known = one_label(labels, "toxic")
    model = train(docs, known, ~held_out(F.col("doc_id"), parts, left_out))
    scored = id_and_text(docs).select(
        "doc_id", held_out(F.col("doc_id"), parts, left_out).alias("held_out"), score(F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
