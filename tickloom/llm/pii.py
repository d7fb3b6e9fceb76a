"""Personal data: patterns with checks, and further spans chosen by boosted trees."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, id_and_text, saved, ship

# The kinds in the order in which spans are listed, `secret` only by the method.
KINDS = ("email", "ip", "card", "phone", "secret")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number is taken from its first digit on; from within, a match would fail alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")

FOUND = (
    "n_email long, n_ip long, n_card long, n_phone long, n_spans long, base_sha256 string, spans string, "
    "found array<struct<kind: string, start: long, end: long>>"
)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match holds one @: what stands before it and after it decides."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_ip(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that pass its check, by kind, then start."""
    if not _ANY.search(text):
        return []
    found = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if _is_ip(m[0])]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if len(m[0]) >= 16 and _is_card(m[0])]
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# -- candidates --------------------------------------------------------------------------

# High-recall generators; their spans overlap each other and the base spans.
_GENERATORS = (
    ("email", re.compile(r"(?<![^\s\"'<>@])[^\s\"'<>@]++@[^\s\"'<>@]++")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,7}")),
    ("card", re.compile(r"[0-9](?:[ .-]?[0-9]){11,21}")),
    ("phone", re.compile(r"(?:\+|\(|(?<![0-9]))[0-9](?:[ ().-]{0,2}[0-9]){6,14}")),
    ("secret", re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+")),
)
# A name that a credential is assigned to: the weak label of a secret.
_CREDENTIAL = re.compile(
    r"(?:token|secret|passw(?:or)?d|passphrase|api[ _-]?key|auth\w*|credential)s?\s*(?:=|:|\bis\b)\s*[\"']?\Z", re.IGNORECASE
)
# Words that name a number as personal: weak labels of phones and cards.
_NAMED = {
    "phone": re.compile(
        r"\b(?:tel|telephone|phone|call|mobile|cell|fax|dial|whatsapp|telefon|handy|anruf|téléphone|appel\w*|teléfono|llam\w*)\b"
        r"[^0-9\n]{0,12}\Z",
        re.IGNORECASE,
    ),
    "card": re.compile(
        r"\b(?:card|visa|mastercard|amex|credit|debit|kreditkarte|karte|carte|tarjeta)\b[^0-9\n]{0,12}\Z", re.IGNORECASE
    ),
}
_CONTEXT = 32
FEATURES = 23


class _Taken:
    """Spans that are taken, merged where they overlap and sorted, so that one look tells if a place is free."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def free(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)  # those before i begin before the end
        return i == 0 or self.ends[i - 1] <= a

    def add(self, a: int, b: int) -> None:
        i = bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


@dataclass
class Candidate:
    kind: str
    start: int
    end: int
    features: list[float]
    weak: bool | None  # what the checks say: personal, not, or nothing


def candidates(text: str, taken: _Taken | None = None) -> list[Candidate]:
    """Spans of all generators in a whole text, with features of format and context; none where it is taken."""
    if not _ANY.search(text):
        return []
    spans = [(kind, *m.span()) for kind, pattern in _GENERATORS for m in pattern.finditer(text)]
    starts = np.sort(np.array([s[1] for s in spans]))
    found = []
    for kind, a, b in spans:
        if taken and not taken.free(a, b):
            continue
        around = int(np.searchsorted(starts, b + 200) - np.searchsorted(starts, a - 200)) - 1
        before = text[max(0, a - _CONTEXT) : a]
        found.append(Candidate(kind, a, b, _described(kind, text, a, b, before, around), _weak(kind, text[a:b], before)))
    return found


def _weak(kind: str, span: str, before: str) -> bool | None:
    """True where a check or the words before it say so, False where the format rules it out, else nothing."""
    digits = _digits(span)
    if kind == "email":
        return any(True for _ in _emails(span)) or (None if "." in span.partition("@")[2] else False)
    if kind == "ip":
        return span.count(".") == 3 and _is_ip(span)
    if kind == "card":
        if _is_card(span) or (len(digits) >= 12 and luhn(digits) and _NAMED["card"].search(before)):
            return True
        return None if luhn(digits) else False
    if kind == "phone":
        if 8 <= len(digits) <= 15 and (span[0] == "+" or _NAMED["phone"].search(before)):
            return True
        # Long runs of digits and what parts like an address are numbers of another kind.
        return False if len(digits) > 15 or "." in span or _NAMED["card"].search(before) else None
    if _CREDENTIAL.search(before):
        return True
    # Without a name for it: long words of letters with few digits are not secrets.
    return False if len(digits) * 8 < len(span) else None


def _described(kind: str, text: str, a: int, b: int, before: str, around: int) -> list[float]:
    span = text[a:b]
    n, counts = b - a, Counter(span)
    digits = sum(c.isdigit() for c in span)
    letters = sum(c.isalpha() for c in span)
    entropy = -sum(k / n * log2(k / n) for k in counts.values())
    number = _digits(span)
    last, following = before[-1:] or " ", text[b : b + 1] or " "
    # Fractions in thousandths and counts up to 500: few values each, whatever the number of candidates.
    return [
        float(KINDS.index(kind)),
        min(n, 500),
        round(digits / n, 3),
        round(letters / n, 3),
        round(sum(c.isupper() for c in span) / n, 3),
        round(entropy, 3),
        round(entropy / log2(n + 1), 3),
        min(len(number), 60),
        min(span.count("."), 500),
        min(span.count("-"), 500),
        min(span.count(" "), 500),
        min(span.count("@"), 500),
        float(span[0] == "+"),
        float(bool(number) and luhn(number)),
        min(max((len(p) for p in re.findall("[0-9]+", span)), default=0), 500),
        float(all(c in "0123456789abcdefABCDEF" for c in span)),
        float(last in "\"'"),
        float(following in "\"'"),
        float(any(c in "=:" for c in before[-4:])),
        float(last.isalnum() or following.isalnum()),
        float(bool(_CREDENTIAL.search(before))),
        float(any(p.search(before) for p in _NAMED.values())),
        min(around, 50),
    ]


# -- boosted trees -----------------------------------------------------------------------


@dataclass
class Trees:
    """Gradient boosting on the logistic loss; a tree is three levels of equal splits on bins."""

    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple] = field(default_factory=list)
    base: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)

    def bins(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float32)
        found = np.empty(x.shape, np.uint8)
        for j, e in enumerate(self.edges):
            found[:, j] = np.searchsorted(e.astype(np.float32), x[:, j], side="right")
        return found

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.raw_of(self.bins(x))

    def raw_of(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for splits, leaves in self.trees:
            total += leaves[_leaf(bins, splits)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated on candidates that the trees were not fitted to."""
        if not self.trees:
            return np.zeros(len(x))
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.raw(x) + b, -30, 30)))


def _leaf(bins: np.ndarray, splits) -> np.ndarray:
    leaf = np.zeros(len(bins), np.int64)
    for feature, cut in splits:
        leaf = 2 * leaf + (bins[:, feature] > cut)
    return leaf


_BINS = 32
# Slopes and bends are added up as whole numbers, so that sums do not depend on their order.
_UNIT = float(1 << 20)


def _sums(model: Trees, splits: list, bins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and bend of the loss per feature, node and bin, as the trees so far and the tree's first `splits` leave them."""
    p = 1 / (1 + np.exp(-model.raw_of(bins)))
    slope, bend = np.rint((y - p) * _UNIT), np.rint((p * (1 - p) + 1e-6) * _UNIT)
    leaf, size = _leaf(bins, splits) * _BINS, _BINS << len(splits)
    at = [leaf + bins[:, j] for j in range(bins.shape[1])]
    return np.array([[np.bincount(a, v, minlength=size) for a in at] for v in (slope, bend)])


class Held:
    """Candidates in memory."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.y = x, y
        self.positive, self.negative = y.sum(), (1 - y).sum()

    def edges(self) -> list[np.ndarray]:
        return [np.unique(np.quantile(self.x[:, j], _QUANTILES)) for j in range(self.x.shape[1])]

    def binned(self, model: Trees) -> None:
        self.bins = model.bins(self.x)

    def sums(self, model: Trees, splits: list) -> np.ndarray:
        return _sums(model, splits, self.bins, self.y)

    def done(self) -> None:
        pass


class Spread:
    """Candidates in a table (x binary): the features and label of some in each row.

    Each split of a tree is one job over all of them, which brings the sums of its tasks to
    the driver, of a fixed size each. Up to `held` candidates are brought there instead, as bins.
    `values` has how often each value of a feature occurs, the label counting as the last one.
    """

    def __init__(self, table: DataFrame, values: pd.DataFrame, held: int):
        self.table, self.values, self.held = table, values.sort_values(["j", "v"]), held
        label = values[values["j"] == FEATURES]
        self.positive, self.negative = (int(label["n"][label["v"] == v].sum()) for v in (1, 0))

    def __len__(self) -> int:
        return self.positive + self.negative

    def edges(self) -> list[np.ndarray]:
        found = []
        for j in range(FEATURES):
            own = self.values[self.values["j"] == j]
            upto = own["n"].to_numpy().cumsum()
            found.append(np.unique(own["v"].to_numpy()[np.searchsorted(upto, _QUANTILES * upto[-1])]))
        return found

    def binned(self, model: Trees) -> None:
        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = _rows(batch["x"])
                y = x[:, FEATURES].astype(np.uint8)
                yield pd.DataFrame({"bins": [model.bins(x[:, :FEATURES]).tobytes()], "y": [y.tobytes()]})

        cells = self.table.mapInPandas(each, "bins binary, y binary")
        self.memory = None
        if len(self) <= self.held:
            self.memory = _cells(cells.toPandas())
        else:
            self.cells = saved(cells)

    def sums(self, model: Trees, splits: list) -> np.ndarray:
        if self.memory:
            return _sums(model, splits, *self.memory)
        shape = (2, FEATURES, _BINS << len(splits))

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(shape)
            for batch in batches:
                for k in range(len(batch)):
                    total += _sums(model, splits, *_cells(batch[k : k + 1]))
            yield pd.DataFrame({"sums": [total.tobytes()]})

        found = self.cells.mapInPandas(each, "sums binary").collect()
        return np.sum([np.frombuffer(r.sums).reshape(shape) for r in found], axis=0)

    def done(self) -> None:
        if not self.memory:
            discard(self.cells)


_QUANTILES = np.linspace(0, 1, _BINS + 1)[1:-1]


def _rows(x: pd.Series) -> np.ndarray:
    """Features and label of all candidates in a column of binaries."""
    return np.frombuffer(b"".join(x), np.float32).reshape(-1, FEATURES + 1)


def _cells(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(frame["bins"]), np.uint8).reshape(-1, FEATURES)
    return bins, np.frombuffer(b"".join(frame["y"]), np.uint8).astype(float)


def fit_trees(x: np.ndarray | Spread, y: np.ndarray | None, trees: int = 60, depth: int = 3, rate: float = 0.2) -> Trees:
    """`depth` splits per tree, each the same for all its nodes, the best by the gain summed over nodes.

    A `Spread` has its labels within.
    """
    source = x if isinstance(x, Spread) else Held(x, y)
    model = Trees(source.edges())
    source.binned(model)
    model.base = float(np.log((source.positive + 1) / (source.negative + 1)))
    widths = [len(e) + 1 for e in model.edges]
    for _ in range(trees):
        splits = []
        for level in range(depth):
            best = (-np.inf, 0, 0)
            sums = source.sums(model, splits) / _UNIT
            sums = sums.reshape(2, len(widths), 1 << level, _BINS)
            for j, width in enumerate(widths):
                if width < 2:
                    continue
                g, h = sums[:, j, :, :width].cumsum(axis=2)
                gain = (g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1)).sum(axis=0)[:-1]
                cut = int(gain.argmax())
                if gain[cut] > best[0]:
                    best = (gain[cut], j, cut)
            splits.append(best[1:])
        # Either side of the last split is a leaf of each node.
        _, j, cut = best
        low, whole = sums[:, j, :, : cut + 1].sum(axis=2), sums[:, j].sum(axis=2)
        g, h = np.stack([low, whole - low], axis=2).reshape(2, -1)
        model.trees.append((splits, rate * g / (h + 1)))
    source.done()
    return model


@dataclass
class Selector:
    trees: Trees
    thresholds: dict[str, float]  # per kind; none added of a kind without one

    def spans(self, text: str) -> list[Span]:
        """Base spans, and chosen candidates that overlap no base span and no better candidate."""
        base = base_spans(text)
        taken = _Taken((a, b) for _, a, b in base)
        found = candidates(text, taken) if self.thresholds else []
        if found:
            p = self.trees.probability(np.array([c.features for c in found]))
            for i in np.argsort(-p, kind="stable").tolist():
                c = found[i]
                if p[i] < self.thresholds.get(c.kind, 2):
                    continue
                if taken.free(c.start, c.end):
                    taken.add(c.start, c.end)
                    base.append((c.kind, c.start, c.end))
        return sorted(base, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def train(docs: DataFrame, precision: float = 0.98, held: int = 20_000) -> Selector:
    """Fit the trees on the candidates of all distinct texts.

    A text counts once, however many rows repeat it. Labels are weak: what the
    checks of a kind say, a name that a value is assigned to, words that announce a phone or a card;
    candidates on which these say nothing are left out. One half of the
    texts fits the trees, the other calibrates them and sets, for each kind, the
    least threshold that keeps `precision`, at 0.5 or more. Only sums and counts of a bounded
    number come to the driver; for `held` see `Spread`.
    """
    ship(docs.sparkSession)
    half = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2)).cast("int").alias("half")
    texts = id_and_text(docs).select("text", F.xxhash64("text").alias("key"), half).filter(F.col("text").rlike("[0-9@]"))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _distinct(batches):
            rows = []
            for text, key, side in zip(batch["text"], batch["key"], batch["half"]):
                known = [[*c.features, float(c.weak)] for c in candidates(text) if c.weak is not None]
                for k in range(0, len(known), _MANY):
                    rows.append((key, k, side, np.array(known[k : k + _MANY], np.float32).tobytes()))
            yield pd.DataFrame(rows, columns=["key", "part", "half", "x"])

    described = texts.mapInPandas(describe, "key long, part long, half int, x binary")
    # Copies are let go per task first, then among tasks.
    described = saved(described.groupBy("key", "part").agg(F.min(F.struct("half", "x")).alias("row")).select("row.*"))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for side in (0, 1):
                x = _rows(batch["x"][batch["half"] == side])
                for j in range(0 if side == 0 else FEATURES, FEATURES + 1):
                    v, n = np.unique(x[:, j], return_counts=True)
                    yield pd.DataFrame({"half": side, "j": j, "v": v, "n": n})

    values = described.mapInPandas(counted, "half int, j int, v float, n long")
    values = values.groupBy("half", "j", "v").agg(F.sum("n").alias("n")).toPandas()
    labels = values[values["j"] == FEATURES]
    if any(len(labels[labels["half"] == side]) < 2 for side in (0, 1)):
        discard(described)
        return Selector(Trees(), {})
    first = Spread(described.filter("half = 0").select("x"), values[values["half"] == 0], held)
    trees = fit_trees(first, None)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _rows(batch["x"])
            raw = np.floor(np.clip(trees.raw(x[:, :FEATURES]), -30, 30) * _GRID).astype(np.int64)
            found = pd.DataFrame({"kind": x[:, 0].astype(np.int64), "raw": raw, "y": x[:, FEATURES].astype(float)})
            yield found.groupby(["kind", "raw", "y"]).size().reset_index(name="n")

    cells = described.filter("half = 1").select("x").mapInPandas(scored, "kind long, raw long, y double, n long")
    cells = cells.groupBy("kind", "raw", "y").agg(F.sum("n").alias("n")).toPandas().sort_values(["kind", "raw", "y"])
    discard(described)
    raw, y, n = (cells["raw"] / _GRID).to_numpy(), cells["y"].to_numpy(), cells["n"].to_numpy()
    trees.scale = _platt(raw, y, n)
    a, b = trees.scale
    cells["p"] = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
    cells["right"] = cells["y"] * cells["n"]
    thresholds = {}
    for k, kind in enumerate(KINDS):
        own = cells[cells["kind"] == k].groupby("p")[["right", "n"]].sum().sort_index(ascending=False).cumsum()
        good = own[(own["right"] >= precision * own["n"]) & (own["n"] >= 3)]
        if len(good):
            thresholds[kind] = float(max(0.5, good.index[-1]))
    return Selector(trees, thresholds)


_MANY = 4096  # candidates in a row
_GRID = 1024  # steps of a raw score that are told apart in calibration


def _distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows whose key the task has not given yet; a task holds the keys of its own part of the input."""
    seen = set()
    for batch in batches:
        new = batch[~batch["key"].isin(seen)].drop_duplicates("key")
        seen.update(new["key"])
        yield new


def _platt(raw: np.ndarray, y: np.ndarray, n: np.ndarray | int = 1) -> tuple[float, float]:
    """Slope and offset of a logistic curve through scores of which each counts `n` times."""
    a, b = 1.0, 0.0
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        w = n * (q * (1 - q) + 1e-6)
        slope = np.array([(n * (q - y) * raw).sum() + 0.1 * (a - 1), (n * (q - y)).sum()])
        bend = np.array([[(w * raw * raw).sum() + 0.1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(bend, slope)
        a, b = a - step[0], b - step[1]
    return float(a), float(b)


# -- columns -----------------------------------------------------------------------------


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def personal_data(text: Column, selector: Selector) -> Column:
    """Counts and digest of the base spans, and all spans, of each whole text; NULL is empty."""

    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, every = base_spans(text or ""), selector.spans(text or "")
            counts = Counter(kind for kind, _, _ in base)
            rows.append(
                (
                    *(counts[k] for k in KINDS[:4]),
                    len(every),
                    sha256(_listed(base).encode()).hexdigest(),
                    _listed(every),
                    [{"kind": k, "start": a, "end": b} for k, a, b in every],
                )
            )
        names = ["n_email", "n_ip", "n_card", "n_phone", "n_spans", "base_sha256", "spans", "found"]
        return pd.DataFrame(rows, columns=names)

    return F.pandas_udf(find, FOUND)(text)


def redacted(text: Column, selector: Selector) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans as one."""

    def redact(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redact_text(t, selector.spans(t)) for t in texts], dtype=object)

    return F.pandas_udf(redact, "string")(text)


def redact_text(text: str, spans: list[Span]) -> str:
    parts, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            parts += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*parts, text[done:]]) if parts else text


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_spans, base_sha256, spans, found) of every row of `docs`.

    The counts by kind are of the base spans, n_spans is of all. Offsets count code points, ends are exclusive. Rows are looked at one by one:
    repeated rows give repeated results, a NULL id stays NULL, and without rows
    to learn from only the base spans are found.
    """
    selector = train(docs)
    found = id_and_text(docs).select("doc_id", personal_data(F.col("text"), selector).alias("x"))
    return found.select("doc_id", "x.*")
