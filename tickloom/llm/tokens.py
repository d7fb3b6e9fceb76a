"""Token ids of whole texts by a public tokenizer, quick on texts that repeat their words."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa

# Letters whose class, composition and lower case no Unicode version disputes.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = re.compile(rf"([{_LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)")
# White space to Python but not to the tokenizer.
_SEPARATORS = re.compile("[\x1c-\x1f]")
# White space other than blanks and line ends.
_OTHER_BLANKS = re.compile(r"[^\S \n]")


def _byte_names() -> dict[int, str]:
    """Byte-level vocabularies name printable bytes by themselves and others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


def _even(text: str) -> bool:
    """Whether blanks and line ends stand one by one between words; else a text stays whole."""
    return (
        "  " not in text
        and "\n\n" not in text
        and " \n" not in text
        and "\n " not in text
        and not (text[0].isspace() or text[-1].isspace())
        and not _OTHER_BLANKS.search(text)
    )


class Encoder:
    """`encode(text)`: little-endian unsigned 32-bit ids, the same as the library's for the text.

    Both kinds of vocabulary known here never let a token cross a single blank,
    so a text is cut there and each piece is encoded once, then remembered:
    with `byte level` a blank belongs to the piece after it, with `word ends` it
    is dropped. Pieces of plain letters go straight to the library's model, all
    others through the whole tokenizer; so do texts, or tokenizers, to which
    the rule may not apply. Up to twice `remember` pieces are kept, those asked for last;
    a piece with a mark takes the ids of its word from there.
    """

    def __init__(self, path: str, remember: int = 250_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.names = _byte_names()
        self.remember = remember
        self.kind = _kind(path)
        self.between = " " if self.kind == "byte level" else ""
        self.plain = _Words(self)
        self.first, self.later = _Pieces(self, ""), _Pieces(self, self.between)
        self.runs = _Runs(self) if self.kind == "byte level" else None

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """`encode` of each text, in order, for many at once; no text is NULL."""
        if self.runs is None or self.runs.gap is None:
            yield from map(self.encode, texts.to_pylist())
            return
        texts = texts.cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][1 : len(texts) + 1]
        first = 0
        while first < len(texts):
            # Texts of so many bytes at once, but one at least.
            before = ends[first - 1] if first else ends[0] - len(texts[0].as_buffer())
            after = max(first + 1, int(np.searchsorted(ends, before + _AT_ONCE, side="right")))
            yield from self.runs.encode(texts.slice(first, after - first))
            first = after

    def encode(self, text: str) -> bytes:
        if self.kind == "word ends" and not _SEPARATORS.search(text):
            pieces = text.split()
            known = self.first
            ids = b"".join(map(known.__getitem__, pieces))
        elif self.kind == "byte level" and text and _even(text):
            head, *pieces = text.split(" ")
            known = self.later
            ids = self.first[head] + b"".join(map(known.__getitem__, pieces))
        else:
            return self.whole(text)
        if len(self.plain) > self.remember:
            self.plain.clear()
        return ids

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def piece(self, blank: str, piece: str) -> bytes:
        ids, whole = b"", blank + piece
        for line in piece.split("\n"):
            word = _WORD.fullmatch(line)
            if not word:
                return self.whole(whole)
            letters, mark = word.groups()
            if self.kind == "word ends":
                ids += self.plain[letters.lower()]
            else:
                ids += (self.plain["\n"] if ids else b"") + self.plain[blank + letters]
                blank = ""
            if mark:
                ids += self.plain[mark]
        return ids


class _Pieces(dict):
    """Ids per piece of text, as it stands after a blank or without one."""

    def __init__(self, encoder: Encoder, blank: str):
        self.encoder, self.blank = encoder, blank
        self.lower, self.start = encoder.kind == "word ends", encoder.names[32] if blank else ""
        self.tokenize, self.marks = encoder.model.tokenize, encoder.plain
        self.four = encoder.plain.four
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if "\n" in piece and self.encoder.kind == "byte level":
            # Words beside a line end are remembered each, not together.
            return self.lines(piece)
        if len(self) >= self.encoder.remember:
            # What is asked for again is taken over; the rest is forgotten with the next change.
            self.before = dict(self)
            self.clear()
        ids = self.before.get(piece)
        if ids is None:
            ids = self.found(piece)
        self[piece] = ids
        return ids

    def lines(self, piece: str) -> bytes:
        first, *rest = piece.split("\n")
        if not (_WORD.fullmatch(first) and all(map(_WORD.fullmatch, rest))):
            return self.encoder.whole(self.blank + piece)
        end, begun = self.marks["\n"], self.encoder.first
        return self[first] + b"".join([end + begun[line] for line in rest])

    def found(self, piece: str) -> bytes:
        # Most pieces are one word of plain letters, with a full stop or comma at most.
        if self.encoder.kind == "other":
            return self.encoder.piece(self.blank, piece)
        if piece[-1:] in (".", ","):
            word = piece[:-1]
            if word.isascii() and word.isalpha():
                return self[word] + self.marks[piece[-1]]
        if piece.isascii() and piece.isalpha():
            if self.lower and not piece.islower():
                return self[piece.lower()]
            return b"".join([self.four[token.id] for token in self.tokenize(self.start + piece)])
        return self.encoder.piece(self.blank, piece)


class _Runs:
    """Ids of many texts at once, by a byte-level vocabulary.

    Such a vocabulary cuts even texts into runs of letters, digits or marks, each with
    the blank before it, and line ends; a piece between blanks that holds anything else is
    one run, and so is a text that is not even. Arrow finds the different runs of all texts. Those not
    remembered go to the library: plain ones to its model, many in one string, others
    through the whole tokenizer. `gap` is the id of the byte between them there, as no token
    joins it to another; None where the vocabulary has no such byte.
    """

    def __init__(self, encoder: Encoder):
        self.whole, self.remember, self.tokenize = encoder.whole, encoder.remember, encoder.model.tokenize
        self.names = np.array([ord(encoder.names[b]) for b in range(256)], "<u4")
        vocabulary = encoder.tokenizer.get_vocab()
        zero = encoder.names[0]
        self.gap = vocabulary.get(zero) if sum(zero in token for token in vocabulary) == 1 else None
        # Added tokens are looked for before all else.
        added = {t.content.encode()[0] for t in encoder.tokenizer.get_added_tokens_decoder().values() if t.content}
        self.kinds = np.full(256, _ODD, np.uint8)
        for byte in {*range(33, 127)} - {ord("'")} - added:
            self.kinds[byte] = _LETTER if chr(byte).isalpha() else _DIGIT if chr(byte).isdigit() else _MARK
        self.kinds[10], self.kinds[32] = _LINE, _BLANK
        # Bytes that white space other than blanks and line ends may begin with.
        self.other_blanks = np.zeros(256, bool)
        self.other_blanks[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True
        self.now, self.before = _Remembered(), _Remembered()

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        n = int(offsets[-1] - offsets[0])
        if not n:
            yield from [b""] * len(texts)
            return
        data = np.frombuffer(texts.buffers()[2], np.uint8, n, int(offsets[0]))
        starts = offsets - offsets[0]
        begin, odd = self.cut(data, starts, texts)
        bounds = np.append(begin, n).astype(np.int32)
        spans = [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        runs = pa.Array.from_buffers(pa.binary(), len(begin), spans).dictionary_encode()
        at = runs.indices.to_numpy()
        strange = np.zeros(len(runs.dictionary), bool)
        strange[at[odd]] = True
        ids, first, sizes = self.ids(_items(runs.dictionary), strange)
        size = sizes[at]
        raw = _ranges(ids, first[at], size).tobytes()
        # Ids before each text; the number of runs before it tells.
        cuts = (4 * np.append(0, np.cumsum(size))[np.searchsorted(begin, starts)]).tolist()
        yield from [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def cut(self, data: np.ndarray, starts: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where runs begin, and which of them are whole pieces or texts; texts begin at `starts`, and end at the last."""
        kind = self.kinds[data]
        accents = np.flatnonzero(data == 0xC3)  # the first byte of the letters beyond ASCII
        accents = accents[(data[accents + 1] != 0x97) & (data[accents + 1] != 0xB7)]
        kind[accents] = kind[accents + 1] = _LETTER
        full = starts[1:] > starts[:-1]
        number, head = np.flatnonzero(full), starts[:-1][full]
        tail = starts[1:][full] - 1

        white = kind >= _LINE
        uneven = white[head] | white[tail]
        doubled = np.flatnonzero(white[1:] & white[:-1])
        uneven[np.searchsorted(head, doubled, side="right") - 1] = True
        perhaps = np.flatnonzero(self.other_blanks[data])
        for k in np.unique(np.searchsorted(head, perhaps, side="right") - 1).tolist():
            uneven[k] = uneven[k] or not _even(texts[int(number[k])].as_py())

        change = np.empty(len(data), bool)
        change[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != _BLANK)
        change[head] = True
        begin = np.flatnonzero(change)
        opens = kind[begin] == _BLANK  # a piece
        is_head = np.zeros(len(data), bool)
        is_head[head] = True
        is_head = is_head[begin]
        opens |= is_head
        pieces = begin[opens]
        odd_piece = np.zeros(len(pieces), bool)
        odd_piece[np.searchsorted(pieces, np.flatnonzero(kind == _ODD), side="right") - 1] = True
        whole_text = uneven[np.cumsum(is_head) - 1]
        whole_piece = odd_piece[np.cumsum(opens) - 1]
        stays = np.where(whole_text, is_head, opens | ~whole_piece)
        return begin[stays], (whole_text | whole_piece)[stays]

    def ids(self, runs: list[bytes], strange: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, size): those of run k are `size[k]` from `first[k]` on; strange ones go through the whole tokenizer."""
        if len(self.now.numbers) >= self.remember:
            # What is asked for again is taken over; the rest is forgotten with the next change.
            self.now, self.before = _Remembered(), self.now
        now, before = self.now, self.before
        number = now.find(runs)
        missing = np.flatnonzero(number < 0)
        old = before.find([runs[k] for k in missing.tolist()])
        again, old, new = missing[old >= 0], old[old >= 0], missing[old < 0]
        # Long runs, and so most whole texts, come last and are not remembered.
        long = np.array([len(runs[k]) > _LONG for k in new.tolist()], bool)
        other = strange[new] & ~long
        plain, others, long = new[~other & ~long], new[other], new[long]
        ids, sizes = self.plain([runs[k] for k in plain.tolist()])
        whole = [self.whole(runs[k].decode()) for k in np.append(others, long).tolist()]
        added = [_ranges(before.ids, before.first[old], before.size[old]), ids, np.frombuffer(b"".join(whole), "<u4")]
        ids = np.concatenate([now.ids, *added])
        size = np.concatenate([now.size, before.size[old], sizes, np.array([len(x) // 4 for x in whole], np.int64)])
        first = np.cumsum(size) - size
        kept, n = np.concatenate([again, plain, others]), len(now.size)
        number[np.append(kept, long)] = np.arange(n, len(size))
        now.numbers.update(zip([runs[k] for k in kept.tolist()], range(n, n + len(kept))))
        now.first, now.size = first[: n + len(kept)], size[: n + len(kept)]
        now.ids = ids[: first[n + len(kept)]].copy() if len(long) else ids
        return ids, first[number], size[number]

    def plain(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes): of each run in turn, and how many are of each."""
        ids = []
        for k in range(0, len(runs), _TOGETHER):
            joined = np.frombuffer(b"\0".join(runs[k : k + _TOGETHER]) + b"\0", np.uint8)
            tokens = self.tokenize(self.names[joined].tobytes().decode("utf-32-le"))
            ids.append(np.array([token.id for token in tokens], "<u4"))
        ids = np.concatenate(ids) if ids else np.empty(0, "<u4")
        gaps = np.flatnonzero(ids == self.gap)
        return ids[ids != self.gap], np.diff(gaps, prepend=-1) - 1


class _Remembered:
    """Ids of runs: number n has `size[n]` of them from `first[n]` on."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.ids, self.first, self.size = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def find(self, runs: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, runs, repeat(-1)), np.int64, len(runs))


def _items(texts: pa.BinaryArray) -> list[bytes]:
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1].tolist()
    raw = texts.buffers()[2].to_pybytes()
    return [raw[a:b] for a, b in zip(at, at[1:])]


def _ranges(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ids of ranges, one after another."""
    ends = np.cumsum(size)
    place = np.repeat(first - (ends - size), size)
    place += np.arange(len(place))
    return ids[place]


# Kinds of bytes in texts.
_ODD, _LETTER, _DIGIT, _MARK, _LINE, _BLANK = range(6)
# Bytes of text that are cut at once, plain runs in one call of the model, bytes of a run that is remembered.
_AT_ONCE, _TOGETHER, _LONG = 4_000_000, 128, 64


class _Words(dict):
    """Ids of single words and marks, from the library's model."""

    def __init__(self, encoder: Encoder):
        self.tokenize, self.names = encoder.model.tokenize, encoder.names
        self.four = [i.to_bytes(4, "little") for i in range(encoder.tokenizer.get_vocab_size())]

    def __missing__(self, word: str) -> bytes:
        named = word
        if not (word.isascii() and word.isalpha()):
            named = word.encode().decode("latin-1").translate(self.names)
        ids = self[word] = b"".join([self.four[token.id] for token in self.tokenize(named)])
        return ids


def _packed(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def _kind(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    before, splits = parts.get("normalizer"), parts.get("pre_tokenizer") or {}
    if parts["model"].get("type") != "BPE" or any(
        t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in parts["added_tokens"]
    ):
        return "other"
    if before is None and splits.get("type") == "ByteLevel" and splits.get("use_regex", True):
        return "other" if splits.get("add_prefix_space") else "byte level"
    steps = [x.get("type") for x in (before or {}).get("normalizers", [])]
    inner = splits.get("pretokenizers", [])
    if (
        steps == ["NFC", "Replace", "Lowercase"]
        and [x.get("type") for x in inner] == ["Split", "ByteLevel"]
        and inner[0].get("behavior") == "Removed"
        and inner[0].get("invert")
        and not inner[1].get("add_prefix_space")
    ):
        return "word ends"
    return "other"


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary, with what it remembers."""
    return Encoder(path)
