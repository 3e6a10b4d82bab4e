"""Token ids by the tokenizers library, quickly: each distinct stretch of text is encoded once.

So the tokenizer is called once for a stretch that a worker meets again and again, which makes most of the
speed. Texts of lines of words, a single space between two words, are taken apart at spaces and line ends;
all others, and what stands between spaces, at single spaces or line ends between plain characters and
between a letter and a mark of punctuation. Which letters those are is asked of the vocabulary's own
normaliser and pre-tokenizer: only a letter that stays letters, and ends before each mark, is cut after.
So the ids of a text are the ids of its stretches put together; tests hold that against the library over
all documents, over every character of the basic plane beside each mark and space, and over random
mixtures. Other vocabularies can be encoded whole (``by_stretch=False``)."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable
from itertools import chain

import numpy as np

#: Plain: neither white space nor controls.
_SPACE_CUT = r"(?<=[!-~¡-˿Ͱ-῿])(?=[ \n][!-~¡-˿Ͱ-῿])"
#: Marks that may be cut off, and the characters they may be cut off from, where the vocabulary allows it.
_MARKS, _BEFORE_MARKS = ",.!?;:", [chr(c) for c in range(0x41, 0x250)]
#: Stretches kept at most (about 200 bytes each), and words encoded in one call.
BOUND, CALL = 1_000_000, 4096
#: In front of a text's first stretch, which has no space before it.
_FIRST = "\x00"


def cut_pattern(tokenizer) -> re.Pattern:
    """Where texts may be taken apart with this vocabulary."""

    def ends_before_marks(letter: str) -> bool:
        plain = tokenizer.normalizer.normalize_str(letter) if tokenizer.normalizer else letter
        if not (letter.isalpha() and plain.isalpha()):
            return False
        for before in ("", "x", "'", "1", " "):
            text = before + plain
            if not all(any(at[0] == len(text) for _, at in tokenizer.pre_tokenizer.pre_tokenize_str(text + m)) for m in _MARKS):
                return False
        return True

    letters = "".join(filter(ends_before_marks, _BEFORE_MARKS)) if tokenizer.pre_tokenizer else ""
    return re.compile(f"{_SPACE_CUT}|(?<=[{letters}])(?=[{_MARKS}])" if letters else _SPACE_CUT)


class Encoder:
    """Encodes texts with one vocabulary file. Holds at most about ``bound`` stretches."""

    def __init__(self, path: str, by_stretch: bool = True, bound: int = BOUND):
        from tokenizers import Tokenizer

        self.tokenizer, self.by_stretch, self.bound = Tokenizer.from_file(path), by_stretch, bound
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.word_ends = np.array([t.endswith("</w>") for t in tokens], bool)
        self.word_starts = np.array([t.startswith("Ġ") for t in tokens], bool)
        self.cut = cut_pattern(self.tokenizer) if by_stretch else None
        self._empty()

    def _empty(self) -> None:
        self.places: dict[str, int] = {}
        self.starts, self.sizes, self.ids = array("q"), array("q"), array("I")

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _add(self, key: str, ids: Iterable[int]) -> None:
        self.places[key] = len(self.starts)
        self.starts.append(len(self.ids))
        self.ids.extend(ids)
        self.sizes.append(len(self.ids) - self.starts[-1])

    def _words(self, words: list[str]) -> None:
        """Words of letters only, each after a space: encoded in one text and told apart by the ids that
        start or end a word. Where their number doesn't fit, one by one."""
        for i in range(0, len(words), CALL):
            part = words[i : i + CALL]
            ids = self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids
            flat = np.array(ids, np.int64)
            if self.word_ends.any():
                bounds = np.concatenate([[0], np.flatnonzero(self.word_ends[flat]) + 1])
            else:
                bounds = np.append(np.flatnonzero(self.word_starts[flat]), len(flat))
            if len(bounds) != len(part) + 1 or bounds[0] or bounds[-1] != len(flat):
                self._others(part)
                continue
            self.places.update(zip(part, range(len(self.starts), len(self.starts) + len(part)), strict=True))
            self.starts.frombytes((bounds[:-1] + len(self.ids)).astype(np.int64).tobytes())
            self.sizes.frombytes(np.diff(bounds).astype(np.int64).tobytes())
            self.ids.frombytes(flat.astype(np.uint32).tobytes())

    def _others(self, stretches: list[str]) -> None:
        for i in range(0, len(stretches), CALL):
            part = stretches[i : i + CALL]
            plain = [s[1:] if s[0] == _FIRST else s for s in part]
            for stretch, found in zip(part, self.tokenizer.encode_batch_fast(plain, add_special_tokens=False), strict=True):
                self._add(stretch, found.ids)

    def _learn(self, pieces: set[str]) -> None:
        """Pieces as they stand in ``places``: with the space or line end before them, or the mark of a first one."""
        words = {p for p in pieces if p[0] == " " and p[1:].isalpha()}
        cut = {p: s for p in pieces - words if len(s := self.cut.split(p)) > 1}
        fresh = {s for stretches in cut.values() for s in stretches}.difference(self.places) | (pieces - words - cut.keys())
        parts = {s for s in fresh if s[0] == " " and s[1:].isalpha()}
        self._words(list(words | parts))
        self._others(list(fresh - parts))
        for piece, stretches in cut.items():
            ids: list[int] = []
            for s in stretches:
                at = self.starts[self.places[s]]
                ids.extend(self.ids[at : at + self.sizes[self.places[s]]])
            self._add(piece, ids)

    def _pieces(self, text: str) -> list[str]:
        if not text:
            return []
        spaced = text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text
        if spaced or not text.replace("\n", "").isprintable():
            first, *rest = self.cut.split(text)
            return [_FIRST + first, *rest]
        # the space goes with the word after it
        return (_FIRST + text).replace(" ", "\x01 ").replace("\n", "\x01\n").split("\x01")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens."""
        if not self.by_stretch:
            return [self.plain(t) for t in texts]
        if len(self.places) > self.bound:
            self._empty()
        cut = [self._pieces(t) for t in texts]
        fresh = set(chain.from_iterable(cut)).difference(self.places)
        if fresh:
            self._learn(fresh)
        if not self.places:
            return [np.zeros(0, np.uint32) for _ in texts]
        starts, sizes = (np.frombuffer(x, np.int64) for x in (self.starts, self.sizes))
        ids = np.frombuffer(self.ids, np.uint32)
        place, out = self.places.__getitem__, []
        for pieces in cut:
            at = np.fromiter(map(place, pieces), np.int64, len(pieces))
            size = sizes[at]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            out.append(ids[np.arange(total) + np.repeat(starts[at] - ends + size, size)])
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary: tasks that run in the same Python worker share what it knows."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def groups(texts: list[str], size: int = 1 << 20) -> Iterable[tuple[int, int]]:
    """Ranges of texts with about ``size`` characters each, so that a call's memory is bounded."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
