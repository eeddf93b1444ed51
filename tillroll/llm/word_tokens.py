"""Token ids of whole texts, one lookup per word.

For tokenizers that lower-case, drop white space and end every word, such as ``word_bpe_49k.json``: the ids
of a text are then the ids of its space-separated words one after the other. Texts are cut at ASCII white
space only; anything else, other kinds of space included, stays inside a word and is left to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, groupby, pairwise

import numpy as np
from tokenizers import Tokenizer

_END = "<|endoftext|>"
_MAX_WORDS, _MAX_CHARS = 700_000, 48  # bounds of the memory that is kept


class WordTokenizer:
    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._end = self._tokenizer.token_to_id(_END)
        self._forget()

    def _forget(self) -> None:
        self._number: dict[str, int] = {}
        self._ids = Growing(np.uint32)
        self._start = Growing(np.int64)
        self._count = Growing(np.int64)
        self._learn([".", ","])

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Words of small Latin-1 letters are one piece that nothing normalises, so they go
        to the tokenizer's model directly; others go through the whole tokenizer."""
        plain = [w.isalpha() and w.islower() and max(w) <= "\xff" for w in words]
        others = iter(self._encode_others([w for w, p in zip(words, plain) if not p]))
        model = self._model
        return [
            [t.id for t in model.tokenize(w if w.isascii() else _byte_letters(w))] if p else next(others)
            for w, p in zip(words, plain)
        ]

    def _encode_others(self, words: list[str]) -> list[list[int]]:
        """Many words as one text, split at the end token, which no word may then contain."""
        if not words:
            return []
        if self._end is None or any("<|" in w for w in words):
            return [self._tokenizer.encode(w, add_special_tokens=False).ids for w in words]
        ids = self._tokenizer.encode(_END.join(words), add_special_tokens=False).ids
        cuts = [-1, *(k for k, i in enumerate(ids) if i == self._end), len(ids)]
        return [ids[a + 1 : b] for a, b in pairwise(cuts)]

    def _learn(self, words: Iterable[str]) -> None:
        """Keep the ids of new words. A final stop or comma after Latin-1 letters alone is a token of its own,
        so ``word,`` costs no second call where ``word`` is known."""
        known = self._number
        stems = {
            w: w[:-1] for w in words if w[-1:] in (".", ",") and w[:-1].isalpha() and max(w) <= "\xff"
        }
        whole = {w for w in words if w not in stems}.union(stems.values()).difference(known)
        if whole:
            got = self._encode(list(whole))
            counts = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
            ids = np.fromiter(chain.from_iterable(got), dtype=np.uint32, count=int(counts.sum()))
            self._append(whole, counts, ids)
        if stems:
            at = [known[part] for word, stem in stems.items() for part in (stem, word[-1])]
            counts = self._count.values[at]
            ids = _gather(self._ids.values, self._start.values[at], counts)
            self._append(stems, counts[::2] + counts[1::2], ids)

    def _append(self, words: Iterable[str], counts: np.ndarray, ids: np.ndarray) -> None:
        self._number.update(zip(words, range(len(self._number), len(self._number) + len(counts))))
        self._start.extend(self._ids.size + np.cumsum(counts) - counts)
        self._count.extend(counts)
        self._ids.extend(ids)

    def _spaced(self, text: str) -> str:
        """The text with one kind of space, and lower-cased here where that is surely what the
        tokenizer would do: Latin-1 letters have simple lower cases and no composed forms to undo."""
        for space in "\n\t\r\x0b\x0c":
            if space in text:
                text = text.replace(space, " ")
        if "<|" not in text:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
            return text.lower()
        return text

    def ids(self, text: str) -> np.ndarray:
        if len(self._number) > _MAX_WORDS:
            self._forget()
        words = self._spaced(text).split(" ")
        new = set(words).difference(self._number)
        long = {w for w in new if len(w) > _MAX_CHARS} if new else new
        if long or len(new) > _MAX_WORDS:  # too long or too many to keep: apart, as they are
            return np.concatenate([self._apart(run) for run in _runs(words, long or new)])
        if new:
            self._learn(new)
        return self._known(words)

    def _known(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self._number.__getitem__, words), dtype=np.int64, count=len(words))
        return _gather(self._ids.values, self._start.values[at], self._count.values[at])

    def _apart(self, run: tuple[bool, list[str]]) -> np.ndarray:
        rare, words = run
        if rare:
            return np.array(list(chain.from_iterable(self._encode(words))), dtype=np.uint32)
        self._learn(set(words).difference(self._number))
        return self._known(words)


_of_worker: dict[str, WordTokenizer] = {}


def worker_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker and file: tasks that follow in the same worker find its words known."""
    if path not in _of_worker:
        _of_worker[path] = WordTokenizer(path)
    return _of_worker[path]


# Byte-level vocabularies write each byte as a letter: printable ones as themselves, the others, in order, as
# the letters from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHER_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _byte_letters(word: str) -> str:
    return word.encode().decode("latin-1").translate(_OTHER_BYTES)


def _runs(words: list[str], rare: set[str]) -> Iterator[tuple[bool, list[str]]]:
    for is_rare, run in groupby(words, rare.__contains__):
        yield is_rare, list(run)


class Growing:
    """An array that doubles its room when full."""

    def __init__(self, dtype):
        self._room, self.size = np.empty(1024, dtype=dtype), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self._room):
            room = np.empty(max(need, 2 * len(self._room)), dtype=self._room.dtype)
            room[: self.size] = self.values
            self._room = room
        self._room[self.size : need] = values
        self.size = need

    @property
    def values(self) -> np.ndarray:
        return self._room[: self.size]


def _gather(ids: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches ``ids[start : start + count]`` one after the other."""
    if not count.sum():
        return np.empty(0, dtype=np.uint32)
    before = np.cumsum(count) - count
    return ids[np.repeat(start - before, count) + np.arange(before[-1] + count[-1])]
