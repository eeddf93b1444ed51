"""Words, symbols and counts behind the language model.

The network reads and predicts *symbols*. The most frequent words are symbols of their own, as many as
``own_words`` of the corpus: their number grows with the square root of its tokens, so that the work per token grows
slower than the corpus. All other words share a symbol by their spelling, so that it is known without a lookup in the
vocabulary, which grows with the corpus. (A word seen once has nothing to repeat; such words stand for those never
seen.) Output is
``P(symbol | state) * P(word | symbol)``, where ``P(symbol | state)`` is class-factored on the state, see
``lm_network``, and ``P(word | symbol)`` is 1 for own symbols and a share of smoothed corpus counts for the others. Then

    log P(text) = sum of log P(symbol | state) + sum of log (count + 0.1) - sum of log (mass of the symbol)

with the word's own count + 0.1 as the mass of an own symbol. Only the middle sum needs the counts, which is a join on
words and no broadcast of them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.scratch import pin

SMOOTHING = 0.1
END = b"\n"  # no word can hold it
HELD_OUT_MODULUS = 10
OWN_LEAST = 2  # how often a word of the head occurs that is a symbol of its own
OWN_SHARE = 1.2  # own words per square root of a training token
SPELLING_CLASSES = 256
SPELLING_BYTES = 3
HEAD_WORDS = 100_000  # whose counts every task holds; bounded at any size of the corpus
SHORT = 8  # bytes of a word that is met as one number
_AT_ONCE = 128  # texts that are cut into words together
_FLUSH_TOKENS = 4_000_000
_FLUSH_WORDS = 500_000
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(SHORT + 1)], dtype=np.uint64)


def own_words(total: int) -> int:
    """How many words at most are symbols of their own in a corpus of so many tokens."""
    return min(HEAD_WORDS, max(256, int(OWN_SHARE * total**0.5)))


def tokens(text: str | None) -> list[bytes]:
    """The plain definition, which ``Words`` and ``Lookup.of_words`` meet for many texts at once: the words in lower case (A to Z only), then the end. Words are kept as UTF-8: ``bytes`` know just
    the ASCII letters and the ASCII spaces."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    found.append(END)
    return found


def short_number(word: bytes) -> int:
    """The number that stands for a word of at most ``SHORT`` bytes, none of them 0."""
    return int.from_bytes(word, "little")


class Words:
    """The words of some texts in lower case (A to Z only), in order and without the ends: their places, and for the
    short ones a number instead of an object for each."""

    def __init__(self, texts: Sequence[bytes | None]):
        texts = [text or b"" for text in texts]
        # A space before and after each text, and room to read a number at the last word.
        self._data = b"\n".join([b"", *texts, bytes(SHORT)]).lower()
        data = np.frombuffer(self._data, dtype=np.uint8)[:-SHORT]
        space = (data == 32) | (data - np.uint8(9) <= 4)
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        self._begin, self._end = edges[::2], edges[1::2]
        after = np.cumsum([len(text) + 1 for text in texts])
        self.in_text = np.diff(np.searchsorted(self._begin, after), prepend=0)  # words of each text
        length = self._end - self._begin
        is_short = length <= SHORT
        if b"\0" in self._data[:-SHORT]:
            is_short[np.searchsorted(self._begin, np.flatnonzero(data == 0), side="right") - 1] = False
        self.short, self.long = np.flatnonzero(is_short), np.flatnonzero(~is_short)
        ahead = np.ndarray(len(data), dtype="<u8", buffer=self._data, strides=(1,))
        self.numbers = ahead[self._begin[self.short]] & _LOW_BYTES[length[self.short]]

    def at(self, which: np.ndarray) -> list[bytes]:
        """The words with these numbers in the order."""
        data = self._data
        return [data[a:b] for a, b in zip(self._begin[which].tolist(), self._end[which].tolist())]


def words_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Some rows at a time with the words of their last column."""
    for batch in batches:
        for low in range(0, batch.num_rows, _AT_ONCE):
            rows = batch.slice(low, _AT_ONCE)
            yield rows, Words(rows.column(rows.num_columns - 1).cast(pa.binary()).to_pylist())


def is_held_out(ident: Column) -> Column:
    """By the id alone: a tenth of the documents is never learned from. Rows without id are."""
    crc = F.crc32(ident.cast("string").cast("binary"))
    return F.coalesce(crc % HELD_OUT_MODULUS == 0, F.lit(False))


def spelling_class(word: bytes) -> int:
    """From the last bytes, which tell languages and endings apart."""
    return zlib.crc32(word[-SPELLING_BYTES:]) % SPELLING_CLASSES


@dataclass(frozen=True)
class Vocabulary:
    """What every task needs of the corpus: bounded by ``HEAD_WORDS``."""

    total: int  # N, tokens
    distinct: int  # V
    head: dict[bytes, int]  # counts of the most frequent words
    own: dict[bytes, int]  # their own symbols, the end first, then most frequent first
    mass: np.ndarray  # smoothed counts of each symbol

    def symbol_of(self, word: bytes) -> int:
        own = self.own.get(word)
        return len(self.own) + spelling_class(word) if own is None else own

    @cached_property
    def figures(self) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
        """The place of each word that is in the head or its own symbol, and the symbols and counts by place; the last
        ones stand for all other words. Made once per process."""
        words = [*self.own, *(w for w in self.head if w not in self.own)]
        symbols = np.array([*map(self.symbol_of, words), -1], dtype=np.int32)
        counts = np.array([*(self.head.get(w, -1) for w in words), -1], dtype=np.int64)
        return dict(zip(words, range(len(words)))), symbols, counts

    def spelling(self) -> np.ndarray:
        """For each own symbol, the symbol of its spelling."""
        return np.array([len(self.own) + spelling_class(w) for w in self.own], dtype=np.int64)


class _Endings(dict):
    """The symbol of each ending; remembers a bounded number of them."""

    _MAX_ENDINGS = 400_000

    def __init__(self, first: int):
        super().__init__()
        self._first = first

    def __missing__(self, ending: bytes) -> int:
        symbol = self._first + spelling_class(ending)
        if len(self) < self._MAX_ENDINGS:
            self[ending] = symbol
        return symbol


class Lookup:
    """Symbols and counts of tokens: short words are searched for together, by their numbers, the others in a
    dictionary. Memory is that of the head. The words outside it are not remembered, only their endings."""

    def __init__(self, vocabulary: Vocabulary):
        self._place, self._symbol, self._count = vocabulary.figures
        self._endings = _Endings(len(vocabulary.own))
        short = [(short_number(w), k) for w, k in self._place.items() if len(w) <= SHORT and b"\0" not in w]
        numbers, places = zip(*sorted(short))
        self._numbers, self._place_of_number = np.array(numbers, dtype=np.uint64), np.array(places)

    def of_words(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Symbols and counts of the tokens of all the texts, each text's end included, where each text begins among
        them, and where the tokens are whose count is -1, with their words."""
        places = np.empty(len(words.short) + len(words.long), dtype=np.int64)
        found = np.minimum(np.searchsorted(self._numbers, words.numbers), len(self._numbers) - 1)
        places[words.short] = np.where(self._numbers[found] == words.numbers, self._place_of_number[found], -1)
        places[words.long] = [*map(self._place.get, words.at(words.long), repeat(-1))]
        # A text's words begin after the words and the ends of the texts before it.
        begins = np.cumsum(words.in_text + 1) - words.in_text - 1
        is_word = np.ones(len(places) + len(begins), dtype=bool)
        is_word[begins + words.in_text] = False
        at = np.full(len(is_word), self._place[END])
        at[is_word] = places
        symbols, counts = self._symbol[at], self._count[at]
        spelled, endings = words.at(np.flatnonzero(places < 0)), self._endings
        symbols[at < 0] = [endings[word[-SPELLING_BYTES:]] for word in spelled]
        unknown = np.flatnonzero(counts < 0)
        if len(unknown) == len(spelled):
            return symbols, counts, begins, unknown, spelled
        # The end has its own symbol also where it is no word of the head.
        each = iter(spelled)
        return symbols, counts, begins, unknown, [END if at[k] >= 0 else next(each) for k in unknown.tolist()]

    def __call__(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and count of each token; the count is -1 for words outside the head."""
        at = np.fromiter(map(self._place.get, found, repeat(-1)), dtype=np.int64, count=len(found))
        symbols, counts = self._symbol[at], self._count[at]
        outside, endings = np.flatnonzero(at < 0), self._endings
        if len(outside):
            symbols[outside] = [endings[found[k][-SPELLING_BYTES:]] for k in outside.tolist()]
        return symbols, counts


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """``word, c`` over all the documents. Each task adds up its words before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        numbers: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            names = ["word", "c"]
            short, counts = np.unique(np.concatenate([*numbers, np.empty(0, dtype="<u8")]), return_counts=True)
            # As text of fixed width; the zeros behind a short word are no part of it.
            yield pa.RecordBatch.from_arrays(
                [pa.array(short.astype("<u8").view(f"S{SHORT}"), pa.binary()), pa.array(counts, pa.int64())], names=names
            )
            words, counts = list(seen.keys()), list(seen.values())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], names=names)
            numbers.clear()
            seen.clear()

        for _, words in words_of_batches(batches):
            numbers.append(words.numbers)
            seen.update(words.at(words.long))
            seen[END] += len(words.in_text)
            size += len(words.numbers)
            if size > _FLUSH_TOKENS or len(seen) > _FLUSH_WORDS:
                yield from flush()
                size = 0
        yield from flush()

    parts = docs.select(text).mapInArrow(run, "word binary, c long")
    return pin(parts.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The bounded summary of the counts."""
    total, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "word").limit(HEAD_WORDS).collect()
    head = {bytes(r.word): r.c for r in top}
    own = {END: 0}
    for word, c in head.items():
        if len(own) >= own_words(int(total or 0)):
            break
        if c >= OWN_LEAST and word != END:
            own[word] = len(own)
    crc = F.crc32(F.substring("word", -SPELLING_BYTES, SPELLING_BYTES))
    sums = counts.groupBy((crc % SPELLING_CLASSES).cast("int").alias("k")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")
    )
    seen, words = np.zeros((2, SPELLING_CLASSES), dtype=np.int64)
    for r in sums.collect():
        seen[r.k], words[r.k] = r.c, r.n
    for word in own:
        if word in head:
            seen[spelling_class(word)] -= head[word]
            words[spelling_class(word)] -= 1
    others = seen + SMOOTHING * (words + 1)  # one more for words never seen
    mass = np.concatenate([[head.get(word, 0) + SMOOTHING for word in own], others])
    return Vocabulary(int(total or 0), int(distinct), head, own, mass)
