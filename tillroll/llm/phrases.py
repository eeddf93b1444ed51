"""Phrase collocations, counted in HAT-tries.

A task counts phrases in a trie of word ids that is shallow at first: below a phrase's first word lies a hash
container of the remaining words. A container that grows past ``BURST_ENTRIES`` bursts into a trie node with one
container per next word. When a task's tries hold more than ``TRIE_ENTRIES`` phrases, whole subtrees, the largest
first, leave as sorted runs; at the end all do. Runs are dealt by language and by the hash of the first two words, and
the runs of each of these prefix parts are merged in one place. There are so many parts that each has about
``PART_WORDS`` words of the corpus behind it, which bounds what a merge holds, and only phrases that are frequent in
total leave it.

A phrase of a least frequency has only parts of at least that frequency, and the bucket of any hash that it falls
into is at least as full. So the tasks first add up words, then fill ``BUCKETS`` counters with the pairs of frequent
words, then count the pairs of full buckets while they fill counters with the longer phrases all of whose pairs lie
in full buckets, and last count the longer phrases of full buckets. What is frequent or full goes to the tasks as a
set of bits of a fixed size (``FILTER_BITS``, ``BUCKETS``), whatever the corpus: a clash of hashes lets a phrase be
counted in vain, and the totals decide. Nothing is lost and nothing is estimated; a corpus that fills every bucket
only has more phrases shuffled.

Defined cases

- a null or empty text has no words; a null language is ``und``
- repeated rows count as often as they occur
- ties in score and frequency are ordered by phrase; a tie between cuts goes to the shorter first part
- a very long text is cut at its separators into chunks of about ``CHUNK_BYTES``; a single piece longer than that is
  taken whole
- an empty table gives no rows; extra columns are not looked at
- products are decimals of 38 digits: exact up to 10**17 words per language
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.text import read
from tillroll.llm.word_tokens import Growing
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

LONGEST = 5
LEAST_COUNT = 100
FACTOR = 1000
CONTAINED_PERCENT = 100
TOP = 2000
NO_LANGUAGE = "und"

BURST_ENTRIES = 4096
TRIE_DEPTH = 3
TRIE_ENTRIES = 400_000
KNOWN_WORDS = 1_000_000
FILTER_BITS = 1 << 24
BUCKETS = 1 << 24
BUCKETS_A_ROW = 1 << 12
CHUNK_BYTES = 1 << 20
PART_WORDS = 200_000
LEAST_PARTS = 256
FLUSH_TOKENS = 200_000

# No byte of UTF-8 text has this value, so it can stand for any separator.
_BREAK = b"\xff"
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TO_BREAK = bytes.maketrans(_SEPARATORS, _BREAK * len(_SEPARATORS))

WORDS = "lang string, phrase string, n long"
_WORDS_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
# A row is a sorted run: the phrases of one prefix part and their counts.
RUNS = "lang string, part int, phrases array<string>, counts array<long>"
_RUNS_ARROW = pa.schema(
    [
        ("lang", pa.string()),
        ("part", pa.int32()),
        ("phrases", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def chunks(text: str) -> Iterator[list[bytes]]:
    """The words of a text with a break for each separator and at the end of each chunk."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(_TO_BREAK)
    start = 0
    while start < len(data):
        end = data.find(_BREAK, start + CHUNK_BYTES)
        end = len(data) if end < 0 else end + 1
        words = data[start:end].replace(_BREAK, b" \xff ").split()
        words.append(_BREAK)
        yield words
        start = end


class Frequent:
    """Frequent words as bits by hash: answers yes too often, never no in error."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __call__(self, lang: int, word: int) -> bool:
        at = (word + lang) % FILTER_BITS
        return bool(self.bits[at >> 3] >> (at & 7) & 1)


def _checksum(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def frequent_words(words: DataFrame) -> Frequent:
    """From ``lang, phrase`` rows of one word. The driver gets ``FILTER_BITS`` bits at most."""
    at = (_checksum(F.col("phrase")) + _checksum(F.col("lang"))) % FILTER_BITS + 1
    maps = (
        words.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    )
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for bucket, part in maps.collect():
        part = np.frombuffer(bytes(part), dtype=np.uint8)
        at = (bucket - 1) * len(part)
        bits[at : at + len(part)] = part[: len(bits) - at]
    return Frequent(bits)


class Full:
    """The buckets that hold a least number of phrases, as bits."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __call__(self, buckets: np.ndarray) -> np.ndarray:
        return (self.bits[buckets >> 3] >> (buckets & 7).astype(np.uint8) & 1).astype(bool)


BUCKET_ROWS = "place int, at binary, n binary"
_BUCKETS_ARROW = pa.schema([("place", pa.int32()), ("at", pa.binary()), ("n", pa.binary())])


def _bucket_rows(counters: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """The counters that are not zero, ``BUCKETS_A_ROW`` of them a row; none needs to go on past ``least``."""
    at = np.flatnonzero(counters)
    n = np.minimum(counters[at], least).astype(np.min_scalar_type(least))
    place, within = at // BUCKETS_A_ROW, (at % BUCKETS_A_ROW).astype(np.uint16)
    places, starts = np.unique(place, return_index=True)
    ends = np.append(starts[1:], len(at))
    for low in range(0, len(places), 1024):
        cut = range(low, min(low + 1024, len(places)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(places[low : low + 1024], pa.int32()),
                pa.array([within[starts[k] : ends[k]].tobytes() for k in cut], pa.binary()),
                pa.array([n[starts[k] : ends[k]].tobytes() for k in cut], pa.binary()),
            ],
            schema=_BUCKETS_ARROW,
        )


def _added(least: int) -> Callable:
    """Rows come sorted by place; the counters of one place are held at a time."""
    kind = np.min_scalar_type(least)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums, out = None, np.zeros(BUCKETS_A_ROW, dtype=np.int64), []

        def finish() -> None:
            full = sums >= least
            if current is not None and full.any():
                out.append((current, np.packbits(full, bitorder="little").tobytes()))

        for rows in batches:
            columns = (rows.column(c).to_pylist() for c in ("place", "at", "n"))
            for place, at, n in zip(*columns, strict=True):
                if place != current:
                    finish()
                    current = place
                    sums[:] = 0
                sums[np.frombuffer(at, np.uint16)] += np.frombuffer(n, kind)
        finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())],
            names=["place", "bits"],
        )

    return add


def full_buckets(rows: DataFrame, least: int) -> Full:
    """The driver gets ``BUCKETS`` bits at most."""
    sorted_rows = rows.repartition("place").sortWithinPartitions("place")
    bits = np.zeros(BUCKETS // 8, dtype=np.uint8)
    wide = BUCKETS_A_ROW // 8
    for place, part in sorted_rows.mapInArrow(_added(least), "place int, bits binary").collect():
        bits[place * wide : (place + 1) * wide] = np.frombuffer(bytes(part), dtype=np.uint8)
    return Full(bits)


class Ids(dict):
    """Word to a number of its own from 1 on; 0 for breaks and for words that are not frequent."""

    def __init__(self, lang: int, frequent: Frequent):
        self.lang, self.frequent = lang, frequent
        self.words: list[bytes] = [b""]
        self.hashes = Growing(np.uint64)
        self.hashes.extend(np.zeros(1, dtype=np.uint64))
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        if self.frequent(self.lang, zlib.crc32(word)):
            self.words.append(word)
            self.hashes.extend(np.array([xxhash.xxh3_64_intdigest(word)], dtype=np.uint64))
            number = len(self.words) - 1
        else:
            number = 0
        self[word] = number
        return number


class Container(dict):
    """Counts by the words that are left."""


class Node(dict):
    """Subtrees by next word, and the count of the phrase that ends here."""

    count = 0


class HatTrie:
    """Counts of phrases, given as tuples of word ids."""

    def __init__(self, burst: int = BURST_ENTRIES, depth: int = TRIE_DEPTH):
        self.burst, self.depth = burst, depth
        self.root = Node()
        self.sizes: dict[int, int] = Counter()
        self.entries = 0

    def add(self, phrase: tuple[int, ...], count: int) -> None:
        node, at = self.root, 0
        while True:
            word = phrase[at]
            child = node.get(word)
            at += 1
            if child is None:
                child = node[word] = Container()
            if type(child) is Container:
                break
            if at == len(phrase):
                child.count += count
                return
            node = child
        rest = phrase[at:]
        known = child.get(rest)
        if known is not None:
            child[rest] = known + count
            return
        child[rest] = count
        self.entries += 1
        self.sizes[phrase[0]] += 1
        if len(child) > self.burst and at < self.depth:
            node[word] = self._burst(child)

    @staticmethod
    def _burst(container: Container) -> Node:
        node = Node()
        for rest, count in container.items():
            if not rest:
                node.count += count
                continue
            below = node.get(rest[0])
            if below is None:
                below = node[rest[0]] = Container()
            below[rest[1:]] = count
        return node

    def take(self, word: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Remove the subtree below a first word; its phrases and counts."""
        self.entries -= self.sizes.pop(word, 0)
        open_: list[tuple[tuple[int, ...], Node | Container]] = [((word,), self.root.pop(word))]
        while open_:
            path, node = open_.pop()
            if type(node) is Container:
                for rest, count in node.items():
                    yield path + rest, count
                continue
            if node.count:
                yield path, node.count
            open_.extend(((*path, w), child) for w, child in node.items())

    def largest(self) -> list[int]:
        return sorted(self.root, key=lambda w: -self.sizes[w])


def _distinct(columns: list[np.ndarray]) -> Iterator[tuple[tuple[int, ...], int]]:
    """Distinct rows with their counts."""
    if not len(columns[0]):
        return
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(order))).tolist()
    yield from zip(zip(*(c[starts].tolist() for c in columns), strict=True), counts, strict=True)


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _buckets(keys: np.ndarray) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(29))) * _SPREAD
    return (mixed >> np.uint64(32)).astype(np.int64) % BUCKETS


@dataclass(frozen=True)
class Pass:
    """One reading of the texts: which phrases are counted, and which only fill buckets."""

    words: Frequent
    counted: tuple[int, ...] = ()  # lengths
    filled: tuple[int, ...] = ()
    full_pairs: Full | None = None
    full_longer: Full | None = None
    parts: int = LEAST_PARTS


class Counting:
    """Phrases of one language in one task."""

    def __init__(self, lang: str, plan: Pass, counters: np.ndarray | None):
        self.lang, self.plan, self.counters = lang, plan, counters
        self.checksum = zlib.crc32(lang.encode())
        self.trie = HatTrie()
        self.ids = Ids(self.checksum, plan.words)
        self.waiting: list[int] = []

    def read(self, words: list[bytes]) -> None:
        self.waiting.extend(map(self.ids.__getitem__, words))
        if len(self.waiting) >= FLUSH_TOKENS:
            self.flush()

    def flush(self) -> None:
        ids = np.array(self.waiting, dtype=np.int64)
        self.waiting.clear()
        if len(ids) < 2:
            return
        plan, hashes = self.plan, self.ids.hashes.values[ids]
        keys = hashes + np.uint64(self.checksum)
        # able: where phrases start whose parts of one word less are all able to be frequent
        able = ids > 0
        for n in range(2, max((*plan.counted, *plan.filled)) + 1):
            able = able[:-1] & able[1:]
            keys = keys[:-1] * _SPREAD + hashes[n - 1 :]
            full = plan.full_pairs if n == 2 else plan.full_longer
            starts = np.flatnonzero(able)
            buckets = _buckets(keys[starts])
            if full is not None:
                ok = full(buckets)
                starts, buckets = starts[ok], buckets[ok]
                able = np.zeros(len(able), dtype=bool)
                able[starts] = True
            if n in plan.filled:
                np.add.at(self.counters, buckets, 1)
            if n in plan.counted:
                add = self.trie.add
                for phrase, count in _distinct([ids[starts + k] for k in range(n)]):
                    add(phrase, count)

    def runs(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Let subtrees go, the largest first, until ``keep`` entries are left: one sorted run for each part."""
        if self.trie.entries <= keep and keep:
            return
        names, gone = self.ids.words, defaultdict(list)
        for word in self.trie.largest():
            if self.trie.entries <= keep and keep:
                break
            for phrase, n in self.trie.take(word):
                text = b" ".join([names[w] for w in phrase])
                prefix = b" ".join([names[w] for w in phrase[:2]])
                gone[zlib.crc32(prefix, self.checksum) % self.plan.parts].append((text, n))
        if gone:
            yield _runs(self.lang, gone)
        if len(self.ids) > KNOWN_WORDS and not keep:
            self.ids = Ids(self.checksum, self.plan.words)


def _runs(lang: str, by_part: dict[int, list[tuple[bytes, int]]]) -> pa.RecordBatch:
    runs = [sorted(run) for run in by_part.values()]
    ends = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
    phrases = pa.array([p.decode("utf-8", "surrogatepass") for run in runs for p, _ in run], pa.string())
    counts = pa.array([n for run in runs for _, n in run], pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(runs), pa.string()),
            pa.array(list(by_part), pa.int32()),
            pa.ListArray.from_arrays(ends, phrases),
            pa.ListArray.from_arrays(ends, counts),
        ],
        schema=_RUNS_ARROW,
    )


def _word_rows(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _WORDS_ARROW, strict=True)], schema=_WORDS_ARROW
    )


def _merge_runs(least: int) -> Callable:
    """Rows come sorted by language and part; the phrases of one part are held at a time."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sums, out = None, Counter(), []

        def finish() -> None:
            out.extend((current[0], phrase, n) for phrase, n in sums.items() if n >= least)
            sums.clear()

        for rows in batches:
            columns = (rows.column(c) for c in ("lang", "part", "phrases", "counts"))
            for lang, part, phrases, counts in zip(*columns, strict=True):
                key = (lang.as_py(), part.as_py())
                if key != current:
                    finish()
                    current = key
                for phrase, n in zip(phrases.as_py(), counts.as_py(), strict=True):
                    sums[phrase] += n
            if len(out) >= 10_000:
                yield _word_rows(out)
                out.clear()
        finish()
        yield _word_rows(out)

    return merge


def _frequent_of(runs: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, n`` of the phrases that occur ``least`` times."""
    dealt = runs.repartition("lang", "part").sortWithinPartitions("lang", "part")
    return dealt.mapInArrow(_merge_runs(least), WORDS)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            if text.is_valid:
                yield lang.as_py() if lang.is_valid else NO_LANGUAGE, text.as_py()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(_BREAK, None)
            if found:
                yield _word_rows([(lang, w.decode("utf-8", "surrogatepass"), n) for w, n in found.items()])
        counts.clear()

    held = 0
    for lang, text in _texts(batches):
        found = counts.setdefault(lang, Counter())
        before = len(found)
        for words in chunks(text):
            found.update(words)
        held += len(found) - before
        if held > TRIE_ENTRIES:
            yield from rows()
            held = 0
    yield from rows()


def _read(batches: Iterator[pa.RecordBatch], plan: Pass, counters: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The runs of one task; its counters are filled on the way."""
    counting: dict[str, Counting] = {}
    for lang, text in _texts(batches):
        part = counting.get(lang)
        if part is None:
            part = counting[lang] = Counting(lang, plan, counters)
        for found in chunks(text):
            part.read(found)
        if len(part.ids) > KNOWN_WORDS:
            part.flush()
            yield from part.runs(0)
        elif sum(c.trie.entries for c in counting.values()) > TRIE_ENTRIES:
            for c in counting.values():
                yield from c.runs(TRIE_ENTRIES // (2 * len(counting)))
    for part in counting.values():
        part.flush()
        yield from part.runs(0)


def _count_phrases(plan: Pass) -> Callable:
    return lambda batches: _read(batches, plan, None)


def _fill_buckets(plan: Pass, least: int) -> Callable:
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(BUCKETS, dtype=np.int32)
        for _ in _read(batches, plan, counters):
            raise AssertionError("nothing is counted here")
        yield from _bucket_rows(counters, least)

    return fill


_BOTH = f"{RUNS}, {BUCKET_ROWS.replace(' n binary', ' fill binary')}"
_BOTH_ARROW = pa.schema([*_RUNS_ARROW, *_BUCKETS_ARROW.remove(2), pa.field("fill", pa.binary())])


def _count_and_fill(plan: Pass, least: int) -> Callable:
    """Runs and bucket rows in one reading, side by side in one schema."""

    def widened(batch: pa.RecordBatch, first: int) -> pa.RecordBatch:
        columns = [pa.nulls(batch.num_rows, f.type) for f in _BOTH_ARROW]
        columns[first : first + batch.num_columns] = batch.columns
        return pa.RecordBatch.from_arrays(columns, schema=_BOTH_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(BUCKETS, dtype=np.int32)
        for batch in _read(batches, plan, counters):
            yield widened(batch, 0)
        for batch in _bucket_rows(counters, least):
            yield widened(batch, len(_RUNS_ARROW))

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, n`` of all phrases of one to ``longest`` words that occur ``least`` times,
    and ``lang, n`` of all words."""
    texts = docs.select("lang", "text")
    counted = texts.mapInArrow(_count_words, WORDS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    words = pin(counted, "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least).select("lang", "phrase", F.lit(1).alias("words"), "n")
    known = frequent_words(frequent)
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = max(LEAST_PARTS, total // PART_WORDS)
    longer = tuple(range(3, longest + 1))
    pairs = full_buckets(texts.mapInArrow(_fill_buckets(Pass(known, filled=(2,)), least), BUCKET_ROWS), least)
    plan = Pass(known, counted=(2,), filled=longer, full_pairs=pairs, parts=parts)
    both = pin(texts.mapInArrow(_count_and_fill(plan, least), _BOTH), "pairs")
    runs = [both.where("place is null").select("lang", "part", "phrases", "counts")]
    if longer:
        full = full_buckets(both.where("place is not null").select("place", "at", F.col("fill").alias("n")), least)
        plan = Pass(known, counted=longer, full_pairs=pairs, full_longer=full, parts=parts)
        runs.append(texts.mapInArrow(_count_phrases(plan), RUNS))
    out = frequent
    for run in runs:
        length = F.size(F.split("phrase", " ", -1)).alias("words")
        out = out.unionByName(pin(_frequent_of(run, least).select("lang", "phrase", length, "n"), "phrases"))
    return out, totals


def _part(start: Column, length: Column) -> Column:
    return F.concat_ws(" ", F.slice(F.split("phrase", " ", -1), start, length))


def without_contained(phrases: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """Candidates that no longer one contains with at least ``percent`` of their occurrences.

    Of the phrases that contain a given one, one with a single word more is the most frequent.
    """
    less = F.col("words") - 1
    inner = (
        phrases.where("words >= 3")
        .select("lang", F.explode(F.array(_part(F.lit(1), less), _part(F.lit(2), less))).alias("inner"), "n")
        .groupBy(F.col("lang").alias("_lang"), "inner")
        .agg(F.max("n").alias("longer"))
    )
    candidates = phrases.where("words >= 2")
    met = candidates.join(
        broadcast_if_small(inner), (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("inner")), "left"
    )
    kept = met.where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("n")))
    return kept.drop("_lang", "inner", "longer")


def scored(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` by the cut of the lowest score."""
    parts = broadcast_if_small(
        phrases.select(F.col("lang").alias("_lang"), F.col("phrase").alias("part"), F.col("n").alias("f"))
    )
    cuts = candidates.select(
        "lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    sides = cuts.withColumns(
        {"first": _part(F.lit(1), F.col("k")), "rest": _part(F.col("k") + 1, F.col("words") - F.col("k"))}
    )
    for side, name in (("first", "l"), ("rest", "r")):
        on = (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("part"))
        sides = sides.join(parts, on).withColumnRenamed("f", name).drop("_lang", "part")
    all_words = broadcast_if_small(totals.withColumnRenamed("lang", "_lang"))
    sides = sides.join(all_words, F.col("lang") == F.col("_lang")).drop("_lang")
    wide = "cast({} as decimal(19, 0))".format
    score = F.expr(f"({wide('a')} * {FACTOR} * {wide('n')}) div ({wide('l')} * {wide('r')})").cast("long")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return (
        sides.groupBy("lang", "phrase", "a", "n")
        .agg(best)
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases. Needs ``lang, text``."""
    phrases, totals = frequent_phrases(docs, least)
    rated = scored(without_contained(phrases), phrases, totals)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rated.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))
