"""Spelling variants by a bit-sliced position index.

For a block of words there is one bit set per (position, letter): the words that have this letter there. A word is
then compared with all words of the block at once. Walking along its letters, one set holds the words equal so far
(zero errors) and three hold those with one error behind them: a replaced letter, matched at the same position; an
inserted one, matched one position further on; a deleted one, matched one position before. A set moves on by an
``and`` with the position's set, and the zero-error set feeds the others; every step handles all words of the block.

Which words meet: two words one edit apart, the shorter of length n, share their first or their last (n-1)//2
letters. So a cell holds the words of lengths n and n+1 with the same first letters, or the same last ones; within
the cells of last letters, words that also share the first ones are masked out, so each pair is met once. Cells of
more than ``BLOCK_WORDS`` words are cut into blocks, and each pair of blocks is a unit of work of its own: no task
holds more than two blocks, and a hot cell spreads over many tasks. A cell sends on one row per word (count and best
neighbour), never pairs.

Defined cases

- a null, empty or letterless text has no runs; a document without id has no slips (the rule needs the id)
- repeated rows count as often as they occur; ties between neighbours of equal count go to the smallest word
- an empty table gives no rows; extra columns are not looked at
- a very long text is one array of its runs in one task; nothing else grows with it
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.text import read, whole
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
SLIP_MODULUS = 31
LEAST_LETTERS = 7
LEAST_COUNT = 2
DOMINANCE = 10

# How many words one bit set spans at most.
BLOCK_WORDS = 4096
# Forms grow at least tenfold from step to step and counts are below 2**63: a chain has at most 19 steps.
CHAIN_DOUBLINGS = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(word: Column) -> Column:
    """A to Z only; the plain function is faster where a word has no other letters."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def slipped(ident: Column, run: Column) -> Column:
    """The run, or the run without one letter where the slip rule says so."""
    mark = F.crc32(F.concat(ident.cast("string"), F.lit(":"), run).cast("binary"))
    at = (mark % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(mark % SLIP_MODULUS == 0, less).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: the words that are long and frequent enough."""
    runs = docs.select(
        F.col("doc_id").alias("ident"), F.explode(F.regexp_extract_all(whole("text"), F.lit(RUN), F.lit(0))).alias("run")
    )
    # A slip takes one letter at most, so shorter runs cannot become words.
    able = runs.where(F.length("run") >= LEAST_LETTERS).select("ident", lower_ascii(F.col("run")).alias("run"))
    words = able.select(slipped(F.col("ident"), F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def cells(words: DataFrame) -> DataFrame:
    """``cell, word, n``: each word in the cells of its first and last letters, as the shorter and as the longer."""
    n = F.length("word")
    roles = F.array(n, n - 1)
    shorter = words.select("word", "n", F.explode(roles).alias("shorter"))
    # A word of the least length is nobody's longer one.
    shorter = shorter.where(F.col("shorter") >= LEAST_LETTERS)
    part = ((F.col("shorter") - 1) / 2).cast("int")
    length = F.col("shorter").cast("string")
    first = F.concat(F.lit("<"), length, F.lit(":"), F.substring("word", F.lit(1), part))
    last = F.concat(F.lit(">"), length, F.lit(":"), F.substring(F.col("word"), F.length("word") - part + 1, part))
    return shorter.select("word", "n", F.explode(F.array(first, last)).alias("cell"))


def _units(cells: DataFrame) -> DataFrame:
    """``cell, asks, block, word, n``: the words of each unit, once as those asked about and once as the index.

    A small cell is one unit in which each word has both parts (``asks`` is null).
    """
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    large = sizes.where(F.col("size") > BLOCK_WORDS).select(
        F.col("cell").alias("large"), F.ceil(F.col("size") / BLOCK_WORDS).cast("int").alias("blocks")
    )
    marked = cells.join(broadcast_if_small(large), F.col("cell") == F.col("large"), "left")
    small = marked.where("blocks is null").select(
        "cell", F.lit(0).alias("unit"), F.lit(None).cast("boolean").alias("asks"), "word", "n"
    )
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    spread = marked.where("blocks is not null").withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asking = spread.select("*", other.alias("other")).select(
        "cell", (F.col("own") * F.col("blocks") + F.col("other")).alias("unit"), F.lit(True).alias("asks"), "word", "n"
    )
    asked = spread.select("*", other.alias("other")).select(
        "cell", (F.col("other") * F.col("blocks") + F.col("own")).alias("unit"), F.lit(False).alias("asks"), "word", "n"
    )
    return small.unionByName(asking).unionByName(asked)


class Index:
    """Bit sets by position and letter over words of one length; bit i is the i-th word."""

    def __init__(self, words: list[str]):
        self.words = words
        self.all = (1 << len(words)) - 1
        sets: dict[tuple[int, str], int] = defaultdict(int)
        for place, word in enumerate(words):
            bit = 1 << place
            for position, letter in enumerate(word):
                sets[position, letter] |= bit
        self.sets = dict(sets)

    def replaced(self, word: str) -> int:
        """Words of the same length that differ in exactly one letter."""
        get, zero, one = self.sets.get, self.all, 0
        for position, letter in enumerate(word):
            here = get((position, letter), 0)
            one = (one & here) | (zero & ~here)
            zero &= here
            if not (zero or one):
                return 0
        return one

    def longer(self, word: str) -> int:
        """Words with one letter more: the word's letters from some place on stand one position later."""
        get, zero, one = self.sets.get, self.all, 0
        for position, letter in enumerate(word):
            one = (one | zero) & get((position + 1, letter), 0)
            zero &= get((position, letter), 0)
            if not (zero or one):
                return 0
        return one | zero

    def shorter(self, word: str) -> int:
        """Words with one letter less: after the dropped letter, the others stand one position before."""
        get, zero, one = self.sets.get, self.all, 0
        last = len(word) - 1
        for position, letter in enumerate(word):
            one = (one & get((position - 1, letter), 0)) | zero
            zero = zero & get((position, letter), 0) if position < last else 0
            if not (zero or one):
                return 0
        return one


def _places(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def neighbours(cell: str, asking: list[tuple[str, int]], index: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, int]]:
    """``word, n_near, best near word, its count`` for the words of a unit that have a neighbour in it."""
    side = cell[0]
    length = int(cell[1 : cell.index(":")])
    part = (length - 1) // 2
    by_length: dict[int, list[tuple[str, int]]] = {length: [], length + 1: []}
    for entry in index:
        by_length[len(entry[0])].append(entry)
    indexes = {n: Index([w for w, _ in entries]) for n, entries in by_length.items()}
    # Pairs that share their first letters too belong to the cell of those.
    heads: dict[int, dict[str, int]] = {n: defaultdict(int) for n in by_length}
    if side == ">":
        for n, entries in by_length.items():
            for place, (word, _) in enumerate(entries):
                heads[n][word[:part]] |= 1 << place
    for word, _ in asking:
        if len(word) == length:
            found = {length: indexes[length].replaced(word)}
            if by_length[length + 1]:
                found[length + 1] = indexes[length + 1].longer(word)
        else:
            found = {length: indexes[length].shorter(word)} if by_length[length] else {}
        n_near, best, best_n = 0, "", 0
        for n, bits in found.items():
            if side == ">" and bits:
                bits &= ~heads[n].get(word[:part], 0)
            for place in _places(bits):
                other, count = by_length[n][place]
                n_near += 1
                if count > best_n or (count == best_n and other < best):
                    best, best_n = other, count
        if n_near:
            yield word, n_near, best, best_n


_NEAR = "word string, n_near long, best string, best_n long"
_NEAR_ARROW = pa.schema(
    [("word", pa.string()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())]
)


def _search_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit; one unit is held at a time."""
    current: tuple[str, int] | None = None
    asking: list[tuple[str, int]] = []
    index: list[tuple[str, int]] = []
    out: list[tuple[str, int, str, int]] = []

    def finish() -> None:
        if current is not None and len(asking) and len(index) and (len(index) > 1 or len(asking) > 1 or asking != index):
            out.extend(neighbours(current[0], asking, index))

    def batch() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _NEAR_ARROW, strict=True)], schema=_NEAR_ARROW
        )

    for rows in batches:
        columns = (rows.column(c).to_pylist() for c in ("cell", "unit", "asks", "word", "n"))
        for cell, unit, asks, word, n in zip(*columns, strict=True):
            if (cell, unit) != current:
                finish()
                current, asking, index = (cell, unit), [], []
            if asks is not False:
                asking.append((word, n))
            if asks is not True:
                index.append((word, n))
        if len(out) >= 10_000:
            yield batch()
            out.clear()
    finish()
    if out:
        yield batch()


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best, best_n`` for the words that have a neighbour; ``words`` has distinct ``word, n``."""
    units = _units(cells(words)).repartition("cell", "unit").sortWithinPartitions("cell", "unit")
    partial = units.mapInArrow(_search_units, _NEAR)
    # The best: largest count, then smallest word. Max by count among ties would not look at the word.
    rank = F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best"))
    merged = partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(rank).alias("first"))
    return merged.select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.minus")).alias("best_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form``: the end of the chain, found by doubling its steps."""
    steps = forms.select("word", F.col("form").alias("root"))
    for _ in range(CHAIN_DOUBLINGS):
        ahead = steps.select(F.col("word").alias("via"), F.col("root").alias("further"))
        steps = pin(
            steps.join(ahead, F.col("root") == F.col("via"), "left").select(
                "word", F.coalesce("further", "root").alias("root")
            ),
            "roots",
        )
    return steps


def variants(words: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for a vocabulary ``word, n`` of distinct words.

    ``words`` is read several times: pass a stored one.
    """
    near = near_words(words)
    known = pin(
        words.join(near.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("best_n") >= DOMINANCE * F.col("n"), F.col("best")).alias("form"),
            F.when(F.col("best_n") >= DOMINANCE * F.col("n"), F.col("best_n")).alias("form_n"),
        ),
        "variants",
    )
    roots = with_roots(known.where("form is not null")).withColumnRenamed("word", "_word")
    bound = known.where("form is not null").join(roots, F.col("word") == F.col("_word")).drop("_word")
    free = known.where("form is null").withColumn("root", F.col("word"))
    return bound.unionByName(free)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = pin(vocabulary(read(spark, sf_dir, "documents")), "words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")
