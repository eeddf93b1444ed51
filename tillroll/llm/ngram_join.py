"""Exact n-gram Jaccard join and the classes it forms, by rare-first prefix filtering.

Two texts link when ``100 * |A & B| >= percent * |A | B|`` over their sets of word shingles. Links are
not expanded within groups of copies; the result is each document's class. No link between different
texts is lost, and no filter is a guess:

* **Equal sets** are one class from the start, so everything below sees each set once.
* **First filter.** Under any fixed order of shingles, linked sets of sizes a <= b share at least ``l`` of
  their first ``n - need(n) + l`` shingles, where ``need(n)`` is the least overlap that a set of size n can
  link with. Taken in the order of a hash, the sets that share too few of these with *any* other set are
  done: they have no link. Whether a shingle has a second owner is seen from the least and greatest owner,
  which are combined before the shuffle, so a shingle that a third of all texts hold costs a row per task.
* **Rare-first prefixes.** For the rest, shingles are counted and each set is put in order, rarest first.
  Linked sets share a shingle within their prefixes of ``n - need(n) + 1``. Shingles with one owner come
  first, so often nothing of the prefix is left.
* **Candidates** come from joining prefixes on the shingle, under the length filter (sizes within the
  percentage), the positional filter (what is left behind the shared place must suffice) and the suffix
  filter (shingles are dealt to hash ranges; the overlap is at most the sum of the smaller counts).
* **Verification** counts the overlap of the two whole sets, once per pair.
* **Large groups.** In each prefix group the set with the most common shingles is compared with all others
  first. What links to it is one class already, so only pairs across classes are compared after that,
  all of them. A group of thousands of near copies costs thousands of comparisons, not millions.

Defined cases: a missing or empty text has the empty set and links with nothing. Rows without id have a
set and may connect others, but give no class its name; a class without any id has none. Repeated rows
are copies. An empty table gives an empty result. Extra columns are ignored unless named in ``carry``, whatever
they are called. A very long text is one array of its shingles in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.components import connected
from tillroll.llm.text import own, read, whole
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

WORDS = 4
PERCENT = 85
_RANGES = 128  # a power of two
_SLICE = 64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    _MAX_WORDS = 500_000

    def __init__(self, words: int):
        self.words = words
        self._hash: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters, ASCII spaces
        if not found:
            return np.empty(0, dtype=np.uint64)
        known = self._hash
        new = set(found).difference(known)
        if new:
            if len(known) > self._MAX_WORDS:
                known.clear()
                new = set(found)
            known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        h = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
        k = min(self.words, len(h))
        n = len(h) - k + 1
        mix = np.full(n, np.uint64(k), dtype=np.uint64)
        for j in range(k):
            mix = _mixed(mix * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
        mix.sort()
        return mix[np.concatenate(([True], mix[1:] != mix[:-1]))]


def _need(n: int, percent: int) -> int:
    """The least overlap with which a set of size ``n`` can link: ceil(percent / 100 * n)."""
    return -(-percent * n // 100)


def _arrow(run, schema):
    """Feed a mapInArrow function few texts at a time, whatever the size of Spark's batches."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = run()
        for batch in batches:
            for low in range(0, batch.num_rows, _SLICE):
                yield state(batch.slice(low, _SLICE))

    return sliced, schema


def _sketched(docs: DataFrame, text: str, carry: Sequence[str], words: int, percent: int) -> DataFrame:
    """``carry..., text_key, n, set_key, first``: ``first`` holds the set's first shingles in hash order."""
    rows = docs.select(*carry, F.sha2(whole(text), 256).alias("text_key"), F.col(text).alias("_text"))
    kept, names = len(rows.columns) - 1, rows.columns[:-1]

    def run():
        shingles = Shingler(words)

        def of(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, keys, firsts = [], [], []
            for value in batch.column(kept).to_pylist():
                s = shingles(value)
                spare = len(s) - _need(len(s), percent)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                firsts.append(s[: spare + _shared(spare)].view(np.int64))
            flat = pa.array(np.concatenate(firsts) if firsts else [], pa.int64())
            ends = np.cumsum([0, *map(len, firsts)])
            return pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:kept],
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                ],
                names=[*names, "n", "set_key", "first"],
            )

        return of

    schema = rows.drop("_text").schema.add("n", "long").add("set_key", "binary").add("first", T.ArrayType(T.LongType()))
    return rows.mapInArrow(*_arrow(run, schema))


def _shared(spare: int) -> int:
    """How many of the first shingles the first filter asks for; any number from 1 is exact."""
    return max(1, spare // 2)


def _whole_sets(texts: DataFrame, words: int) -> DataFrame:
    """``set_key, h`` with one row per shingle of each text in ``texts(set_key, text)``."""

    def run():
        shingles = Shingler(words)

        def of(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(flat)], names=["set_key", "h"]
            )

        return of

    return texts.mapInArrow(*_arrow(run, "set_key binary, h long"))


def _candidates_left(sketches: DataFrame, percent: int) -> DataFrame:
    """``set_key, n, text_key`` of the sets that the first filter leaves, one text each."""
    spare = F.col("n") - F.expr(f"({percent} * n + 99) div 100")
    asked = F.greatest(F.lit(1), F.floor(spare / 2))
    lonely = (
        sketches.select("set_key", F.explode("first").alias("h"))
        .groupBy("h")
        .agg(F.min("set_key").alias("a"), F.max("set_key").alias("b"))
        .where(F.col("a") == F.col("b"))
        .groupBy(F.col("a").alias("owner"))
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    sets = (
        sketches.where("n > 0")
        .groupBy("set_key")
        .agg(F.first("n").alias("n"), F.min("text_key").alias("text_key"))
    )
    others = F.least(spare + asked, F.col("n")) - F.coalesce("alone", F.lit(0))
    # Where the first shingles are all the set has, more than those cannot be asked for.
    return sets.join(lonely, F.col("set_key") == F.col("owner"), "left").where(
        others >= F.least(asked, F.col("n"))
    ).select("set_key", "n", "text_key")


def _ordered_sets(docs: DataFrame, text: str, left: DataFrame, words: int, percent: int) -> DataFrame:
    """``set_key, n, alone, hs, bins, weight`` of the sets that can still link.

    ``hs`` are the shingles with other owners, rarest first; the ``alone`` shingles without come before
    them. ``bins`` counts ``hs`` by hash range. Shingles without other owner cannot be in any overlap.
    """
    keyed = docs.select(F.sha2(whole(text), 256).alias("_k"), F.col(text).alias("text"))
    named = broadcast_if_small(left)
    texts = (
        keyed.join(named, keyed["_k"] == named["text_key"], "left_semi")
        .groupBy("_k")
        .agg(F.first("text").alias("text"))
        .join(named, F.col("_k") == named["text_key"])
        .select("set_key", "text")
    )
    postings = pin(_whole_sets(texts, words), "postings")
    # Both owners known where there are just two; a count tells the rest.
    counts = pin(postings.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "counts")
    lists = (
        postings.join(counts, "h")
        .groupBy("set_key")
        .agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("hs"), F.sum("df").alias("total"))
        .join(left.select("set_key", "n"), "set_key")
        .where(F.size("hs") >= F.expr(f"({percent} * n + 99) div 100"))
    )
    hashes = F.transform("hs", lambda x: x["h"])
    # How common a set's shingles are, those without other owner included: a set that many others are edits
    # of has few of them.
    weight = (F.col("total") + F.col("n") - F.size("hs")) / F.col("n")
    ordered = lists.select(
        "set_key", "n", (F.col("n") - F.size("hs")).alias("alone"), hashes.alias("hs"), weight.alias("weight")
    )
    return pin(ordered.withColumn("bins", _by_range("hs")), "sets")


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _by_range(sets: pd.Series) -> pd.Series:
    """How many of a set's hashes fall into each range."""
    return sets.map(lambda h: np.bincount(np.asarray(h) & (_RANGES - 1), minlength=_RANGES))


def _overlap_needed(n: Column, m: Column, percent: int) -> Column:
    """100 i >= p (n + m - i), for the overlap i: at least p (n + m) / (100 + p), rounded up."""
    return F.ceil(percent * (n + m) / F.lit(100 + percent))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``h, set_key, n, pos, weight`` of the prefix shingles that have other owners."""
    length = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1 - F.col("alone")
    return (
        sets.where(length > 0)
        .select(
            "set_key",
            "n",
            "weight",
            "alone",
            F.posexplode(F.slice("hs", F.lit(1), length.cast("int"))).alias("at", "h"),
        )
        .select("h", "set_key", "n", "weight", (F.col("alone") + F.col("at")).alias("pos"))
    )


def _may_link(percent: int) -> Column:
    """Length filter and positional filter on rows ``n, pos, m, mpos``. At the first shingle that two sets
    share, all of their overlap lies there or behind, so a linked pair passes at that one."""
    n, m = F.col("n"), F.col("m")
    lengths = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    behind = F.least(n - F.col("pos"), m - F.col("mpos"))
    return lengths & (behind >= _overlap_needed(n, m, percent))


def _ranges_allow(a: str, b: str, needed: Column) -> Column:
    """Suffix filter: sets share at most the smaller count of each hash range."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x) >= needed


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link. First the suffix filter, on the counts by hash range alone; then the
    whole overlap of what is left."""
    needed = _overlap_needed(F.col("na"), F.col("nb"), percent)
    counted = pairs
    for side in "ab":
        counted = counted.join(
            sets.select(
                F.col("set_key").alias(side), F.col("n").alias("n" + side), F.col("bins").alias("b" + side)
            ),
            side,
        )
    overlap = F.size(F.array_intersect("ha", "hb"))
    whole_sets = counted.where(_ranges_allow("ba", "bb", needed)).select("a", "b", "na", "nb")
    for side in "ab":
        whole_sets = whole_sets.join(
            sets.select(F.col("set_key").alias(side), F.col("hs").alias("h" + side)), side
        )
    return whole_sets.where(overlap >= needed).select("a", "b")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Enough links ``a, b`` between sets to connect every class: see *Large groups* above."""
    prefixes = pin(_prefixes(sets, percent), "prefixes")
    pivot = F.max(F.struct("weight", "set_key", "n", "pos")).alias("p")
    pivots = prefixes.groupBy("h").agg(pivot, F.count(F.lit(1)).alias("members")).where("members > 1")
    stars = pin(
        prefixes.join(
            pivots.select(
                "h",
                F.col("p.set_key").alias("other"),
                F.col("p.n").alias("m"),
                F.col("p.pos").alias("mpos"),
            ),
            "h",
        )
        .where((F.col("set_key") != F.col("other")) & _may_link(percent))
        .select(F.least("set_key", "other").alias("a"), F.greatest("set_key", "other").alias("b"))
        .distinct(),
        "stars",
    )
    first = pin(_verified(stars, sets, percent), "links")
    classes = connected(first)
    classed = pin(
        prefixes.join(classes.withColumnRenamed("node", "set_key"), "set_key", "left").select(
            "h", "set_key", "n", "pos", F.coalesce("label", "set_key").alias("label")
        ),
        "classed",
    )
    mixed = (
        classed.groupBy("h")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select("h")
    )
    # The ranges go along here, so that the join itself gives out few pairs that do not link. Sizes that can
    # link lie in the same band or in neighbouring ones, so a group meets by bands and not as a whole.
    rows = (
        classed.join(mixed, "h")
        .join(sets.select("set_key", "bins"), "set_key")
        .withColumn("band", F.floor(F.log("n") / F.lit(math.log(100 / percent * 1.000001))))
    )
    other = rows.select(
        "h",
        F.col("set_key").alias("other"),
        F.col("n").alias("m"),
        F.col("pos").alias("mpos"),
        F.col("label").alias("olabel"),
        F.col("bins").alias("obins"),
        F.col("band").alias("oband"),
        F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"),
    )
    across = (
        rows.join(other, ["h", "band"])
        .where(
            ((F.col("oband") > F.col("band")) | (F.col("set_key") < F.col("other")))
            & (F.col("label") != F.col("olabel"))
            & _may_link(percent)
            & _ranges_allow("bins", "obins", _overlap_needed(F.col("n"), F.col("m"), percent))
        )
        .select(F.least("set_key", "other").alias("a"), F.greatest("set_key", "other").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")  # verified already
    )
    return first.unionByName(pin(_verified(across, sets, percent), "links"))


def _classed(docs: DataFrame, text: str, kept: Sequence[str], words: int, percent: int) -> DataFrame:
    """``kept..., text_key, n, _class`` per row; rows of one class can be reached from each other by links.

    Columns go by numbers inside, so that none can clash with the names used here.
    """
    inner = [f"_c{k}" for k in range(len(kept))]
    rows = docs.select(*(F.col(c).alias(i) for c, i in zip(kept, inner, strict=True)), F.col(text).alias("_words_of"))
    sketches = pin(_sketched(rows, "_words_of", inner, words, percent), "sketches")
    left = pin(_candidates_left(sketches, percent), "left")
    sets = _ordered_sets(rows, "_words_of", left, words, percent)
    classes = connected(_links(sets, percent))
    labelled = sketches.select(*inner, "text_key", "n", "set_key").join(
        broadcast_if_small(classes.withColumnRenamed("node", "_node")),
        F.col("set_key") == F.col("_node"),
        "left",
    )
    return pin(labelled.select(*inner, "text_key", "n", F.coalesce("label", "set_key").alias("_class")), "classes")


def link_classes(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    words: int = WORDS,
    percent: int = PERCENT,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id, n_shingles, component_id`` per row, and the columns named in ``carry``."""
    kept = [id_column, *(c for c in carry if c != id_column)]
    labelled = _classed(docs, text, kept, words, percent)
    # Only classes of two rows and more need a name from elsewhere, and their names are few: the rows of a
    # large class, and empty texts, stay where they are.
    names = (
        labelled.where("n > 0")
        .groupBy(F.col("_class").alias("_named"))
        .agg(F.min("_c0").alias("_name"), F.count(F.lit(1)).alias("_members"))
        .where("_members > 1")
        .drop("_members")
    )
    named = labelled.join(
        broadcast_if_small(pin(names, "names")), (F.col("_class") == F.col("_named")) & (F.col("n") > 0), "left"
    )
    return named.select(
        *(F.col(f"_c{k}").alias(c) for k, c in enumerate(kept)),
        F.col("n").alias("n_shingles"),
        F.when(F.col("_named").isNotNull(), F.col("_name")).otherwise(F.col("_c0")).alias("component_id"),
    )


def one_of_each(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """The documents with one row left of each class: the first by id, then by a hash of its text; rows without id
    come last. Classes are those of ``link_classes`` with the same ``words`` and ``percent``.

    It is rows that are decided on: if an id has several texts, each of them belongs to its own class. Texts
    without words are in no class; all of them stay.
    """
    labelled = _classed(docs, text, [id_column], words, percent).where("n > 0")
    place = F.struct(F.col("_c0").isNull().alias("no_id"), F.col("_c0").alias("id"), F.col("text_key").alias("text"))
    firsts = labelled.groupBy("_class").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("members"))
    several = pin(firsts.where("members > 1"), "firsts")
    # Every row of these classes, once, and whether it is the one that stays.
    met = labelled.join(broadcast_if_small(several.withColumnRenamed("_class", "_of")), F.col("_class") == F.col("_of"))
    id_name, text_name, first_name = own("id"), own("text"), own("first")
    decided = pin(
        met.select(F.col("_c0").alias(id_name), F.col("text_key").alias(text_name), (place == F.col("first")).alias(first_name))
        .groupBy(id_name, text_name)
        .agg(F.max(first_name).alias(first_name)),
        "decided",
    )
    key = own("key")
    keyed = docs.withColumn(key, F.sha2(whole(text), 256))
    same = (F.col(key) == F.col(text_name)) & F.col(id_column).eqNullSafe(F.col(id_name))
    marked = keyed.join(broadcast_if_small(decided), same, "left")
    alone = marked.where(F.col(first_name).isNull()).select(*docs.columns)
    # The same row may be there several times; only rows that stay are shuffled for that, one of each class.
    staying = marked.where(first_name).dropDuplicates([key, id_column]).select(*docs.columns)
    return alone.unionByName(staying)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_classes(read(spark, sf_dir, "documents"))
