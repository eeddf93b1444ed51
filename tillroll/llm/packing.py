"""Best-fit packing with exact complements.

1. Every text is tokenized once and cut into pieces of at most ``capacity`` tokens.
2. The pieces are counted by length. That histogram has at most ``capacity`` rows at any input size,
   and the whole plan is made from it: take the longest length left, look for one, two or three
   lengths that sum up to exactly the gap, and use that combination as often as the counts allow. Only
   where no combination fills the gap, the longest lengths that still fit are added (best fit).
   Every step uses up a length or its complement, so the plan is a short list of patterns.
3. A pattern that is used m times owns m sequences and a run of the pieces of each of its lengths.
   Pieces are numbered within their length from the counts per task, without a shuffle of the pieces,
   and find their place by their number.

Defined cases: a missing or empty text is the end token alone. Repeated rows are packed each on their
own. An empty table gives an empty result. Extra columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.text import own, read
from tillroll.llm.word_tokens import worker_tokenizer
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that hold, in this order, ``count`` pieces of each length."""

    times: int
    parts: tuple[tuple[int, int], ...]


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that place every piece of the histogram ``{length: pieces}``."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, pieces in histogram.items():
        left[length] += pieces
    patterns = []
    while left.any():
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1  # hold one back, so that the complement may use the same length
        gap = capacity - top
        found = _complement(left, gap) if gap else []
        left[top] += 1
        lengths = [top, *(found if found is not None else _best_fit(left, top, gap))]
        counts = {n: lengths.count(n) for n in dict.fromkeys(lengths)}
        times = min(int(left[n]) // k for n, k in counts.items())
        for n, k in counts.items():
            left[n] -= times * k
        patterns.append(Pattern(times, tuple(counts.items())))
    return patterns


def _complement(left: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three available lengths that sum up to ``gap``, the fewest and longest first."""
    if left[gap]:
        return [gap]
    there = left[: gap + 1] > 0
    pair = _pair(left, there, gap)
    if pair:
        return pair
    # Which sums of two different places of the histogram exist, indexed by sum.
    firsts = np.flatnonzero(there)[::-1]
    if not len(firsts):
        return None
    smallest = int(firsts[-1])
    for a in firsts:
        a = int(a)
        rest = gap - a
        if rest > 2 * a:
            break  # the longest of three would be below a third
        if rest < 2 * smallest:
            continue
        left[a] -= 1
        pair = _pair(left, left[: rest + 1] > 0, rest, most=a)
        left[a] += 1
        if pair:
            return [a, *pair]
    return None


def _pair(left: np.ndarray, there: np.ndarray, total: int, most: int | None = None) -> list[int] | None:
    """Two available lengths of the given sum, the longer one as long as possible."""
    ok = there[1:total] & there[1:total][::-1]
    if total % 2 == 0 and total >= 2 and left[total // 2] < 2:
        ok[total // 2 - 1] = False
    at = np.flatnonzero(ok) + 1
    if most is not None:
        at = at[at <= most]
    at = at[at * 2 >= total]
    return [int(at[-1]), total - int(at[-1])] if len(at) else None


def _best_fit(left: np.ndarray, top: int, gap: int) -> list[int]:
    """The longest available lengths that still fit, one after the other."""
    spare = left.copy()
    spare[top] -= 1
    chosen = []
    while gap > 0:
        fitting = np.flatnonzero(spare[1 : gap + 1])
        if not len(fitting):
            break
        n = int(fitting[-1]) + 1
        take = min(int(spare[n]), gap // n)
        chosen += [n] * take
        spare[n] -= take
        gap -= n * take
    return chosen


def tokenize_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``carry..., piece, start, length, ids_crc32[, ids]`` per piece, and where it was made:
    ``_task`` and, within task and length, ``_nth``."""
    kept = docs.select(*carry, F.col(text).alias("_text"))
    added = T.StructType.fromDDL(
        "piece int, start long, length long, ids_crc32 long"
        + (", ids array<int>" if with_ids else "")
        + ", _task int, _nth long"
    )
    schema = T.StructType([*kept.schema.fields[:-1], *added.fields])
    n_carry = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_tokenizer(tokenizer_path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):  # few texts at a time in memory
                part = batch.slice(low, 256)
                rows, out = [], {f.name: [] for f in added.fields}
                for r, text_value in enumerate(part.column(n_carry).to_pylist()):
                    ids = np.append(encoder.ids(text_value or ""), np.uint32(end_id))
                    for k, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start : start + capacity]
                        rows.append(r)
                        out["piece"].append(k)
                        out["start"].append(start)
                        out["length"].append(len(piece))
                        out["ids_crc32"].append(zlib.crc32(piece.astype("<u4").tobytes()))
                        if with_ids:
                            out["ids"].append(piece.astype(np.int32))
                        out["_task"].append(task)
                        out["_nth"].append(seen[len(piece)])
                        seen[len(piece)] += 1
                picked = part.take(pa.array(rows, pa.int64()))
                types = {"piece": pa.int32(), "_task": pa.int32(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns[:n_carry]]
                    + [pa.array(v, types.get(c, pa.int64())) for c, v in out.items()],
                    names=[f.name for f in schema.fields],
                )

    return kept.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. The pieces are written once, because the plan and
    the numbering have to see the same ones."""
    spark = docs.sparkSession
    pieces = pin(
        tokenize_pieces(docs, tokenizer_path, text, carry, capacity, end_id, with_ids), "pieces"
    )
    counts = pin(pieces.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("_n")), "counts")
    histogram = dict(counts.groupBy("length").agg(F.sum("_n")).collect())  # capacity rows at most

    runs, first_sequence, used = [], 0, dict.fromkeys(histogram, 0)
    for pattern in plan_packing(histogram, capacity):
        offset = 0
        for length, each in pattern.parts:
            low = used[length]
            used[length] += pattern.times * each
            runs.append((length, low, used[length], first_sequence, each, offset))
            offset += length * each
        first_sequence += pattern.times
    plan = spark.createDataFrame(
        runs, "_length long, _low long, _high long, _first long, _each long, _at long"
    )

    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("_task").alias("_t"),
        F.col("length").alias("_l"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    numbered = pieces.join(
        broadcast_if_small(starts),
        (F.col("_task") == F.col("_t")) & (F.col("length") == F.col("_l")),
    ).withColumn("_rank", F.col("_start") + F.col("_nth"))
    # The plan has a few runs for each of at most ``capacity`` lengths.
    placed = numbered.join(
        F.broadcast(plan),
        (F.col("length") == F.col("_length"))
        & (F.col("_rank") >= F.col("_low"))
        & (F.col("_rank") < F.col("_high")),
    )
    within = F.col("_rank") - F.col("_low")
    return placed.select(
        *carry,
        "piece",
        "start",
        "length",
        "ids_crc32",
        *(["ids"] if with_ids else []),
        (F.col("_first") + F.floor(within / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_at") + (within % F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )


def public_tokenizer(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizer())
