"""Log-likelihood of whole documents under a gated recurrent language model trained on the corpus.

1. Words of the training documents are counted, all of them.
2. Words are looked up once: each document is stored as the numbers of its symbols, with the words whose counts not
   every task knows.
3. The network is trained on all training documents, in rounds. In a round every task starts from the same
   parameters, learns from its texts by truncated backpropagation, and the parameters are averaged by the
   tokens behind them. The first rounds take small slices of the documents, so that tasks agree on a
   direction before they go further on their own. Slices are cut by a hash and cover everything once. A
   larger corpus has a larger model, by the words of the head, and more rounds. A small slice is learned by few tasks,
   so that none makes its steps with a handful of tokens.
4. Each document is scored as a whole, the state carried from window to window. Counts of frequent words are
   known to every task; the others are stored as (document, word, times) and meet the counts in a join.

Only parameters (at most 2.1 million numbers, summed up over the tasks by Spark) and the bounded vocabulary head
reach the driver.

Defined cases: a missing or empty text is the end token alone. Rows without id are learned from. Repeated rows
are scored each on their own. Without training documents all counts are 0. An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import lm_network as network
from tillroll.llm.lm_data import (
    SMOOTHING,
    Lookup,
    Vocabulary,
    count_words,
    is_held_out,
    vocabulary,
    words_of_batches,
)
from tillroll.llm.text import read
from tillroll.scratch import pin

RATES = (0.01, 0.005, 0.003)  # step sizes of the first rounds, the last one also of all after them
ROUND_TOKENS = 64_000_000  # one round more for each fourfold of it
TASK_TOKENS = 300_000  # a task of a round has as many at least, where there are so many
CHUNK = 4096
BATCH_TOKENS = 4_000_000


def _batches(batches: Iterator[pa.RecordBatch], symbols: int) -> Iterator[tuple[list[np.ndarray], list[pa.RecordBatch]]]:
    """The symbol sequences of many documents at a time, from the last column, and what else their rows say. One long
    text then keeps its lane busy while the others have theirs."""
    held, others, size = [], [], 0
    for batch in batches:
        for low in range(0, batch.num_rows, 128):
            rows = batch.slice(low, 128)
            for value in rows.column(rows.num_columns - 1).to_pylist():
                held.append(np.frombuffer(value, dtype=_stored(symbols)))
                size += len(held[-1])
            others.append(rows.select(rows.schema.names[:-1]))
            if size >= BATCH_TOKENS:
                yield held, others
                held, others, size = [], [], 0
    if held:
        yield held, others


def _stored(symbols: int) -> str:
    """The type of a stored symbol."""
    return "<u2" if symbols <= 1 << 16 else "<u4"


def rounds(tokens: int) -> list[tuple[int, int, float]]:
    """Slices from, to and the step size of each round; the last number of slices is that of all."""
    n = len(RATES)
    while tokens > ROUND_TOKENS * 4 ** (n - len(RATES)):
        n += 1
    return [(4 ** (k - 1) if k else 0, 4**k, RATES[min(k, len(RATES) - 1)]) for k in range(n)]


def _sum_of_parts(group: pa.Table) -> pa.Table:
    total = np.sum([part.values.to_numpy() for part in group.column("part")], axis=0, dtype=np.float64)
    return pa.table({"chunk": group.column("chunk")[:1], "part": pa.array([total], pa.list_(pa.float64()))})


def look_up(docs: DataFrame, text: str, id_column: str, words: Vocabulary) -> DataFrame:
    """Per document: its own number, tokens, what the head knows of its words, the words that it does not know, the
    slice it is learned in, and its symbols."""
    shared = docs.sparkSession.sparkContext.broadcast(words)  # bounded, see Vocabulary
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        is_held_out(F.col(id_column)).alias("held_out"),
        F.pmod(F.xxhash64(text), F.lit(rounds(words.total)[-1][1])).alias("slice"),
        F.col(text).alias("text"),
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, held_out boolean, slice long, row long, n_tokens long, n_known long, head_log double, "
        "words array<binary>, times array<int>, symbols binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        lookup, kind = Lookup(words), _stored(len(words.mass))
        number = TaskContext.get().partitionId() << 40
        for rows, found in words_of_batches(batches):
            symbols, counts, begins, unknown, spelled = lookup.of_words(found)
            known = counts >= 0
            logs = np.log10(np.where(known, counts, 0) + SMOOTHING) * known
            cuts = np.searchsorted(unknown, np.append(begins, len(symbols))).tolist()
            rest = [Counter(spelled[a:b]) for a, b in zip(cuts, cuts[1:])]
            offsets = pa.array(np.cumsum([0, *map(len, rest)]), pa.int32())
            stored = np.split(symbols.astype(kind), begins[1:])
            columns = [
                *rows.columns[:-1],
                pa.array(np.arange(number, number + len(begins)), pa.int64()),
                pa.array(found.in_text + 1, pa.int64()),
                pa.array(np.add.reduceat(counts > 0, begins, dtype=np.int64), pa.int64()),
                pa.array(np.add.reduceat(logs, begins), pa.float64()),
                pa.ListArray.from_arrays(offsets, pa.array([w for c in rest for w in c], pa.binary())),
                pa.ListArray.from_arrays(offsets, pa.array([n for c in rest for n in c.values()], pa.int32())),
                pa.array([part.tobytes() for part in stored], pa.binary()),
            ]
            number += len(begins)
            yield pa.RecordBatch.from_arrays(columns, names=[d.split()[0] for d in schema.split(", ")])

    return pin(rows.mapInArrow(run, schema), "symbols")


def train_model(looked_up: DataFrame, words: Vocabulary) -> np.ndarray:
    """The parameters, flat. ``looked_up`` are the training documents."""
    context = looked_up.sparkSession.sparkContext
    spelling = words.spelling()
    of = network.layout(len(words.mass), spelling)
    flat = network.flatten(network.initial(words.mass, spelling=spelling))
    shared = context.broadcast(of)
    plan = rounds(words.total)
    slices = plan[-1][1]
    for low, high, rate in plan:
        before = context.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of = shared.value
            params = network.unflatten(before.value, of)
            memory, seen = network.new_memory(params), 0
            times = np.zeros(of.symbols)
            for texts, _ in _batches(batches, of.symbols):
                seen += network.train(params, memory, texts, rate)
                times += np.bincount(np.concatenate(texts), minlength=of.symbols)
            if not seen:
                return
            # A spelling's vector is also behind the own symbols with it.
            inputs = times + np.bincount(of.base, weights=times[: len(of.base)], minlength=of.symbols)
            moved = (network.flatten(params) - before.value) * network.spread(inputs, times, of)
            # The tokens behind the parameters go along as the last numbers.
            out = np.concatenate([moved, inputs, times]).astype(np.float32)
            for k in range(0, len(out), CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k // CHUNK], pa.int32()), pa.array([out[k : k + CHUNK]], pa.list_(pa.float32()))],
                    names=["chunk", "part"],
                )

        part = looked_up.where((F.col("slice") >= low) & (F.col("slice") < high)).select("symbols")
        tasks = max(1, words.total * (high - low) // (slices * TASK_TOKENS))
        moves = part.coalesce(tasks).mapInArrow(run, "chunk int, part array<float>")
        summed = moves.groupBy("chunk").applyInArrow(_sum_of_parts, "chunk int, part array<double>").toArrow()
        if summed.num_rows:
            summed = summed.sort_by("chunk").column("part").combine_chunks()
            total = summed.flatten().to_numpy()
            moved, inputs, times = np.split(total, np.cumsum([len(flat), of.symbols]))
            behind = network.spread(inputs, times, of)
            flat = (flat + moved / np.maximum(behind, 1.0)).astype(np.float32)
        before.unpersist()
    return flat


def _scored(looked_up: DataFrame, words: Vocabulary, flat: np.ndarray) -> DataFrame:
    """Per document: its own number, tokens, what the head knows of its words, and the log-likelihood of its symbols."""
    of = network.layout(len(words.mass), words.spelling())
    shared = looked_up.sparkSession.sparkContext.broadcast((of, flat, words.mass))
    kept = looked_up.select("doc_id", "held_out", "row", "n_tokens", "n_known", "head_log")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema) + ", symbol_log double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, flat, mass = shared.value
        params, log_mass = network.unflatten(flat, of), np.log10(mass)
        for texts, others in _batches(batches, of.symbols):
            logs = network.score(params, texts) / math.log(10)
            logs -= [log_mass[symbols].sum() for symbols in texts]
            at = 0
            for rows in others:
                part = pa.array(logs[at : at + rows.num_rows], pa.float64())
                at += rows.num_rows
                yield pa.RecordBatch.from_arrays([*rows.columns, part], names=[*rows.schema.names, "symbol_log"])

    return pin(looked_up.select(*kept.columns, "symbols").mapInArrow(run, schema), "scored")


def score_documents(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document."""
    training = docs.where(~is_held_out(F.col(id_column)))
    counts = count_words(training, text)
    words = vocabulary(counts)
    looked_up = look_up(docs, text, id_column, words)
    scored = _scored(looked_up, words, train_model(looked_up.where(~F.col("held_out")), words))
    rest = (
        looked_up.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
        .select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTHING)).alias("rest_log"),
            F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        )
    )
    word_log = F.col("head_log") + F.coalesce("rest_log", F.lit(0.0))
    norm = math.log10(words.total + SMOOTHING * (words.distinct + 1))
    return scored.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.total).cast("long").alias("train_tokens"),
        (word_log - F.col("n_tokens") * norm).alias("base_score"),
        (word_log + F.col("symbol_log")).alias("score"),
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))
