"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target share of all words, limited to a few times its own size. A document of a source
should then occur ``target / size of the source`` times on average. The whole part of that number is
taken for certain; the fraction is rounded by pivotal steps: two documents of a source meet, and words are
moved from one's expectation to the other's, in a random direction whose odds leave both expectations as they
are, until one of the two fractions has become 0 or 1. Since each step moves words and not documents, the
expected words of a source never change, and its result misses the target by the last fraction only.

The steps form a reduction tree. Rows are spread over buckets by a hash, each bucket keeps one fraction
open, and open fractions of neighbouring buckets meet in the next round until each source has one, which is
drawn. Buckets are streamed in sorted order, so memory holds one open row however large a bucket is. Random
numbers are hashes of seed, round and document, so reruns and retried tasks agree.

Defined cases: a missing source is a source of its own and comes last; a missing or empty text has no words,
takes nothing and is rounded to the whole part. Documents that agree in source, id and text are
interchangeable; each keeps a row of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.text import own, read, whole, words_of
from tillroll.operators.dense_key import number_in_order
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3.0
BUCKET_ROWS = 4096
FANOUT = 256


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: float = MAX_COPIES
) -> DataFrame:
    """``source, rows, source_size, target`` from ``source, rows, source_size``.

    Weights repeat over the sources in code point order, a missing source last. Where a target would
    exceed ``max_copies`` times its source, it stops there and the excess is shared again by weight.
    Each round is one aggregate over the sources; only two sums reach the driver.
    """
    ordered = number_in_order(sizes, "_number", [F.col("source").asc_nulls_last()])
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (((F.col("_number") - 1) % len(weights)) + 1).cast("int")
    )
    weighted = pin(ordered.select(*sizes.columns, weight.alias("_weight")), "weighted")
    cap = F.col("source_size") * F.lit(float(max_copies))
    total = float(weighted.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        # Sources at their cap under the present level stay capped: the level only rises.
        is_capped = cap < F.lit(level) * F.col("_weight")
        n, fixed, open_weight = weighted.agg(
            F.count_if(is_capped),
            F.coalesce(F.sum(F.when(is_capped, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~is_capped, F.col("_weight"))), F.lit(0.0)),
        ).first()
        if n == capped or not open_weight:
            break
        level, capped = (total - fixed) / open_weight, n
    target = F.least(cap, F.lit(level) * F.col("_weight"))
    return weighted.select(*sizes.columns, target.alias("target"))


def _uniform(*parts: object) -> float:
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return (int.from_bytes(digest, "big") >> 11) / (1 << 53)


def _pivot(a: tuple[float, float], b: tuple[float, float], u: float) -> tuple[float, float]:
    """One step between fractions ``p`` and sizes ``s``: ``p_a s_a + p_b s_b`` stays, one becomes 0 or 1."""
    (p, s), (q, t) = a, b
    give, take = min((1 - p) * s, q * t), min(p * s, (1 - q) * t)
    if u * (give + take) < take:
        p, q = (1.0, q - give / t) if give == (1 - p) * s else (p + give / s, 0.0)
    else:
        p, q = (0.0, q + take / t) if take == p * s else (p - take / s, 1.0)
    return min(max(p, 0.0), 1.0), min(max(q, 0.0), 1.0)


def _fold(rows: DataFrame, round_number: int, seed: int) -> DataFrame:
    """Let the fractions of each (source, bucket) meet; at most one per bucket stays open."""
    columns = rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, held = None, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                at = (row.src, row.bucket)
                if at != where:
                    if held is not None:
                        out.append(held)
                    where, held = at, None
                if held is None:
                    held = row
                    continue
                u = _uniform(seed, round_number, row.key, held.key)
                p, q = _pivot((held.part, held.words), (row.part, row.words), u)
                held, row = held._replace(part=p), row._replace(part=q)
                if 0.0 < q < 1.0:
                    held, row = row, held
                out.append(row)
                if not 0.0 < held.part < 1.0:
                    out.append(held)
                    held = None
            yield pd.DataFrame(out, columns=columns)
        if held is not None:
            yield pd.DataFrame([held], columns=columns)

    dealt = rows.repartition("src", "bucket").sortWithinPartitions(
        "src", "bucket", F.col("words").desc(), "key", "ident"
    )
    return dealt.mapInPandas(run, rows.schema)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_copies: float = MAX_COPIES,
    seed: int = 1,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Per document ``doc_id, text_hash, source, size, source_size, target, copies``.

    ``copies`` is how often the mix takes the document; never more than ``max_copies`` rounded up.
    """
    rows = pin(
        docs.select(
            F.col(id_column).alias("doc_id"),
            F.xxhash64(whole(text)).alias("text_hash"),
            F.col(source).alias("source"),
            F.size(words_of(text)).cast("long").alias("size"),
        ),
        "sized",
    )
    targets = pin(
        source_targets(
            rows.groupBy("source").agg(
                F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size")
            ),
            weights,
            max_copies,
        ),
        "targets",
    ).withColumn("src", F.xxhash64("source"))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = F.when(F.col("size") > 0, wanted).otherwise(0.0)
    limit = F.lit(int(max_copies))
    expected = rows.join(
        broadcast_if_small(targets.withColumnRenamed("source", "_source")),
        F.col("source").eqNullSafe(F.col("_source")),
    ).select(
        F.col("src"),
        F.coalesce("rows", F.lit(0)).alias("n_rows"),
        F.xxhash64(F.lit(seed), "doc_id", "text_hash").alias("key"),
        F.col("doc_id").cast("string").alias("ident"),  # pandas has no integers with nulls
        F.col("text_hash").alias("thash"),
        F.col("source").alias("name"),
        F.col("size").alias("words"),
        F.col("source_size").alias("of_source"),
        F.col("target").alias("goal"),
        F.least(F.floor(wanted), limit).cast("int").alias("certain"),
        F.greatest(F.least(wanted - F.floor(wanted), F.lit(1.0)), F.lit(0.0)).alias("part"),
    )
    settled = expected.where((F.col("part") <= 0) | (F.col("part") >= 1)).drop("n_rows")
    buckets = F.ceil(F.col("n_rows") / BUCKET_ROWS)
    open_rows = (
        expected.where((F.col("part") > 0) & (F.col("part") < 1))
        .withColumn("bucket", F.pmod(F.col("key"), buckets).cast("long"))
        .drop("n_rows")
    )
    done, round_number = [settled], 0
    most = (targets.agg(F.max("rows")).first()[0] or 0) // BUCKET_ROWS + 1
    while True:
        folded = pin(_fold(open_rows, round_number, seed), f"mix-round-{round_number}")
        is_open = (F.col("part") > 0) & (F.col("part") < 1)
        done.append(folded.where(~is_open).drop("bucket"))
        left = folded.where(is_open)
        if most <= 1:
            break
        most = -(-most // FANOUT)
        open_rows = left.withColumn("bucket", F.expr(f"bucket div {FANOUT}"))
        round_number += 1
    # One open fraction per source: drawn by a hash.
    draw = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "key"), F.lit(1 << 30)) / float(1 << 30)
    done.append(left.withColumn("part", (draw < F.col("part")).cast("double")).drop("bucket"))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(
        F.col("ident").cast(rows.schema["doc_id"].dataType).alias("doc_id"),
        F.col("thash").alias("text_hash"),
        F.col("name").alias("source"),
        F.col("words").alias("size"),
        F.col("of_source").alias("source_size"),
        F.col("goal").alias("target"),
        (F.col("certain") + F.round("part").cast("int")).alias("copies"),
    )


def repeat_documents(docs: DataFrame, seed: int = 1) -> DataFrame:
    """The mixed collection itself: each document as often as the mix takes it.

    Rows that agree in source, id and text are interchangeable, so their copies are summed up and
    given out again from one of them.
    """
    same = ["_id", "_text", "_name"]
    names = {c: own(c) for c in same}
    copies = (
        mix(docs, seed=seed)
        .where(F.col("copies") > 0)
        .groupBy("doc_id", "text_hash", "source")
        .agg(F.sum("copies").alias("_copies"))
    )
    keyed = docs.withColumns(
        {
            names["_id"]: F.col("doc_id"),
            names["_text"]: F.xxhash64(whole("text")),
            names["_name"]: F.col("source"),
        }
    )
    on: Column = (
        keyed[names["_text"]].eqNullSafe(copies["text_hash"])
        & keyed[names["_id"]].eqNullSafe(copies["doc_id"])
        & keyed[names["_name"]].eqNullSafe(copies["source"])
    )
    taken = keyed.join(copies.hint("shuffle_hash"), on).select(
        *[keyed[c] for c in docs.columns], *[keyed[c] for c in names.values()], "_copies"
    )
    once = taken.dropDuplicates(list(names.values()))
    return once.select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias(own("copy"))
    ).select(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )
