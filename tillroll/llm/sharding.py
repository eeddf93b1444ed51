"""Shards that all hold the mixture of the sources: proportional stratified interleaving.

1. Rows are put into a seeded random order within their source, which gives each a rank.
2. All rows are put in order of their fractional rank ``(rank + 1/2) / rows of the source``. In that
   order every stretch holds each source in proportion.
3. The order is cut into equal stretches, the shards. Row counts differ by one at most.

Both orders are made by range partitions whose sizes are summed up, so no source, however hot, meets
in one task, and only keys are moved, not texts. Texts are read in one scan that stores sizes and checksums.

Defined cases: a missing source is a source of its own; a missing text has no bytes. Rows that agree in
id, source and text are interchangeable. Fewer rows than shards leave shards empty; an empty table gives
an empty result. Extra columns are left out unless named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.text import own, read, whole
from tillroll.operators.dense_key import number_in_order
from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin

SHARDS = 40
OVERHEAD_BYTES = 16


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = 1,
    id_column: str = "doc_id",
    source: str = "source",
    text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` per row, and the columns named in ``carry``."""
    s, mixed, place, row = own("source"), own("mixed"), own("place"), own("row")
    ident = own("id")
    rows = docs.select(
        *[F.col(c) for c in carry],
        F.col(id_column).alias(ident),
        F.col(source).alias(s),
        (F.octet_length(whole(text)) + OVERHEAD_BYTES).cast("long").alias("size"),
        F.crc32(whole(text).cast("binary")).alias("text_crc32"),
    ).withColumn(mixed, F.xxhash64(F.lit(seed), ident, "text_crc32"))
    # A range shuffle reads its input twice; the texts are read once, unless they are carried along.
    rows = rows if carry else pin(rows, "sizes")
    by_source = number_in_order(
        rows, place, [F.col(c).asc_nulls_last() for c in (s, mixed, ident, "size", "text_crc32")]
    )
    first, count = own("first"), own("count")
    bounds = (
        by_source.groupBy(F.col(s).alias("_s"))
        .agg(F.min(place).alias(first), F.count(F.lit(1)).alias(count))
    )
    fraction = own("fraction")
    ranked = by_source.join(
        broadcast_if_small(bounds), F.col(s).eqNullSafe(F.col("_s")), "left"
    ).withColumn(fraction, (F.col(place) - F.col(first) + 0.5) / F.col(count))
    interleaved = number_in_order(
        ranked.drop("_s", first, count),
        row,
        [F.col(fraction), F.col(s).asc_nulls_last(), F.col(place)],
    )
    # The rows are dense, so their number is the highest place.
    total = by_source.agg(F.max(place)).first()[0] or 0
    at = F.col(row) - 1
    shard = F.expr(f"(`{row}` - 1) * {shards} div {max(total, 1)}")
    # First row of shard k: the smallest row with row * shards >= k * total.
    start = F.expr(
        f"((({row} - 1) * {shards} div {max(total, 1)}) * {total} + {shards - 1}) div {shards}"
    )
    return interleaved.select(
        *carry,
        F.col(ident).alias(id_column),
        "size",
        "text_crc32",
        shard.cast("int").alias("shard"),
        (at - start).cast("long").alias("slot"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
