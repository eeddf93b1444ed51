"""Exact top-k inner products by MaxScore.

Each component of a vector is a pair of terms, one for each sign, and a vector stands in the postings of its
non-zero terms. A term's score bound for a query is the largest product it can reach in a block of vectors. With
the k-th best score so far as threshold, the terms of least bound whose bounds together stay below it are
*non-essential*: a vector that scores in no other term cannot enter the result. Only the postings of the essential
terms are traversed; the others are probed for vectors that can still compete, the larger bounds first, and a
vector is dropped as soon as its score so far and the bounds left stay below the threshold. A block whose bounds
together stay below the threshold is not touched.

Vectors lie in shards of about ``SHARD_ROWS`` rows, queries in groups of about ``QUERY_ROWS``; a task searches one
shard for one group, so its memory is bounded by both, and the shards' best are merged per query. Nothing is
broadcast. The work is that of the query set against all rows: it grows with their product.

Defined cases

- a vector that is null, empty of components to compare, or holds a null or non-finite component: an empty one has
  score 0 against all, the others take no part; a row without id takes no part, it could not be named
- vectors of unequal length: components that one of them lacks count 0
- repeated ids: every row is a candidate of its own; rows of the query's id are none of its candidates; a query id
  with two different vectors is asked with each, and its rows come twice
- ties: the smaller id; equal ids with equal scores are interchangeable
- components that pass 64 bits times 256 stand for the nearest 64-bit number, and so do scores
- an empty table, or no query in it: no rows. Extra columns are not looked at and not returned
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.text import read

# How many rows and queries meet in one task, and how many rows share their terms' bounds.
SHARD_ROWS = 8192
QUERY_ROWS = 4096
BLOCK_ROWS = 1024
# Non-essential terms probed between two looks at who still competes.
PROBES = 4

K = 5
SCALE = 256
QUERY_STEP = 50

_EXACT_FLOAT = 2**53
_EXACT_LONG = 2**62
_LONG = np.iinfo(np.int64)

FOUND = "query_id long, query_key long, vec_id long, score long"


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component as long; null where a component is null or not finite."""
    limit = F.lit(float("inf"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Block:
    """The postings of some vectors by term, and the terms' extremes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids = ids
        self.postings = np.ascontiguousarray(vectors.T)
        self.most = vectors.max(axis=0)
        self.least = vectors.min(axis=0)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The most that each component can add to a score in this block."""
        return np.maximum(query * self.most, query * self.least)


class Best:
    """The k best of one query so far."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)

    @property
    def threshold(self):
        """What a score must reach to matter; None while there are fewer than k."""
        return self.scores[-1] if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_block(block: Block, query: np.ndarray, own: int, best: Best) -> None:
    """Bring the block's vectors that belong to the k best into ``best``."""
    bounds = block.bounds(query)
    order = np.argsort(-bounds, kind="stable")
    # left[i]: what the terms from the i-th on can add at most
    left = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
    threshold = best.threshold
    if threshold is None:
        essential = len(order)
    elif left[0] < threshold:
        return
    else:
        # The longest tail of terms whose bounds stay below the threshold is non-essential.
        essential = int(np.flatnonzero(left >= threshold)[-1]) + 1
        essential = min(essential, len(order))
    first = order[:essential]
    scores = query[first] @ block.postings[first]
    if threshold is None:
        rows = np.arange(len(scores))
    else:
        rows = np.flatnonzero(scores + left[essential] >= threshold)
        scores = scores[rows]
    for at in range(essential, len(order), PROBES):
        if not len(rows):
            return
        terms = order[at : at + PROBES]
        scores = scores + query[terms] @ block.postings[np.ix_(terms, rows)]
        able = scores + left[min(at + PROBES, len(order))] >= threshold
        rows, scores = rows[able], scores[able]
    other = block.ids[rows] != own
    rows, scores = rows[other], scores[other]
    if len(rows) > best.k:
        # Ties at the k-th score are decided by id, so all of them go on.
        cut = np.partition(scores, len(scores) - best.k)[len(scores) - best.k]
        rows, scores = rows[scores >= cut], scores[scores >= cut]
    if len(rows):
        best.add(scores, block.ids[rows])


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = vector
    return out


def _numbers(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the plainest type that holds every score exactly."""

    def most(x: np.ndarray) -> int:
        return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))

    reach = most(rows) * most(queries) * max(1, rows.shape[1])
    kind = np.float64 if reach < _EXACT_FLOAT else np.int64 if reach < _EXACT_LONG else object
    return rows.astype(kind), queries.astype(kind)


def search_shard(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Place, ids and scores of the k best vectors of each query."""
    vectors, queries = _numbers(vectors, queries)
    blocks = [
        Block(ids[at : at + BLOCK_ROWS], vectors[at : at + BLOCK_ROWS])
        for at in range(0, len(ids), BLOCK_ROWS)
    ]
    for place, query in enumerate(queries):
        best = Best(k)
        best.scores = best.scores.astype(vectors.dtype)
        # The block that promises most comes first: it raises the threshold for the others.
        promise = [block.bounds(query).sum() for block in blocks]
        for at in sorted(range(len(blocks)), key=lambda i: -promise[i]):
            search_block(blocks[at], query, query_ids[place], best)
        yield place, best.ids, best.scores


def _searched(k: int):
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "query_key", "vec_id", "score")})
        width = max(1, queries["vector"].map(len).max(), rows["vector"].map(len).max())
        query_ids, keys = queries["query_id"].to_numpy(), queries["query_key"].to_numpy()
        parts = search_shard(
            rows["vec_id"].to_numpy(), _matrix(rows["vector"], width), query_ids, _matrix(queries["vector"], width), k
        )
        out = [
            pd.DataFrame(
                {
                    "query_id": query_ids[place],
                    "query_key": keys[place],
                    "vec_id": ids,
                    "score": [min(max(int(s), _LONG.min), _LONG.max) for s in scores],
                }
            )
            for place, ids, scores in parts
            if len(ids)
        ]
        return pd.concat(out) if out else _searched(k)(queries[:0], rows)

    return search


def _parts(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product with each query.

    ``rows`` has ``vec_id, vector``, ``queries`` has ``query_id, vector``; vectors are arrays of long.
    """
    asked = queries.select("query_id", "vector", F.xxhash64("query_id", "vector").alias("query_key")).distinct()
    shards, groups = _parts(rows, SHARD_ROWS), _parts(asked, QUERY_ROWS)
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).alias("cell_shard")
    group = F.pmod("query_key", F.lit(groups)).alias("cell_group")
    every_shard = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("cell_shard")
    every_group = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("cell_group")
    cells_asked = asked.select("*", group, every_shard)
    cells = rows.select("vec_id", "vector", shard, every_group)
    found = (
        cells_asked.groupBy("cell_shard", "cell_group")
        .cogroup(cells.groupBy("cell_shard", "cell_group"))
        .applyInPandas(_searched(k), FOUND)
    )
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op11_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "embeddings")
    rows = table.select("vec_id", quantized(F.col("embedding")).alias("vector")).where(
        "vec_id is not null and vector is not null"
    )
    queries = rows.where(F.col("vec_id") % QUERY_STEP == 0).withColumnRenamed("vec_id", "query_id")
    return top_k(rows, queries)
