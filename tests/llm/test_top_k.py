"""Exact top-k search against all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import top_k_search
from tillroll.llm.top_k_search import Best, Block, quantized, search_block, search_shard, top_k

SCHEMA = "vec_id long, embedding array<float>, query_id string, score string"


def plain(rows, k, step):
    sound = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q in sorted({(i, tuple(v)) for i, v in sound if i % step == 0}):
        scored = sorted(
            (-sum(a * b for a, b in zip(q[1], v, strict=False)), i) for i, v in sound if i != q[0]
        )
        out += [(q[0], rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, k=5, step=5):
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    sound = table.select("vec_id", quantized(F.col("embedding")).alias("vector")).where(
        "vec_id is not null and vector is not null"
    )
    asked = sound.where(F.col("vec_id") % step == 0).withColumnRenamed("vec_id", "query_id")
    out = top_k(sound, asked, k)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, out.collect()))


def vectors(count, width, seed):
    dice = np.random.default_rng(seed)
    return [(k, [float(np.float32(x)) for x in dice.normal(0, 0.2, width)]) for k in range(count)]


@pytest.mark.parametrize("sizes", [(8192, 4096, 1024), (16, 7, 5)])
def test_equals_all_scores(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD_ROWS", "QUERY_ROWS", "BLOCK_ROWS"), sizes, strict=True):
        monkeypatch.setattr(top_k_search, name, value)
    nan, inf = float("nan"), float("inf")
    rows = vectors(150, 12, 1)
    rows += [(k, rows[3][1]) for k in range(150, 190)]  # ties
    rows += [(200, None), (205, [1.0, None]), (210, [nan] * 12), (215, [inf] + [0.0] * 11), (None, [1.0] * 12)]
    rows += [(220, []), (225, [1.0]), (-5, [-3.0] * 12), (5, rows[5][1]), (10, [0.5] * 12)]
    assert found(spark, rows) == plain(rows, 5, 5)


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (51, [-1.0, 0.0])]
    assert found(spark, rows, step=50) == plain(rows, 5, 50)
    assert found(spark, [(0, [1.0])], step=50) == []
    assert found(spark, [(1, [1.0])], step=50) == []
    assert found(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**22, 1.0]), (1, [2.0**22, 3.0]), (2, [2.0**22, 2.0]), (3, [2.0**23, -1.0]), (4, [1e30, 0.0])]
    wide = [(i, v) for i, v in rows if i < 4]
    assert found(spark, wide, step=50) == plain(wide, 5, 50)
    assert found(spark, rows, step=50)[0][2:] == (4, 2**63 - 1)


def test_blocks_are_skipped_and_postings_left_alone():
    """The search is no full scan: blocks that cannot compete are not multiplied, and terms are probed for few."""
    dice = np.random.default_rng(7)
    good = np.round(dice.normal(0, 10, (200, 16))) + 40
    weak = np.round(dice.normal(0, 1, (200, 16)))
    query = np.full(16, 5.0)
    best = Best(5)
    search_block(Block(np.arange(200), good), query, -1, best)

    class Untouched:
        def __getitem__(self, _):
            raise AssertionError("postings of a block that cannot compete were read")

    block = Block(np.arange(200, 400), weak)
    block.postings = Untouched()
    search_block(block, query, -1, best)
    expected = sorted(zip(-(good @ query), range(200), strict=True))[:5]
    assert [(-s, i) for s, i in zip(best.scores, best.ids, strict=True)] == expected


def test_shards_of_integers():
    dice = np.random.default_rng(9)
    rows = dice.integers(-300, 300, (3000, 20))
    queries = rows[::100]
    ids = np.arange(3000)
    for place, got, scores in search_shard(ids, rows, ids[::100], queries, 5):
        all_scores = rows @ queries[place]
        want = sorted((-s, i) for i, s in enumerate(all_scores.tolist()) if i != place * 100)[:5]
        assert [(-int(s), int(i)) for s, i in zip(scores, got, strict=True)] == want
