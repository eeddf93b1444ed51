"""The near-duplicate stage against a plain version with shingles of five words and Jaccard 0.8."""

from collections import defaultdict

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from tests.llm import plain
from tests.llm.conftest import SCHEMA
from tillroll.llm.ngram_join import link_classes, one_of_each


def _classes(rows):
    sets = {i: plain.shingles(t, 5) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0:
                a_, b_ = sorted((find(a), find(b)))
                parent[b_] = a_
    groups = defaultdict(list)
    for i in sets:
        groups[find(i)].append(i)
    return groups


def test_stage_links_from_four_fifths_on(spark):
    rng = np.random.default_rng(7)
    base = [f"w{k}" for k in range(100)]
    rows = [(1, " ".join(base)), (2, " ".join([*base, *(f"n{k}" for k in range(22))]))]
    rows.append((3, " ".join([*base, *(f"m{k}" for k in range(40))])))
    for k in range(10, 60):
        words = [f"g{k % 5}x{j}" for j in range(120)]
        for at in rng.integers(0, 120, size=int(rng.integers(0, 6))):
            words[at] = f"e{k}x{at}"
        rows.append((k, " ".join(words)))
    groups = _classes(rows)
    assert sorted(groups[1]) == [1, 2] and 3 in groups
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").collect()) == sorted(groups)


def test_rows_are_decided_on_and_not_ids(spark):
    """An id with two texts keeps both if they belong to different classes; rows without id take part."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    c = " ".join(f"c{k}" for k in range(60))
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (None, a), (None, c), (None, c), (None, None), (4, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    kept = one_of_each(docs, words=5, percent=80).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == sorted([("1", a), ("2", b), ("None", c)])
    assert sorted((str(r.doc_id), r.text) for r in kept if not r.text) == [("4", ""), ("4", ""), ("None", None)]


def test_clashing_names(spark):
    texts = [" ".join(f"{x}{k}" for k in range(30)) for x in "aab"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    names = ["n", "first", "set_key", "text_key", "_class", "_gone", "h", "label", "_c0", "key", "members"]
    clashing = docs.withColumns({c: F.lit("x") for c in names})
    rows = link_classes(clashing, carry=names).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r["n"], r["_c0"]) for r in rows) == [
        (0, 27, 0, "x", "x"),
        (1, 27, 0, "x", "x"),
        (2, 27, 2, "x", "x"),
    ]
    left = one_of_each(clashing)
    assert left.columns == clashing.columns and sorted(r.doc_id for r in left.collect()) == [0, 2]


def test_bands_lose_no_link(spark):
    """Sizes right at the bound, across classes that share a hot passage."""
    rng = np.random.default_rng(3)
    hot = [f"hot{k}" for k in range(85)]
    rows = []
    for k in range(80):
        words = list(hot[: 85 - int(rng.integers(0, 15))])
        words += [f"t{int(rng.integers(0, 4))}x{j}" for j in range(int(rng.integers(0, 30)))]
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in link_classes(docs, words=1).collect()}
    assert found == plain.classes(rows, k=1)
