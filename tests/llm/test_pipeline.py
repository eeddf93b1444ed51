"""The pipeline's stages, each against a plain version on the rows it was given."""

from collections import Counter, defaultdict

import corpus_pipeline
from tests.llm import plain
from tillroll.scratch import pin

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    good = pin(stages["quality_rules"](spark, docs, SF), "t")
    assert good.columns == docs.columns
    passing = {r.doc_id for r in docs.collect() if not plain.quality(r.text)["base_failed"]}
    assert {r.doc_id for r in good.collect()} <= passing

    single = pin(stages["ngram_jaccard_join"](spark, good, SF), "t")
    classes = plain.classes([(r.doc_id, r.text) for r in good.collect()], percent=80, k=5)
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, (_, c) in classes.items() if i == c)

    masked = pin(stages["secret_scans"](spark, single, SF), "t")
    assert masked.columns == docs.columns and masked.count() == single.count()
    assert not any(plain.base_secrets(r.text) for r in masked.collect())

    mixed = pin(stages["mixing"](spark, masked, SF), "t")
    assert mixed.columns == docs.columns
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3

    packed = stages["best_fit_packing"](spark, mixed, SF).collect()
    pieces = Counter(r.doc_id for r in packed if r.piece == 0)
    assert pieces == Counter(r.doc_id for r in mixed.collect())
    room = defaultdict(int)
    for r in packed:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= 2048


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
