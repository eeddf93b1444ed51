"""A training corpus from the documents table, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its result is
written as Parquet and read again as the next one's documents. All but the last return the columns of
documents.

1. quality rules: documents that a rule or their host's verdict rejects go
2. near duplicates: one document of each class of the n-gram Jaccard join stays; here a link is a Jaccard of
   0.8 or more over shingles of five words (``op2_ngram_jaccard_join`` has its own values)
3. secrets: every reported span is masked
4. mixture: documents are left out or repeated, so that sources reach their target weights
5. packing: all documents as token sequences of fixed length, with their ids

A stage reads what it pinned in the shared folder until its result is stored. When the next stage is called,
that is done, and it deletes the pins of the stage before.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import mixing, ngram_join, packing, quality_rules, secret_scans
from tillroll.llm.text import read
from tillroll.scratch import noting_pins, pin, release

NEAR_WORDS = 5
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Pins of the last stage called in this thread.
_pins: ContextVar[list[str] | None] = ContextVar("pipeline_pins", default=None)


def tidy(stage: Stage) -> Stage:
    @wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _pins.get() or [])
        paths: list[str] = []
        _pins.set(paths)
        with noting_pins(paths):
            return stage(spark, docs, sf_dir)

    return call


@tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


@tidy
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scans.mask_secrets(docs)


@tidy
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_documents(docs)


@tidy
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.public_tokenizer(), carry=["doc_id", "source"], with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scans", secrets),
    ("mixing", mixture),
    ("best_fit_packing", packed),
]

# Connected classes, dependent rounding and packing are beyond SQL; tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
