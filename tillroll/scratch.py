"""Shared scratch space for results that must be written once before they are used."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.files import delete

_SETTING = "spark.checkpoint.dir"

# Paths handed out inside the innermost ``scratch_scope`` of this thread or task.
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: as the cluster names it, else below the session's warehouse."""
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete on exit what was pinned inside. For jobs that store their results before they leave.

    Each thread has its own scope, so jobs that run side by side never delete each other's pins.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            delete(spark, path)


@contextmanager
def noting_pins(paths: list[str]) -> Iterator[None]:
    """Note in ``paths`` what is pinned inside, for the caller to delete once it is no longer read."""
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete noted pins and forget them."""
    while paths:
        delete(spark, paths.pop())


def pin(df: DataFrame, label: str, by: str | None = None, codec: str = "snappy") -> DataFrame:
    """Write a frame once and go on from the stored copy.

    Cuts the lineage on storage that outlives executors, gives the optimizer real sizes, and
    fixes values that depend on row placement. ``by``, the last column, becomes the folder level.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    rows = df if by is None else df.hint("rebalance", by)
    rows.write.option("compression", codec).parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)
