"""Where the copies of each event lie: a stored table of (event, day, landing date) by hash bucket of the event.

A batch asks for its own events. It reads the buckets that they fall into and no others, and of those the narrow
index columns alone; the answer names the days and landing partitions that hold earlier copies, so that neither the
raw layer nor a store has to be searched for them. The index only grows: an entry that was written stays true, and
writing it again, as a repeated batch does, changes nothing. ``compact`` rewrites it with each entry once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.sizes import broadcast_if_small
from tillroll.scratch import pin, scratch_scope
from tillroll.sources.files import exists

SCHEMA = "event_id string, event_day date, ingest_date date, bucket int"
BUCKETS = 64


@dataclass(frozen=True)
class DayIndex:
    path: str
    buckets: int = BUCKETS

    def bucket(self) -> Column:
        """Events without id are one event, in one bucket."""
        return F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def entries(self, rows: DataFrame, day: Column, landed: Column) -> DataFrame:
        """The distinct entries of ``rows``, which have an ``event_id``."""
        return rows.select(
            "event_id", day.alias("event_day"), landed.cast("date").alias("ingest_date"), self.bucket()
        ).distinct()

    def ids(self, rows: DataFrame) -> DataFrame:
        return rows.select("event_id", self.bucket()).distinct()

    def exists(self, spark: SparkSession) -> bool:
        return exists(spark, self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        if not self.exists(spark):
            return spark.createDataFrame([], SCHEMA)
        return spark.read.schema(SCHEMA).parquet(self.path)

    def copies_of(self, ids: DataFrame) -> DataFrame:
        """The stored entries of the events in ``ids``; a frame of ``event_id, bucket`` that is read twice."""
        spark = ids.sparkSession
        asked = [r.bucket for r in ids.select("bucket").distinct().collect()]  # at most one per bucket
        stored = self.read(spark).where(F.col("bucket").isin(asked))
        return stored.join(broadcast_if_small(ids.drop("bucket")), same_event(stored, ids), "left_semi")

    def add(self, entries: DataFrame) -> None:
        entries.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(self.path)

    def compact(self, spark: SparkSession) -> None:
        """Each entry once, in as few files as the buckets need."""
        with scratch_scope(spark):
            kept = pin(self.read(spark).distinct(), "index")
            (
                kept.hint("rebalance", "bucket")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("bucket")
                .parquet(self.path)
            )


def same_event(left: DataFrame, right: DataFrame) -> Column:
    return left["event_id"].eqNullSafe(right["event_id"])


def of_events(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of the events in ``ids``."""
    return rows.join(broadcast_if_small(ids.select("event_id")), same_event(rows, ids), "left_semi")


def of_other_events(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(ids.select("event_id")), same_event(rows, ids), "left_anti")
