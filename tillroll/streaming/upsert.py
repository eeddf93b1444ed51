"""Incremental clean layer: each micro-batch brings its events into the days that they touch."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll import schemas
from tillroll.functions.scalars import parse_ts
from tillroll.operators.events import NullPolicy
from tillroll.operators.profiles import clean_customer_profiles
from tillroll.plans.silver import judged_events, split_judged
from tillroll.scratch import pin, scratch_scope
from tillroll.sources.files import exists
from tillroll.sources.lake import (
    Lake,
    read_clean_events,
    read_quarantine,
    read_raw_events,
    read_raw_profiles,
)
from tillroll.sources.sinks import overwrite_partitions
from tillroll.streaming.day_index import DayIndex, of_events, of_other_events

Days = list[date | None]

def day_of(ts: str) -> Column:
    return F.to_date(parse_ts(F.col(ts)))


def days_in(df: DataFrame, day: Column) -> Days:
    """At most one value per calendar day; None stands for unreadable times."""
    return [r.day for r in df.select(day.alias("day")).distinct().collect()]


def is_one_of(day: Column, days: Days) -> Column:
    found = day.isin([d for d in days if d is not None])
    return F.coalesce(found, F.lit(None in days))


def landed_for(raw: DataFrame, day: Column, days: Days) -> DataFrame:
    """Raw rows of ``days``, wherever they landed: a backfill may land under any date, also before its day."""
    return raw.where(is_one_of(day, days))


@dataclass(frozen=True)
class EventDays:
    """How a batch of raw events is brought into the clean days, in any order of landing.

    The index tells which of the batch's events came before and where their copies lie. For those only, the landing
    partitions that hold copies are read from the raw layer; an event that is new is all in the batch. Only the days
    that hold some are written anew: the stored rows of other events, and the newest copy of each event of the batch.
    The result is that of the batch job, whatever landed when: late, early, moved to another day or mended. A lake
    without an index gets one from its raw events first, unless they are the batch.

    ``copies_share_day`` promises that all copies of an event carry the same event time; then the days of the batch
    are computed anew from their raw rows, without an index.
    """

    lake: Lake
    schema: T.StructType = schemas.SALES_EVENTS_RAW
    tie_breakers: tuple[str, ...] | None = None
    null_policy: NullPolicy = "quarantine"
    copies_share_day: bool = False

    @property
    def index(self) -> DayIndex:
        return DayIndex(self.lake.event_index)

    def raw(self, spark: SparkSession) -> DataFrame:
        return read_raw_events(spark, self.lake.raw_events, self.schema)

    def entries(self, raw: DataFrame) -> DataFrame:
        return self.index.entries(raw, day_of("event_ts"), F.col("ingest_date"))

    def copies(self, spark: SparkSession, ids: DataFrame, landings: Days) -> DataFrame:
        """All raw copies of the events in ``ids``, from the partitions that hold some."""
        return of_events(self.raw(spark).where(is_one_of(F.col("ingest_date"), landings)), ids)

    def rebuild(self, spark: SparkSession, batch: DataFrame) -> None:
        """Idempotent: a repeated batch finds its own entries in the index and its events in the days."""
        with scratch_scope(spark):
            if self.copies_share_day:
                self._rebuild_days(spark, batch)
            else:
                self._merge(spark, batch)

    def _rebuild_days(self, spark: SparkSession, batch: DataFrame) -> None:
        days = days_in(batch, day_of("event_ts"))
        if days:
            if self.index.exists(spark):
                self.index.add(self.entries(batch))
            rows = landed_for(self.raw(spark), day_of("event_ts"), days)
            self._store(self._judged(rows), days)

    def _merge(self, spark: SparkSession, batch: DataFrame) -> None:
        if not self.index.exists(spark) and batch.count() != self.raw(spark).count():
            self.index.add(self.entries(self.raw(spark)))
        arrived = pin(self.entries(batch), "arrived")
        known = pin(self.index.copies_of(arrived.select("event_id", "bucket")), "known")
        landings = days_in(arrived.select("ingest_date").union(known.select("ingest_date")), F.col("ingest_date"))
        if not landings:
            return
        # Few events come again, so these joins are mostly broadcast and the batch's own rows stay where they are.
        before = pin(known.select("event_id").distinct(), "before")
        repeated = pin(self.copies(spark, before, landings), "repeated")
        copies = of_other_events(batch, before).unionByName(repeated)
        found = self.entries(repeated)
        # The index comes first: a batch that breaks off later then finds all days again.
        missing = found.exceptAll(known.select(*found.columns).distinct())
        self.index.add(of_other_events(arrived, before).unionByName(missing))
        days = days_in(arrived.unionByName(known).unionByName(found), F.col("event_day"))
        self._store(self._judged(copies), days, others=arrived)

    def _judged(self, raw: DataFrame) -> DataFrame:
        judged = judged_events(raw, self.tie_breakers, self.null_policy)
        return pin(judged.withColumn("event_date", day_of("event_ts")), "judged")

    def _store(self, judged: DataFrame, days: Days, others: DataFrame | None = None) -> None:
        """Write ``days`` anew: what is ``judged``, and what the days hold of events that are not in ``others``."""
        spark = judged.sparkSession
        split = split_judged(judged.where(is_one_of(F.col("event_date"), days)))
        by_day = [*self.schema.names, "event_date"]
        sides = [
            (split.clean, self.lake.clean_events, read_clean_events),
            (split.quarantine.select(*by_day), self.lake.quarantine, self._read_quarantine),
        ]
        for new, path, read in sides:
            if others is not None and exists(spark, path):
                stored = read(spark, path).where(is_one_of(F.col("event_date"), days))
                # Found by their ids alone; the whole rows are shuffled for it only if many are replaced.
                replaced = pin(of_events(stored.select("event_id"), others).distinct(), "replaced")
                # What is read here is removed when all of the new days are written.
                new = of_other_events(stored, replaced).unionByName(new)
            overwrite_partitions(new, path, "event_date", days)

    def _read_quarantine(self, spark: SparkSession, path: str) -> DataFrame:
        return read_quarantine(spark, path, self.schema)


@dataclass(frozen=True)
class ProfileDays:
    """How a set of snapshot days is computed anew; a snapshot belongs to its day alone."""

    lake: Lake
    schema: T.StructType = schemas.PROFILES_RAW
    tie_breakers: tuple[str, ...] | None = None

    def rebuild(self, spark: SparkSession, batch: DataFrame) -> None:
        days = days_in(batch, day_of("snapshot_ts"))
        if not days:
            return
        raw = read_raw_profiles(spark, self.lake.raw_profiles, self.schema)
        rows = landed_for(raw, day_of("snapshot_ts"), days)
        clean = clean_customer_profiles(rows, self.tie_breakers)
        dated = clean.withColumn("snapshot_date", F.to_date("snapshot_ts"))
        overwrite_partitions(dated, self.lake.clean_profiles, "snapshot_date", days)


def _follow(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rebuild: Callable[[SparkSession, DataFrame], None],
    checkpoint: str,
    max_files_per_batch: int | None,
) -> StreamingQuery:
    reader = spark.readStream.schema(schemas.with_partition(schema, "ingest_date"))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return (
        reader.parquet(path)
        .writeStream.foreachBatch(lambda batch, _: rebuild(batch.sparkSession, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _tuple(names: Iterable[str] | None) -> tuple[str, ...] | None:
    return None if names is None else tuple(names)


def start_incremental_clean(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    schema: T.StructType = schemas.SALES_EVENTS_RAW,
    tie_breakers: Iterable[str] | None = None,
    null_policy: NullPolicy = "quarantine",
    copies_share_day: bool = False,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """Follow the raw landing; after each batch the touched days hold what a full run would give.

    A later good copy clears an earlier reject, since both sides of a day are written anew.
    """
    days = EventDays(lake, schema, _tuple(tie_breakers), null_policy, copies_share_day)
    return _follow(spark, lake.raw_events, schema, days.rebuild, checkpoint, max_files_per_batch)


def start_incremental_profiles(
    spark: SparkSession,
    lake: Lake,
    checkpoint: str,
    schema: T.StructType = schemas.PROFILES_RAW,
    tie_breakers: Iterable[str] | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery:
    """The same for customer snapshots."""
    days = ProfileDays(lake, schema, _tuple(tie_breakers))
    return _follow(spark, lake.raw_profiles, schema, days.rebuild, checkpoint, max_files_per_batch)
