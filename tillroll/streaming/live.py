"""Low-latency path: the latest copy of each event in a store by day, and revenue that follows from each change.

A batch asks the day index where earlier copies of its events lie, reads those days alone, and replaces what changed.
Revenue is maintained by signed differences: a replaced copy takes its old line out and puts its new one in, in
exact decimals, so nothing is summed up again. Each batch's differences are a folder of their own, complete or
not there, so a repeated batch counts once; ``fold`` sums up the folders so far.

By default nothing is too late: whatever comes late, moves to another day or has no readable time finds its place,
and clean and rejected events add up to the distinct events after each batch. With a ``lateness`` bound, days that
lie further back than it stay as they are: rows for them, and rows without readable time, go to a late table
instead, and the events of the store and of the late table together are all events.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillroll import schemas
from tillroll.functions.scalars import parse_ts
from tillroll.operators.events import NullPolicy, Split, dedupe_sales_events, verdict
from tillroll.plans.silver import split_judged
from tillroll.scratch import pin, scratch_scope
from tillroll.sources.files import children, exists
from tillroll.sources.lake import read_partitioned
from tillroll.sources.sinks import overwrite_partitions
from tillroll.streaming.day_index import DayIndex, of_events, of_other_events
from tillroll.streaming.upsert import day_of, days_in, is_one_of

# Fixed value: events arrive up to six hours late.
LATENESS_BOUND = "6 hours"


# Amounts that no decimal holds are counted by kind, so that they can be taken out again.
_DECIMAL = "decimal(18,2)"
_KINDS = ("n_nan", "n_up", "n_down", "n_huge")
_SUMS = ("n_transactions", "total_units_sold", "exact", "huge", *_KINDS)
CHANGES = (
    "store_id string, sales_date date, n_transactions long, total_units_sold long, exact decimal(38,2), huge double, "
    + ", ".join(f"{kind} long" for kind in _KINDS)
)


def signed_lines(clean: DataFrame, sign: int) -> DataFrame:
    """Sums of sales per store and day, to be added (1) or taken out (-1)."""
    amount = F.col("line_amount")
    exact = amount.try_cast(_DECIMAL)
    limit = F.lit(float("inf"))
    up, down = amount == limit, amount == -limit
    huge = exact.isNull() & amount.isNotNull() & ~F.isnan(amount) & ~up & ~down
    return (
        clean.where("event_type = 'sale'")
        .groupBy("store_id", F.to_date("event_ts").alias("sales_date"))
        .agg(
            (sign * F.count("event_id")).alias("n_transactions"),
            (sign * F.sum("quantity")).cast("long").alias("total_units_sold"),
            (sign * F.coalesce(F.sum(exact), F.lit(0).cast(_DECIMAL))).cast("decimal(38,2)").alias("exact"),
            (sign * F.coalesce(F.sum(F.when(huge, amount)), F.lit(0.0))).alias("huge"),
            *(
                (sign * F.count_if(F.coalesce(found, F.lit(False)))).alias(kind)
                for kind, found in zip(_KINDS, (F.isnan(amount), up, down, huge), strict=True)
            ),
        )
    )


def merged_changes(changes: DataFrame) -> DataFrame:
    """One row per store and day."""
    sums = {c: F.sum(c) for c in _SUMS}
    sums["exact"] = sums["exact"].cast("decimal(38,2)")
    return changes.groupBy("store_id", "sales_date").agg(*(v.alias(c) for c, v in sums.items()))


def _revenue() -> Column:
    whole = F.col("exact").cast("double") + F.when(F.col("n_huge") > 0, F.col("huge")).otherwise(0.0)
    nan, limit = F.lit(float("nan")), F.lit(float("inf"))
    no_number = (F.col("n_nan") > 0) | ((F.col("n_up") > 0) & (F.col("n_down") > 0))
    return F.when(no_number, nan).when(F.col("n_up") > 0, limit).when(F.col("n_down") > 0, -limit).otherwise(whole)


@dataclass(frozen=True)
class LiveTables:
    """The latest copy of each event by ``event_date``, the daily revenue that follows from it, and late rows."""

    root: str
    schema: T.StructType = schemas.SALES_EVENTS_RAW
    tie_breakers: tuple[str, ...] | None = None
    null_policy: NullPolicy = "quarantine"
    lateness: str | None = None

    @property
    def latest(self) -> str:
        return f"{self.root}/latest"

    @property
    def late(self) -> str:
        return f"{self.root}/late"

    @property
    def index(self) -> DayIndex:
        return DayIndex(f"{self.root}/index")

    def read_latest(self, spark: SparkSession) -> DataFrame:
        if not exists(spark, self.latest):
            return spark.createDataFrame([], schemas.with_partition(self.schema, "event_date"))
        return read_partitioned(spark, self.latest, self.schema, "event_date")

    def split(self, latest: DataFrame) -> Split:
        """Both sides, by ``event_date``. A row decides for itself: the store holds each event once."""
        return split_judged(latest.withColumn("_ok", verdict(self.null_policy)))

    # --- folders by batch: written in one go, and only there once they are complete ---

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/batch={batch}"

    def _complete(self, spark: SparkSession, kind: str) -> list[int]:
        numbers = (int(name.split("=")[1]) for name in children(spark, f"{self.root}/{kind}"))
        return sorted(n for n in numbers if exists(spark, f"{self._folder(kind, n)}/_SUCCESS"))

    def _write_once(self, df: DataFrame, kind: str, batch: int) -> None:
        if not exists(df.sparkSession, f"{self._folder(kind, batch)}/_SUCCESS"):
            df.write.mode("overwrite").parquet(self._folder(kind, batch))

    def _read(self, spark: SparkSession, kind: str, batches: list[int], schema: str | T.StructType) -> DataFrame:
        paths = [self._folder(kind, n) for n in batches]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    # --- revenue ---

    def changes(self, spark: SparkSession) -> DataFrame:
        """What the batches since the last fold changed, and that fold."""
        folded = self._complete(spark, "folded")
        since = [n for n in self._complete(spark, "changes") if not folded or n > folded[-1]]
        return self._read(spark, "changes", since, CHANGES).unionByName(
            self._read(spark, "folded", folded[-1:], CHANGES)
        )

    def fold(self, spark: SparkSession) -> None:
        """Sum up the changes so far into one folder; readers take it from then on."""
        batches = self._complete(spark, "changes")
        if batches:
            self._write_once(merged_changes(self.changes(spark)), "folded", batches[-1])

    def read_revenue(self, spark: SparkSession) -> DataFrame:
        return merged_changes(self.changes(spark)).where("n_transactions <> 0").select(
            "store_id", "n_transactions", "total_units_sold", _revenue().alias("total_revenue"), "sales_date"
        )

    # --- late rows ---

    def read_late(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "late", self._complete(spark, "late"), self.schema)

    def _closed_before(self, spark: SparkSession, batch: int) -> Column:
        """The time before which days are closed: the bound before the latest event time of earlier batches."""
        earlier = [n for n in self._complete(spark, "clock") if n < batch]
        newest = self._read(spark, "clock", earlier, "newest timestamp").agg(F.max("newest")).first()[0]
        return F.lit(newest).cast("timestamp") - F.expr(f"interval {self.lateness}")

    def _in_time(self, arrived: DataFrame, batch: int) -> DataFrame:
        spark, time = arrived.sparkSession, parse_ts(F.col("event_ts"))
        closed = self._closed_before(spark, batch)
        late = time.isNull() | F.coalesce(time < closed, F.lit(False))
        self._write_once(arrived.where(late).select(*self.schema.names), "late", batch)
        in_time = arrived.where(~late)
        self._write_once(in_time.agg(F.max(time).alias("newest")), "clock", batch)
        return in_time

    # --- batches ---

    def merge(self, batch: DataFrame, number: int) -> None:
        """Bring a batch into the tables; a batch that is repeated with its number changes nothing.

        What it changes of the revenue is written in one go, before the store. A batch that breaks off before that
        starts anew; one that breaks off later finds its changes complete and only goes on with the store.
        """
        spark = batch.sparkSession
        with scratch_scope(spark):
            arrived = batch.select(*self.schema.names).withColumn("event_date", day_of("event_ts"))
            arrived = pin(arrived, "arrived")
            if self.lateness:
                arrived = self._in_time(arrived, number)
            ids = pin(self.index.ids(arrived), "ids")
            known = pin(self.index.copies_of(ids), "known")
            found = self.index.entries(arrived, F.col("event_date"), F.lit(None))
            days = days_in(found.union(known.select(*found.columns)), F.col("event_day"))
            if not days:
                return
            stored = self.read_latest(spark).where(is_one_of(F.col("event_date"), days))
            old = pin(of_events(stored, ids), "old")
            new = pin(dedupe_sales_events(old.unionByName(arrived), self.tie_breakers), "new")
            changes = signed_lines(self.split(new).clean, 1).unionByName(signed_lines(self.split(old).clean, -1))
            self._write_once(merged_changes(changes), "changes", number)
            self.index.add(found.exceptAll(known.select(*found.columns).distinct()))
            latest = pin(of_other_events(stored, ids).unionByName(new), "latest")
            overwrite_partitions(latest, self.latest, "event_date", days)


def start_live(events: DataFrame, tables: LiveTables, checkpoint: str) -> StreamingQuery:
    return (
        events.writeStream.foreachBatch(lambda batch, number: tables.merge(batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
