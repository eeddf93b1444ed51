"""Type 2 history kept up to date by batches of snapshots, with surrogate keys that stay.

Three stored tables, each by hash bucket of the natural key:

``log``       the snapshots of each batch, narrow, in a folder per batch
``keys``      the register: which surrogate was given to which (natural key, start day), in a folder per batch
``versions``  the history as it stands

A batch reads, of the log and the register, the buckets that its own keys fall into, makes the versions of those
buckets anew and replaces them. It reads neither the raw nor the clean layer. A snapshot may come for any day: one
after all others closes the open range, one between others splits a range, one for a day that is stored takes the
place of the earlier, and a withdrawn day counts as never reported.

The versions equal those of a full run over all snapshots. Surrogates do not: a version keeps the one it was given
for as long as a version of its natural key starts on that day, and a surrogate that fell out of use is given to no
other, so stored facts stay right. They are consecutive in the order (batch, natural key, start day).

A batch can be repeated while it is the last one: its folders are replaced and it sees batches before it only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.dense_key import number_in_order
from tillroll.operators.history import CUSTOMER_CARRIED, CUSTOMER_TRACKED, change_points, validity_ranges
from tillroll.scratch import pin, scratch_scope
from tillroll.sources.files import children, drop_partition_dirs

_RANGE = "effective_start_date date, effective_end_date date, is_current boolean"
_START = "effective_start_date"


@dataclass(frozen=True)
class HistoryStore:
    """``types`` gives the type of the natural key, the tracked and the carried columns.

    Needs at most one snapshot per natural key and day in a batch, as the clean layer has it; of several the greatest
    counts. A natural key's rows are bounded by its days and their corrections, and so is what one window task holds.
    """

    path: str
    key: str
    tracked: list[str]
    carried: list[str]
    ts: str
    surrogate: str
    types: dict[str, str] = field(default_factory=dict)
    buckets: int = 64

    def _columns(self) -> list[str]:
        return [self.key, *self.tracked, *self.carried]

    def _typed(self, columns: list[str]) -> str:
        return ", ".join(f"{c} {self.types.get(c, 'string')}" for c in columns)

    def _read(self, spark: SparkSession, table: str, schema: str) -> DataFrame:
        path = f"{self.path}/{table}"
        if not children(spark, path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(T.StructType.fromDDL(schema)).parquet(path)

    def _log(self, spark: SparkSession) -> DataFrame:
        return self._read(
            spark, "log", f"{self._typed(self._columns())}, {self.ts} timestamp, reported boolean, batch int, bucket int"
        )

    def read_keys(self, spark: SparkSession) -> DataFrame:
        """The register."""
        return self._read(
            spark, "keys", f"{self.surrogate} bigint, {self._typed([self.key])}, {_START} date, batch int, bucket int"
        )

    def read(self, spark: SparkSession) -> DataFrame:
        """The history as it stands."""
        schema = f"{self.surrogate} bigint, {self._typed(self._columns())}, {_RANGE}, bucket int"
        return self._read(spark, "versions", schema).drop("bucket")

    def batches(self, spark: SparkSession) -> list[int]:
        """The numbers of the batches that were begun, in order."""
        names = children(spark, f"{self.path}/log")
        return sorted(int(name.removeprefix("batch=")) for name in names if name.startswith("batch="))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write_batch(self, df: DataFrame, table: str, number: int) -> None:
        by_bucket = df.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        by_bucket.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{table}/batch={number}")

    def _last_surrogate(self, spark: SparkSession, number: int) -> int:
        """The greatest one given before; it lies in the last batch that gave any."""
        keys = self.read_keys(spark)
        for batch in reversed([b for b in self.batches(spark) if b < number]):
            greatest = keys.where(F.col("batch") == batch).agg(F.max(self.surrogate)).first()[0]
            if greatest is not None:
                return greatest
        return 0

    def _standing(self, log: DataFrame) -> DataFrame:
        """The snapshot that counts for each natural key and day. One shuffle, by the key, serves the windows too."""
        row = F.struct("batch", "reported", self.ts, *self.tracked, *self.carried)
        latest = log.repartition(self.key).groupBy(self.key, F.to_date(self.ts)).agg(F.max(row).alias("_row"))
        return latest.where("_row.reported").select(self.key, "_row.*").drop("batch", "reported")

    def merge(self, snapshots: DataFrame, number: int, withdrawn: DataFrame | None = None) -> None:
        """Take in a batch. ``withdrawn`` has the natural key and a time on each day that holds no snapshot any more;
        where a batch withdraws and reports the same day, the report counts."""
        spark = snapshots.sparkSession
        if any(batch > number for batch in self.batches(spark)):
            raise ValueError(f"batch {number} comes after a later one")
        entries = snapshots.select(*self._columns(), self.ts, F.lit(True).alias("reported"))
        if withdrawn is not None:
            gone = withdrawn.select(self.key, self.ts, F.lit(False).alias("reported"))
            entries = entries.unionByName(gone, allowMissingColumns=True)
        with scratch_scope(spark):
            self._write_batch(entries, "log", number)
            log = self._log(spark)
            own = log.where(F.col("batch") == number).select("bucket").distinct()
            touched = [r.bucket for r in own.collect()]  # at most one per bucket
            self._replace(spark, log, touched, number)

    def _replace(self, spark: SparkSession, log: DataFrame, touched: list[int], number: int) -> None:
        here = F.col("bucket").isin(touched)
        points = change_points(
            self._standing(log.where(here)), self.key, self.tracked, self.carried, self.ts, already_distinct=True
        )
        versions = pin(validity_ranges(points, self.key, self.ts), "versions")
        register = self.read_keys(spark).where(here)
        unnamed = versions.select(self.key, _START).alias("v").join(
            self._known(register.where(F.col("batch") < number)), self._same_start(), "left_anti"
        )
        order = [F.col(self.key).asc_nulls_last(), F.col(_START).asc_nulls_last()]
        given = number_in_order(unnamed, self.surrogate, order)
        last = F.lit(self._last_surrogate(spark, number))
        self._write_batch(given.withColumn(self.surrogate, F.col(self.surrogate) + last), "keys", number)

        # Read again, now with the keys just given.
        known = self._known(self.read_keys(spark).where(here & (F.col("batch") <= number)))
        named = versions.alias("v").join(known, self._same_start())
        columns = [c.split()[0] for c in _RANGE.split(", ")]
        result = named.select(self.surrogate, *self._columns(), *columns, self._bucket().alias("bucket"))
        seen = Observation()
        (
            result.hint("rebalance", "bucket")
            .observe(seen, F.collect_set("bucket").alias("buckets"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(f"{self.path}/versions")
        )
        emptied = set(touched) - set(seen.get["buckets"])
        drop_partition_dirs(spark, f"{self.path}/versions", [f"bucket={b}" for b in emptied])

    def _known(self, register: DataFrame) -> DataFrame:
        return register.select(self.surrogate, F.col(self.key).alias("_owner"), F.col(_START).alias("_since"))

    def _same_start(self) -> Column:
        return F.col(f"v.{self.key}").eqNullSafe(F.col("_owner")) & F.col(f"v.{_START}").eqNullSafe(F.col("_since"))


def customer_history(path: str, buckets: int = 64) -> HistoryStore:
    """The store of ``dim_customer_scd2``, fed by staged profiles."""
    return HistoryStore(
        path, "customer_id", CUSTOMER_TRACKED, CUSTOMER_CARRIED, "snapshot_ts", "customer_sk", buckets=buckets
    )
