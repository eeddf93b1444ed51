"""Where the layers live and how they are read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import schemas
from tillroll.sources.files import exists


@dataclass(frozen=True)
class Lake:
    """Roots of the layers: below one lake root, each movable on its own."""

    root: str
    bronze_root: str | None = None
    silver_root: str | None = None
    gold_root: str | None = None

    def _at(self, override: str | None, layer: str, *path: str) -> str:
        base = override or f"{self.root.rstrip('/')}/{layer}"
        return "/".join([base.rstrip("/"), *path])

    @property
    def raw_events(self) -> str:
        return self._at(self.bronze_root, "bronze", "sales_events")

    @property
    def raw_profiles(self) -> str:
        return self._at(self.bronze_root, "bronze", "customer_profile_snapshots")

    @property
    def clean_events(self) -> str:
        return self._at(self.silver_root, "silver", "sales_events_clean")

    @property
    def clean_profiles(self) -> str:
        return self._at(self.silver_root, "silver", "customer_profiles_clean")

    @property
    def quarantine(self) -> str:
        return self._at(self.silver_root, "silver", "_quarantine", "sales_events")

    @property
    def event_index(self) -> str:
        """Where the copies of each event lie; kept beside the clean layer by the incremental job."""
        return self._at(self.silver_root, "silver", "_index", "sales_events")

    @property
    def gold(self) -> str:
        """Root of the published layer; see ``sources.published``."""
        return self._at(self.gold_root, "gold")


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType | None, partition: str
) -> DataFrame:
    """A Parquet directory with one date partition column taken from the directory names.

    Without a schema the columns come from the file footers.
    """
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schemas.with_partition(schema, partition)).parquet(path)


def read_raw_events(
    spark: SparkSession, path: str, schema: T.StructType | None = schemas.SALES_EVENTS_RAW
) -> DataFrame:
    return read_partitioned(spark, path, schema, "ingest_date")


def read_raw_profiles(
    spark: SparkSession, path: str, schema: T.StructType | None = schemas.PROFILES_RAW
) -> DataFrame:
    return read_partitioned(spark, path, schema, "ingest_date")


def read_clean_events(spark: SparkSession, path: str) -> DataFrame:
    return read_partitioned(spark, path, schemas.SALES_EVENTS_CLEAN, "event_date")


def read_clean_profiles(spark: SparkSession, path: str) -> DataFrame:
    return read_partitioned(spark, path, schemas.PROFILES_CLEAN, "snapshot_date")


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reference data: CSV with a header line and declared types."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def read_seed_column(spark: SparkSession, path: str, schema: T.StructType, column: str) -> DataFrame:
    return read_seed(spark, path, schema).select(column)


def read_test_statuses(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per result in documents ``{"results": [{"status": ...}]}``.

    ``multi_line`` reads a document spread over lines, as a test runner writes it;
    otherwise each line is a document and large files are split among tasks.
    """
    documents = spark.read.schema(schemas.RUN_RESULTS).json(path, multiLine=multi_line)
    result = documents.select(F.explode("results").alias("result"))
    return result.select(F.coalesce("result.status", F.lit("unknown")).alias("status"))


def read_quarantine(
    spark: SparkSession, path: str, schema: T.StructType = schemas.SALES_EVENTS_RAW
) -> DataFrame | None:
    """The rejected rows, or None where nothing was ever written. A folder without files has no rows."""
    if not exists(spark, path):
        return None
    by_day = T.StructType([*schema.fields, T.StructField("event_date", T.DateType())])
    return spark.read.schema(by_day).parquet(path)
