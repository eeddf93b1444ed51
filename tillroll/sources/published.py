"""A layer of tables that readers see change as a whole.

    <root>/_data/<table>/run=<run>/[<day column>=<day>/]   written once by a run, never changed
    <root>/_versions/<number>.json                         which folders make up each table

A run writes new folders beside those in use and then creates the next version file, which appears whole or
not at all. Readers follow the highest version. So a run that breaks off anywhere, or loses its driver, leaves
the tables as they were, and no reader meets a new history beside an old fact. Of two runs that start from one
version only the first is published. Names with an underscore keep plain directory reads from mixing runs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll.sources.files import children, create_whole, delete, partition_dirs, read_text

_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
# The fact's hashed keys are hexadecimal text, which this halves.
_CODEC = "zstd"
_DAY_TYPES = (T.DateType, T.IntegerType, T.LongType)

Day = date | int | None


class LayerChanged(RuntimeError):
    """Another run was published since this one began."""


def _day_dir(column: str, day: Day) -> str:
    if day is None:
        return f"{column}={_NO_DAY}"
    return f"{column}={day.isoformat() if isinstance(day, date) else day}"


class Layer:
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def versions(self, spark: SparkSession) -> list[int]:
        names = children(spark, f"{self.root}/_versions")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def _version_file(self, number: int) -> str:
        return f"{self.root}/_versions/{number:010d}.json"

    def _tables(self, spark: SparkSession, number: int) -> dict[str, Any]:
        return json.loads(read_text(spark, self._version_file(number))) if number else {}

    def _folder(self, table: str) -> str:
        return f"{self.root}/_data/{table}"

    def _open(self, spark: SparkSession, table: str, entry: dict[str, Any]) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        if entry["by"] is None:
            return spark.read.schema(schema).parquet(f"{self._folder(table)}/run={entry['run']}")
        if not entry["days"]:
            return spark.createDataFrame([], schema)
        paths = [f"{self._folder(table)}/run={run}/{day}" for day, run in sorted(entry["days"].items())]
        with_run = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
        stored = spark.read.schema(with_run).option("basePath", self._folder(table)).parquet(*paths)
        return stored.select(*schema.names)

    def read(self, spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
        """A table as last published, or as of a version that is still kept.

        The frame keeps to the version it was opened with, whatever is published while it is used.
        """
        number = max(self.versions(spark), default=0) if version is None else version
        tables = self._tables(spark, number)
        if table not in tables:
            raise LookupError(f"{table} was never published in {self.root}")
        return self._open(spark, table, tables[table])

    def next(self, spark: SparkSession) -> Draft:
        """A run's changes; published on leaving the ``with`` block, dropped if it is left by an error."""
        return Draft(self, spark)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete all but the last ``keep`` versions and the folders only those named; returns the folders.

        Folders of a run still at work stay. Readers of older versions must be done.
        """
        if keep < 1:
            raise ValueError("the current version is always kept")
        numbers = self.versions(spark)
        current = max(numbers, default=0)
        for number in numbers[:-keep]:
            delete(spark, self._version_file(number))
        used = {
            (table, run)
            for number in numbers[-keep:]
            for table, entry in self._tables(spark, number).items()
            for run in ([entry["run"]] if entry["by"] is None else entry["days"].values())
        }
        dropped = 0
        for table in children(spark, f"{self.root}/_data"):
            for name in partition_dirs(spark, self._folder(table), "run"):
                run = name.removeprefix("run=")
                begun_from = int(run.split("-")[0])
                if (table, run) not in used and begun_from < current:
                    delete(spark, f"{self._folder(table)}/{name}")
                    dropped += 1
        return dropped


class Draft:
    def __init__(self, layer: Layer, spark: SparkSession):
        self._layer, self._spark = layer, spark
        self._base = max(layer.versions(spark), default=0)
        self._run = f"{self._base:010d}-{uuid.uuid4().hex}"
        self._tables = layer._tables(spark, self._base)
        self._written: set[str] = set()

    def write(
        self,
        table: str,
        df: DataFrame,
        by: str | None = None,
        days: Iterable[Day] | None = None,
        laid_out: bool = False,
    ) -> None:
        """Store a table; others see it once the run is published.

        ``by`` names a day column (date or integer) that becomes the folder level, so that readers of some days
        open only those. ``days`` limits the change to these days, of which ``df`` is the whole content; the
        other days stay in the folders they are in. Without it the table is replaced, also by nothing. ``laid_out``
        states that the rows already lie by day in few files each, and need no shuffle to be written so.
        """
        if table in self._written:
            raise ValueError(f"{table} was already written by this run")
        if by is not None and not isinstance(df.schema[by].dataType, _DAY_TYPES):
            raise TypeError(f"{by} is neither a date nor an integer")
        if days is not None and by is None:
            raise ValueError("days need a day column")
        self._written.add(table)
        folder = f"{self._layer._folder(table)}/run={self._run}"
        entry: dict[str, Any] = {"schema": df.schema.jsonValue(), "by": by}
        if by is None:
            df.write.option("compression", _CODEC).parquet(folder)
            entry["run"] = self._run
        else:
            rows = df if laid_out else df.hint("rebalance", by)
            rows.write.option("compression", _CODEC).partitionBy(by).parquet(folder)
            new = partition_dirs(self._spark, folder, by)
            entry["days"] = {**self._days_left(table, entry, days, new), **dict.fromkeys(new, self._run)}
        self._tables[table] = entry

    def read(self, table: str) -> DataFrame:
        """A table as this run leaves it."""
        if table not in self._tables:
            raise LookupError(f"{table} was neither written nor published")
        return self._layer._open(self._spark, table, self._tables[table])

    def store(self, table: str, df: DataFrame, by: str | None = None) -> DataFrame:
        """Replace a table and go on from the stored copy."""
        self.write(table, df, by)
        return self.read(table)

    def _days_left(
        self, table: str, entry: dict[str, Any], days: Iterable[Day] | None, new: set[str]
    ) -> dict[str, str]:
        if days is None:
            return {}
        scope = {_day_dir(entry["by"], day) for day in days}
        if new - scope:
            raise ValueError(f"rows outside the days to replace: {sorted(new - scope)[:5]}")
        old = self._tables.get(table)
        if old is None:
            return {}
        columns = [{f["name"]: f["type"] for f in e["schema"]["fields"]} for e in (old, entry)]
        if old["by"] != entry["by"] or columns[0] != columns[1]:
            raise ValueError(f"{table} has other columns or days; replace it as a whole")
        return {day: run for day, run in old["days"].items() if day not in scope}

    def publish(self) -> int:
        """Make the run's tables the current ones, all at once; returns the version's number."""
        number = self._base + 1
        text = json.dumps(self._tables)
        if not create_whole(self._spark, self._layer._version_file(number), text):
            raise LayerChanged(f"version {number} of {self._layer.root} was published by another run")
        return number

    def drop(self) -> None:
        for table in self._written:
            delete(self._spark, f"{self._layer._folder(table)}/run={self._run}")

    def __enter__(self) -> Draft:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            try:
                self.publish()
            except LayerChanged:
                self.drop()
                raise
        else:
            self.drop()
