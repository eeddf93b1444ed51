"""How results are stored."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.sources.files import drop_partition_dirs, partition_dirs

_NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _dir_name(column: str, value: date | None) -> str:
    return f"{column}={_NO_DATE if value is None else value.isoformat()}"


def land_batch(df: DataFrame, path: str, replay_dates: bool = False) -> None:
    """Raw landing by ``ingest_date``.

    Appends, as at-least-once delivery does; ``replay_dates`` instead replaces the dates in ``df``,
    for a batch that holds those dates completely.
    """
    writer = df.write.partitionBy("ingest_date")
    if replay_dates:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode("append").parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, column: str, scope: Iterable[date | None] | None = None
) -> int:
    """Replace the date partitions in ``scope`` by the rows of ``df``; returns the row count.

    ``df`` must be the complete content of the scope; None means the whole table. Partitions in
    scope that receive no row are removed, so nothing stale survives a re-run. Others stay as they
    are. The count and the written dates are observed during the write itself.

    Rows are rebalanced on the partition column: small dates share a task and file count stays low,
    while a date far larger than the others is split among several tasks.
    """
    spark = df.sparkSession
    seen = Observation()
    observed = df.hint("rebalance", column).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(column).alias("dates"),
        F.count_if(F.col(column).isNull()).alias("undated"),
    )
    before = partition_dirs(spark, path, column)
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    written = {_dir_name(column, d) for d in seen.get["dates"]}
    if seen.get["undated"]:
        written.add(_dir_name(column, None))
    in_scope = before if scope is None else {_dir_name(column, d) for d in scope}
    drop_partition_dirs(spark, path, (before & in_scope) - written)
    return seen.get["rows"]


def overwrite_flat(df: DataFrame, path: str) -> int:
    """Replace an unpartitioned table, also by nothing; returns the row count."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def save_table(df: DataFrame, path: str) -> DataFrame:
    """Materialise as a Parquet table and go on from the stored copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_catalog_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Materialise as a named table of the session catalog."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for reports that are already limited to a few rows."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, header=True)
