"""Streaming landing of raw events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions.scalars import parse_ts


def with_ingest_date(events: DataFrame) -> DataFrame:
    """The landing date follows from the arrival time; readers rely on that to prune."""
    return events.withColumn("ingest_date", F.to_date(parse_ts(F.col("ingest_ts"))))


def start_landing(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to ``ingest_date`` partitions, process what is there, stop.

    Works on any streaming source with the raw columns. The file sink's log makes each input row
    land exactly once, also over restarts; one directory must not mix it with batch landing.
    """
    return (
        with_ingest_date(events)
        .writeStream.format("parquet")
        .partitionBy("ingest_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
