"""Incremental ingestion: new files once each, new ids once each, through Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest_new_files(spark: SparkSession, source: str, checkpoint: str, write: Callable[[DataFrame, int], None], *, schema: str, fmt: str = "parquet", **options: str) -> StreamingQuery:
    """Hand every file that has appeared since the last run to write(rows, batch), then stop.

    The checkpoint remembers files, so a run after a failure repeats its batch under the same number; a
    write that replaces its own partition is then exact.
    """
    rows = spark.readStream.format(fmt).schema(schema).options(**options).load(source)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_partitions(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """A write that replaces the partitions (by key) that a batch touches, and no others."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)

    return write


def once_per_id(stream: DataFrame, ids: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each id; ids are forgotten once the watermark has passed them by `delay`."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(ids)


def windowed_counts(stream: DataFrame, time: str, by: list[str], width: str, delay: str, slide: str | None = None) -> DataFrame:
    """Counts per event-time window and group, closed by the watermark."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, delay).groupBy(window, *by).agg(F.count("*").alias("n"))
