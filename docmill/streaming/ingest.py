"""Inbox ingestion in micro-batches and event analytics with watermarks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.schemas import BINARY_FILE


def inbox(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Stream of new PDF files below ``path``."""
    return spark.readStream.schema(BINARY_FILE).format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).load(path)


def run_once(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process all that is there and stop; a batch that failed is repeated by the next run."""
    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_always(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, seconds: float = 1.0) -> StreamingQuery:
    """Process what comes, looking every ``seconds``, until the returned query is stopped; a batch that failed is repeated by the next run."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def event_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def events_by_window(events: DataFrame, ts: str, by: str, value: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by event-time window; the same expression serves a stream and a table."""
    source = events.withWatermark(ts, late) if events.isStreaming else events
    return source.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")
