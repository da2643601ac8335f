"""Structured Streaming counterparts: micro-batch ingestion into the store, message deduplication, event-time corrections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.operators.exactly_once import IdentifierIndex
from ledgerloom.operators.late_events import DeltaLog, LateEvents
from ledgerloom.plans.store import TableStore


def read_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int = 16) -> DataFrame:
    """New files of a folder as a stream, with their names."""
    stream = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)
    return stream.withColumn("source_file", F.col("_metadata.file_path"))


def into_store(stream: DataFrame, store: TableStore, name: str, keys: list[str], content: str, order: Callable[[], list[Column]], checkpoint: str) -> StreamingQuery:
    """Upsert each micro-batch by key. A batch delivered again changes nothing: the store knows its number."""

    def merge(batch: DataFrame, number: int) -> None:
        store.upsert(name, batch, keys, content, order(), batch=f"{checkpoint}#{number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """One row per key within the watermark, with state that the watermark bounds."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def copies_by_index(stream: DataFrame, index: IdentifierIndex, key: Callable[[], list[Column]], row_id: str, arrival: str, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Feed micro-batches to a persistent identifier index; ``sink`` gets the row ids to drop. Exact over all history,
    where the watermark variant forgets. A micro-batch that the stream retries gets the verdicts of its first attempt: it
    is named by the checkpoint and its number."""

    def ingest(batch: DataFrame, number: int) -> None:
        sink(index.ingest(batch, key(), F.col(row_id), F.col(arrival), f"{checkpoint}#{number}"), number)

    return stream.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def corrections(stream: DataFrame, store: TableStore, name: str, make: Callable[[DataFrame], LateEvents], checkpoint: str) -> StreamingQuery:
    """Keep signed deltas of per-period aggregates (``DeltaLog``): each micro-batch retracts the values it changes and emits
    what replaces them; readers sum the signed rows. A micro-batch that the stream retries is known by its number."""
    log = DeltaLog(store, name)

    def take(batch: DataFrame, number: int) -> None:
        log.take(make(batch), f"{checkpoint}#{number}")

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_totals(stream: DataFrame, event_time: str, width: str, delay: str, keys: list[str], measure: str) -> DataFrame:
    """Counts and sums by event-time window; rows later than ``delay`` are left out by the watermark."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *keys).agg(F.count(F.lit(1)).alias("rows_count"), F.sum(measure).alias("total"))
