"""Streaming forms: windowed counts of events with late data, and merged snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.tables import KeyedTable


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events, distinct by id, and values by type and window; works on batches and streams alike."""
    e = events.withWatermark("ts", late)
    if events.isStreaming:
        e = e.dropDuplicatesWithinWatermark(["event_id"])
    else:
        e = e.dropDuplicates(["event_id"])
    return e.groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def merge_stream(new: DataFrame, table: KeyedTable, checkpoint: str, watched: list[str], keep: int = 10) -> StreamingQuery:
    """Merge each micro-batch of snapshots into a keyed table: only buckets that the batch touches are written anew.

    A batch that is run again makes no second version; the last `keep` versions stay.
    """

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            table.merge(batch, watched, run=f"batch {number}")
            table.rotate(keep)

    return new.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_stream(new: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch of events under keys that the table lacks; a batch that is run again adds nothing."""

    def append(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            table.append(batch, run=f"batch {number}")

    return new.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
