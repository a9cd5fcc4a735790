"""Streams beside the batch operators: chunks of newly arriving units, and event rates with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from loomgraph.operators.segment import chunk_rows, segment


def index_new_units(units: DataFrame, out: str, checkpoint: str, budget: int = 400, delay: str = "1 day", available_now: bool = True) -> StreamingQuery:
    """Cut units into chunks as they arrive and append them to the chunk table.

    A unit with the same id and hash as one seen within ``delay`` of event time is skipped; state older than the
    watermark is dropped.  A batch that is run again after a failure overwrites its own folder only.
    """
    fresh = units.withWatermark("recorded_at", delay).dropDuplicatesWithinWatermark(["knowledge_unit_id", "text_sha256"])

    def add(batch: DataFrame, batch_id: int) -> None:
        rows = chunk_rows(batch, segment(batch, "knowledge_unit_id", "text", budget))
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = fresh.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def event_rates(events: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """``start, event_type, n, total`` per window; events later than ``delay`` behind the newest are dropped."""
    per = events.withWatermark("ts", delay).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return per.select(F.col("window.start").alias("start"), "event_type", "n", "total")
