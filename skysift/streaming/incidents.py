"""Streams: detections of newly arrived tiles, and incident rates in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skysift.sources.adapters import detect


def incident_rate(events: DataFrame, *, time: str = "ts", kind: str = "event_type", every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and mean value for each window and type; on a stream, rows later than `late` are left out."""
    source = events.withWatermark(time, late) if events.isStreaming else events
    rate = source.groupBy(F.window(time, every).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    return rate.select(F.col("w.start").alias("window_start"), kind, "n", "mean_value")


def detect_arrivals(tiles: DataFrame, name: str, targets: list[str], out: str, checkpoint: str) -> StreamingQuery:
    """Runs a detector on tiles as they arrive; the checkpoint makes it resumable."""
    return detect(tiles, name, targets).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
