"""The error-ratio signal over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.operators.signal import ratio


def windowed_ratio(events: DataFrame, bad: str = "error", window: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """``start, total, good, ratio`` for each window of a streaming (or batch) table ``ts, event_type``; late rows beyond the watermark go."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    x = events.withWatermark("ts", late).groupBy(w.alias("w")).agg(F.count("*").alias("total"), F.count_if(F.col("event_type") != bad).alias("good"))
    return x.select(F.col("w.start").alias("start"), "total", "good", ratio(F.col("total"), F.col("good")).alias("ratio"))


def alarms(events: DataFrame, threshold: float = 0.15, **kwargs: str) -> DataFrame:
    """Windows whose ratio reaches the threshold."""
    return windowed_ratio(events, **kwargs).where(F.col("ratio") >= threshold)
