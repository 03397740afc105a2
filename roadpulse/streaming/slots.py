"""Sliding windows of a stream from two chained stateful aggregations.

The first keeps sums per (slot, segment), a slot being one slide long; a closed
slot leaves it as one row. The second gathers the closed slots into the sliding
windows. Each reading updates one state row instead of one for each of its
windows (six for 60/10); the second state is updated once for each slot, segment
and window, whatever the number of readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import windows as W

_SUMS = ("s_speed", "n_speed", "s_score", "n_score", "reading_count")


def slot_sums(cleaned: DataFrame, slide=W.DEFAULT_SLIDE, ts: str = "event_time") -> DataFrame:
    """Sums per (``slot``, segment); ``slot`` carries the watermark."""
    slot = F.window(ts, W._interval(slide))
    return cleaned.groupBy(slot.alias("slot"), "xd_id").agg(
        F.sum("speed").alias("s_speed"), F.count("speed").alias("n_speed"),
        F.sum("congestion_score").alias("s_score"), F.count("congestion_score").alias("n_score"),
        F.count(F.lit(1)).alias("reading_count"))


def by_segment(cleaned: DataFrame, duration=W.DEFAULT_DURATION, slide=W.DEFAULT_SLIDE, ts: str = "event_time",
               written_at: bool = False) -> DataFrame:
    """The rows of ``operators.windows.by_segment`` of a stream, in append mode."""
    if W.minutes(duration) % W.minutes(slide):
        raise ValueError("a window must be a whole number of slots")
    # The time of a closed slot is its last instant: in the windows that hold the slot.
    window = F.window(F.window_time("slot"), W._interval(duration), W._interval(slide))
    sums = slot_sums(cleaned, slide, ts).groupBy(window.alias("window"), "xd_id").agg(*[F.sum(c).alias(c) for c in _SUMS])
    out = sums.select(
        "xd_id", F.try_divide("s_speed", "n_speed").alias("avg_speed"), F.try_divide("s_score", "n_score").alias("avg_congestion"),
        "reading_count", *W.window_columns(F.col("window.start"), F.col("window.end")))
    return W._with_written_at(out, written_at)
