"""Distinct-segment sketches per time slot, merged to any longer period.

A slot's row holds two HyperLogLog sketches, of the segments reporting and of
the congested ones. Sketches are merged by union: windows, days and months come
from the stored slots, without the readings, and a month costs as many rows as
it has slots. With 2^LG_K registers the relative standard error is
0.83 / sqrt(2^LG_K), 1.3 % for 12; below a few hundred segments the sketch is
exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows as W

LG_K = 12
PERIODS = ("window", "day", "month")


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate."""
    return 0.8326 / 2 ** (lg_k / 2)


def slot_sketches(cleaned: DataFrame, slot=W.DEFAULT_SLIDE, threshold: float = W.DEFAULT_THRESHOLD,
                  ts: str = "measurement_tstamp", lg_k: int = LG_K) -> DataFrame:
    """One row a slot: ``window_start``, ``window_end``, the date columns, both
    sketches and ``reading_count``. NULL segments aren't counted; readings
    without a time are in no slot. Works on batch and streaming frames."""
    g, start, end = W._grouped(cleaned.where(F.col(ts).isNotNull()), ts, slot, slot)
    hot = F.when(F.col("congestion_score") > F.lit(float(threshold)), F.col("xd_id"))
    return g.agg(F.hll_sketch_agg("xd_id", lg_k).alias("segments"), F.hll_sketch_agg(hot, lg_k).alias("congested"),
                 F.count(F.lit(1)).alias("reading_count")).select(
        *W.window_columns(start, end), "segments", "congested", "reading_count")


def _merged(slots: DataFrame, *by: Column) -> DataFrame:
    total, congested = F.hll_union_agg("segments", True), F.hll_union_agg("congested", True)
    out = slots.groupBy(*by).agg(F.hll_sketch_estimate(total).alias("total_segments"),
                                 F.hll_sketch_estimate(congested).alias("congested_segments"),
                                 F.sum("reading_count").alias("reading_count"))
    return out.withColumn("pct_congested", W._pct(F.col("congested_segments"), F.col("total_segments")))


def merged(slots: DataFrame, period: str, duration=W.DEFAULT_DURATION, slot=W.DEFAULT_SLIDE) -> DataFrame:
    """The network KPI a ``window``, ``day`` or ``month`` from stored slots:
    ``period_start``, ``total_segments``, ``congested_segments`` (estimates),
    ``reading_count``, ``pct_congested``."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    start = F.col("window_start")
    if period != "window":
        return _merged(slots, F.date_trunc(period, start).cast(slots.schema["window_start"].dataType).alias("period_start"))
    back = F.sequence(F.lit(0), F.lit(W.minutes(duration) - W.minutes(slot)), F.lit(W.minutes(slot)))
    each = slots.select("*", F.explode(back).alias("back"))
    return _merged(each, F.timestamp_add("MINUTE", -F.col("back"), start).alias("period_start"))
