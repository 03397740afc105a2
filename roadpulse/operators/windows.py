"""Sliding-window aggregates (60-minute windows sliding by 10 minutes by
default). The same functions serve batch frames and streaming frames; pass
``ts="event_time"`` on the streaming path.

Windows are epoch-aligned: a reading at ``t`` belongs to every window
``[s, s + duration)`` with ``s`` a multiple of ``slide`` and
``s <= t < s + duration`` (6 windows for 60/10).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import floor_minutes
from .transform import enrich

DEFAULT_DURATION = "60 minutes"
DEFAULT_SLIDE = "10 minutes"
DEFAULT_THRESHOLD = 0.3  # congested when score > threshold (strict)
DEFAULT_RSD = 0.05


def minutes(spec: str | int) -> int:
    """``"60 minutes"`` / ``"1 hour"`` / ``60`` -> 60."""
    if isinstance(spec, int):
        return spec
    m = re.fullmatch(r"\s*(\d+)\s*(minute|minutes|min|hour|hours)\s*", spec)
    if not m:
        raise ValueError(f"unsupported interval {spec!r}")
    n = int(m.group(1))
    return n * 60 if m.group(2).startswith("hour") else n


def _interval(spec: str | int) -> str:
    return f"{minutes(spec)} minutes"


def window_columns(start: Column, end: Column) -> list[Column]:
    """``window_start``, ``window_end`` and the date partition columns of the
    window start."""
    return [start.alias("window_start"), end.alias("window_end"),
            F.year(start).alias("year"), F.month(start).alias("month"),
            F.dayofmonth(start).alias("day")]


def _grouped(df: DataFrame, ts: str, duration, slide, *keys):
    """``groupBy`` on the sliding window plus ``keys``; returns the grouped
    data and the window start/end columns of the result.

    A stream groups on the window struct (that is what carries the
    watermark for state eviction). A batch frame groups on the window start
    only, a plain timestamp, and derives the end: hashing one long instead of
    a two-field struct halved the aggregation time of the per-segment windows
    """
    w = F.window(ts, _interval(duration), _interval(slide))
    if df.isStreaming:
        return df.groupBy(w.alias("window"), *keys), F.col("window.start"), F.col("window.end")
    end = F.timestamp_add("MINUTE", F.lit(minutes(duration)), F.col("window_start"))
    return df.groupBy(w.start.alias("window_start"), *keys), F.col("window_start"), end


def _stats() -> list[Column]:
    return [F.avg("speed").alias("avg_speed"),
            F.avg("congestion_score").alias("avg_congestion"),
            F.count(F.lit(1)).alias("reading_count")]


def _with_written_at(df: DataFrame, written_at: bool) -> DataFrame:
    return df.withColumn("written_at", F.current_timestamp()) if written_at else df


# ---------------------------------------------------------------------------
# Per segment / per road class (plain form: Expand x windows-per-reading)
# ---------------------------------------------------------------------------

def by_segment(cleaned: DataFrame, duration=DEFAULT_DURATION, slide=DEFAULT_SLIDE,
               ts: str = "measurement_tstamp", segments: DataFrame | None = None,
               written_at: bool = False) -> DataFrame:
    """Mean speed, mean congestion and reading count per window and segment.

    Aggregates on the minimal key (window, ``xd_id``); the lookup attributes
    are joined to the aggregate afterwards (left, so unknown segments stay)."""
    g, start, end = _grouped(cleaned, ts, duration, slide, "xd_id")
    out = g.agg(*_stats()).select("xd_id", "avg_speed", "avg_congestion", "reading_count",
                                  *window_columns(start, end))
    out = _with_written_at(out, written_at)
    if segments is not None:
        out = enrich(out, segments, "left")
    return out


def by_road_type(enriched: DataFrame, duration=DEFAULT_DURATION, slide=DEFAULT_SLIDE,
                 ts: str = "measurement_tstamp", written_at: bool = False) -> DataFrame:
    """Same statistics per window and road class (``frc``; NULL for readings
    of unknown segments is its own group)."""
    g, start, end = _grouped(enriched, ts, duration, slide, "frc")
    out = g.agg(*_stats()).select("frc", "avg_speed", "avg_congestion", "reading_count",
                                  *window_columns(start, end))
    return _with_written_at(out, written_at)


def _pct(congested: Column, total: Column) -> Column:
    return F.when(total > F.lit(0), congested / total * F.lit(100.0)).otherwise(F.lit(None))


def network(cleaned: DataFrame, duration=DEFAULT_DURATION, slide=DEFAULT_SLIDE,
            threshold: float = DEFAULT_THRESHOLD, exact: bool = False, rsd: float = DEFAULT_RSD,
            ts: str = "measurement_tstamp", written_at: bool = False,
            method: str = "distinct") -> DataFrame:
    """Network KPI per window: segments reporting, segments with any reading
    scoring above ``threshold``, and their percentage.

    ``exact=False`` uses HyperLogLog++ (``approx_count_distinct``, mergeable
    partial aggregates, the streaming form; the ratio may exceed 100 since
    both terms are estimates). ``exact=True`` (batch) counts distinct
    segments: ``method="distinct"`` reduces the window copies to one row per
    (window, segment) with a congested flag, then counts and sums those per
    window (two plain aggregates: half the shuffle bytes of Spark's
    ``count(DISTINCT)`` plan, which doubles the copies once more for its two
    distinct columns); ``method="slots"`` is ``network_exact_two_stage``,
    which expands slots instead of readings. A stream counts exactly through
    ``streaming.shared`` (one row per window and segment in its state).
    """
    hot = F.when(F.col("congestion_score") > F.lit(float(threshold)), 1).otherwise(0)
    if exact:
        if cleaned.isStreaming:
            raise ValueError("exact counts on a stream: use streaming.shared.start_shared")
        if method == "slots":
            return network_exact_two_stage(cleaned, duration, slide, threshold, ts)
        g, start, end = _grouped(cleaned, ts, duration, slide, "xd_id")
        per_segment = g.agg(F.max(hot).alias("_hot"))
        congested = F.sum(F.when(F.col("xd_id").isNotNull(), F.col("_hot")).otherwise(0)).cast("long")
        out = (per_segment.groupBy("window_start")
               .agg(F.count("xd_id").alias("total_segments"), congested.alias("congested_segments")))
    else:
        g, start, end = _grouped(cleaned, ts, duration, slide)
        hot_id = F.when(F.col("congestion_score") > F.lit(float(threshold)), F.col("xd_id"))
        out = g.agg(F.approx_count_distinct("xd_id", rsd).alias("total_segments"),
                    F.approx_count_distinct(hot_id, rsd).alias("congested_segments"))
    out = out.select("total_segments", "congested_segments",
                     _pct(F.col("congested_segments"), F.col("total_segments")).alias("pct_congested"),
                     *window_columns(start, end))
    return _with_written_at(out, written_at)


# ---------------------------------------------------------------------------
# Two-stage forms (batch only): tumble into slide-long slots, then expand
# slots, not readings.
# ---------------------------------------------------------------------------

def _slots_per_window(duration, slide) -> int:
    d, s = minutes(duration), minutes(slide)
    if d % s:
        raise ValueError("two-stage windows need duration to be a multiple of slide")
    return d // s


def by_road_type_two_stage(enriched: DataFrame, duration=DEFAULT_DURATION, slide=DEFAULT_SLIDE,
                           ts: str = "measurement_tstamp") -> DataFrame:
    """``by_road_type`` via per-slot sums and counts: the readings are
    aggregated once per (slot, class) and only those partials are expanded to
    the windows, so the expansion costs nothing at scale."""
    n, s = _slots_per_window(duration, slide), minutes(slide)
    slot = floor_minutes(F.col(ts), s)
    part = (enriched.where(F.col(ts).isNotNull())
            .groupBy(slot.alias("slot"), "frc")
            .agg(F.sum("speed").alias("s_speed"), F.count("speed").alias("n_speed"),
                 F.sum("congestion_score").alias("s_score"),
                 F.count("congestion_score").alias("n_score"),
                 F.count(F.lit(1)).alias("n_rows")))
    k = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k")
    exp = part.select("*", k).withColumn(
        "ws", F.timestamp_add("MINUTE", -F.col("k") * F.lit(s), F.col("slot")))
    agg = (exp.groupBy("ws", "frc")
           .agg(F.try_divide(F.sum("s_speed"), F.sum("n_speed")).alias("avg_speed"),
                F.try_divide(F.sum("s_score"), F.sum("n_score")).alias("avg_congestion"),
                F.sum("n_rows").alias("reading_count")))
    end = F.timestamp_add("MINUTE", F.lit(n * s), F.col("ws"))
    return agg.select("frc", "avg_speed", "avg_congestion", "reading_count",
                      *window_columns(F.col("ws"), end))


def latest_window(cleaned: DataFrame, duration=DEFAULT_DURATION, slide=DEFAULT_SLIDE,
                  ts: str = "measurement_tstamp") -> DataFrame:
    """The newest sliding window of each segment (batch), without building
    the other windows: same rows as ``snapshot.latest(by_segment(...))``.

    A reading in slot ``t`` is in the windows starting at ``t - k*slide``,
    so a segment's newest window starts at its newest slot, and holds only
    that slot's readings (a later reading would have a later slot). Per
    (segment, slot) sums and counts are aggregated map-side, then the
    newest slot per segment is picked by ``max_by`` (a hash aggregate with
    a partial step): no window expansion, and a hot segment is one partial
    row per task at each step.
    """
    if cleaned.isStreaming:
        raise ValueError("latest_window is batch only; streams use the snapshot sink")
    n, s = _slots_per_window(duration, slide), minutes(slide)
    slot = floor_minutes(F.col(ts), s)
    per_slot = (cleaned.where(F.col(ts).isNotNull())
                .groupBy("xd_id", slot.alias("slot"))
                .agg(F.sum("speed").alias("s_speed"), F.count("speed").alias("n_speed"),
                     F.sum("congestion_score").alias("s_score"),
                     F.count("congestion_score").alias("n_score"),
                     F.count(F.lit(1)).alias("n_rows")))
    newest = per_slot.groupBy("xd_id").agg(
        F.max("slot").alias("window_start"),
        *[F.max_by(c, "slot").alias(c) for c in ("s_speed", "n_speed", "s_score", "n_score", "n_rows")])
    end = F.timestamp_add("MINUTE", F.lit(n * s), F.col("window_start"))
    return newest.select(
        "xd_id", F.try_divide(F.col("s_speed"), F.col("n_speed")).alias("avg_speed"),
        F.try_divide(F.col("s_score"), F.col("n_score")).alias("avg_congestion"),
        F.col("n_rows").alias("reading_count"), *window_columns(F.col("window_start"), end))


def _bucket_index(minute: Column, bucket_minutes: int) -> Column:
    """Epoch-aligned bucket number of a minute count."""
    b = F.lit(int(bucket_minutes))
    return ((minute - F.pmod(minute, b)) / b).cast("long")


def by_segment_bucketed(cleaned: DataFrame, duration=DEFAULT_DURATION, slide=DEFAULT_SLIDE,
                        ts: str = "measurement_tstamp", segments: DataFrame | None = None,
                        bucket_minutes: int = 1440) -> DataFrame:
    """``by_segment`` (batch) from per-(segment, slot) sums: the readings are
    aggregated map-side first, so a hot segment is a row per slot and task, and
    the window copies are never shuffled.

    Each window is owned by the epoch-aligned bucket (default one day) its
    start falls in. A reading is sent to the one or two buckets owning its
    windows (two only within the first ``duration - slide`` of a bucket: 50
    of 1440 minutes, about 3.5% of the readings), the readings are
    hash-partitioned by (segment, bucket), and the window copies are made
    and aggregated inside each partition: the explode keeps the
    partitioning, so the aggregate needs no second exchange. The plain form
    shuffles one partial row per (window, segment) and task, up to 6 per
    reading when readings are sparse. A (segment, bucket) group is one task:
    ``bucket_minutes`` bounds it to one segment's readings in one bucket.
    """
    if cleaned.isStreaming:
        raise ValueError("the bucketed form is batch only")
    n, s = _slots_per_window(duration, slide), minutes(slide)
    if bucket_minutes % s or bucket_minutes < (n - 1) * s:
        raise ValueError("bucket_minutes must be a multiple of the slide and cover a window's span")
    epoch = F.lit(0).cast("timestamp").cast("timestamp_ntz")
    slot = floor_minutes(F.col(ts), s)
    rows = (cleaned.where(F.col(ts).isNotNull())
            .groupBy("xd_id", slot.alias("_slot"))
            .agg(F.sum("speed").alias("s_speed"), F.count("speed").alias("n_speed"),
                 F.sum("congestion_score").alias("s_score"), F.count("congestion_score").alias("n_score"),
                 F.count(F.lit(1)).alias("n_rows"))
            .withColumn("_m", F.timestamp_diff("MINUTE", epoch, F.col("_slot").cast("timestamp_ntz"))))
    owners = F.array_distinct(F.array(_bucket_index(F.col("_m") - F.lit((n - 1) * s), bucket_minutes),
                                      _bucket_index(F.col("_m"), bucket_minutes)))
    parts = rows.select("*", F.explode(owners).alias("_bucket")).repartition("xd_id", "_bucket")
    # copy k (window start m - k*s) belongs to the bucket [b0, b0 + B); all
    # of m, b0 and B are on the slide grid, so the bounds are exact
    since = F.col("_m") - F.col("_bucket") * F.lit(int(bucket_minutes))
    k_hi = F.least(F.lit(n - 1), (since / F.lit(s)).cast("int"))
    k_lo = F.greatest(F.lit(0), ((since - F.lit(int(bucket_minutes))) / F.lit(s)).cast("int") + F.lit(1))
    copies = parts.select("*", F.explode(F.sequence(k_lo, k_hi)).alias("_k"))
    ws = F.timestamp_add("MINUTE", -F.col("_k") * F.lit(s), F.col("_slot"))
    agg = copies.groupBy("xd_id", "_bucket", ws.alias("window_start")).agg(
        F.try_divide(F.sum("s_speed"), F.sum("n_speed")).alias("avg_speed"),
        F.try_divide(F.sum("s_score"), F.sum("n_score")).alias("avg_congestion"), F.sum("n_rows").alias("reading_count"))
    end = F.timestamp_add("MINUTE", F.lit(minutes(duration)), F.col("window_start"))
    out = agg.select("xd_id", "avg_speed", "avg_congestion", "reading_count",
                     *window_columns(F.col("window_start"), end))
    if segments is not None:
        out = enrich(out, segments, "left")
    return out


def network_exact_two_stage(cleaned: DataFrame, duration=DEFAULT_DURATION, slide=DEFAULT_SLIDE,
                            threshold: float = DEFAULT_THRESHOLD,
                            ts: str = "measurement_tstamp") -> DataFrame:
    """Exact ``network`` without expanding readings.

    1. One row per (segment, slot) with a congested flag (map-side dedup).
    2. Per segment, ordered by slot: a slot is the *first* of its segment in
       a window iff the previous present slot is before the window start, so
       slot ``t`` with previous slot ``p`` opens the windows starting in
       ``(p, t]`` (at most n). Congested counts use the previous congested
       slot the same way. Per segment there is at most one row per slot, so a
       hot segment is bounded by the time span, not by its reading count.
    3. Sum the contributions per window (partial aggregation, tiny shuffle).
    """
    n, s = _slots_per_window(duration, slide), minutes(slide)
    slot = floor_minutes(F.col(ts), s)
    flag = F.when(F.col("congestion_score") > F.lit(float(threshold)), 1).otherwise(0)
    # Readings without a segment count for no segment, but keep their windows:
    # they only contribute zeros.
    per_slot = (cleaned.where(F.col(ts).isNotNull())
                .groupBy("xd_id", slot.alias("slot")).agg(F.max(flag).alias("hot")))
    unknown = F.col("xd_id").isNull()
    w = Window.partitionBy("xd_id").orderBy("slot")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    gaps = per_slot.select(
        "slot", "hot", unknown.alias("unknown"),
        F.timestamp_diff("MINUTE", F.lag("slot").over(w), F.col("slot")).alias("gap"),
        F.timestamp_diff("MINUTE", F.last(F.when(F.col("hot") == 1, F.col("slot")), True).over(before),
                         F.col("slot")).alias("hot_gap"))
    k_all = F.least(F.lit(n), F.coalesce(F.col("gap") / F.lit(s), F.lit(n)).cast("int"))
    k_hot = F.when(F.col("hot") == 1,
                   F.least(F.lit(n), F.coalesce(F.col("hot_gap") / F.lit(s), F.lit(n)).cast("int"))
                   ).otherwise(F.lit(0))
    contrib = gaps.select("slot", "unknown", k_all.alias("k_all"), k_hot.alias("k_hot")).select(
        "slot", F.when(~F.col("unknown"), F.col("k_all")).otherwise(0).alias("k_all"),
        F.when(~F.col("unknown"), F.col("k_hot")).otherwise(0).alias("k_hot"),
        F.explode(F.sequence(F.lit(0), F.greatest("k_all", "k_hot") - 1)).alias("j"))
    ws = F.timestamp_add("MINUTE", -F.col("j") * F.lit(s), F.col("slot"))
    agg = (contrib.groupBy(ws.alias("ws"))
           .agg(F.sum(F.when(F.col("j") < F.col("k_all"), 1).otherwise(0)).cast("long").alias("total_segments"),
                F.sum(F.when(F.col("j") < F.col("k_hot"), 1).otherwise(0)).cast("long")
                .alias("congested_segments")))
    end = F.timestamp_add("MINUTE", F.lit(n * s), F.col("ws"))
    return agg.select("total_segments", "congested_segments",
                      _pct(F.col("congested_segments"), F.col("total_segments")).alias("pct_congested"),
                      *window_columns(F.col("ws"), end))
