"""Registered queries of the incremental jobs: files taken as they arrive,
results merged from stored sums and sketches, chained stream states, layouts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import historical as H
from ..operators import report as RP
from ..operators import sketches as SK
from ..operators.prepare import with_partitions
from ..operators.replay import to_messages
from ..operators.transform import enrich, parse, score
from ..session import scratch_path
from ..sources import layout as LY
from ..sources import readers as RD
from ..sources.writers import write_small_single_file
from ..streaming import late as LTE
from ..streaming import latest as LT
from ..streaming import live as LV
from ..streaming import messages as MS
from ..streaming import replay_query as RQ
from ..streaming import slots as SL
from . import incremental as INC
from . import rollup as RU
from .catalog import (_CSV_WRITE, _KEY_SQL, CLEAN_WHERE, CLOSED, F32, INGEST_HIST, INGEST_REPLAY, M, MONTH_LABEL_SQL, ORACLE, R6, SCORE_SQL, SEG_WIN_SELECT,
                      SEG_WINDOWS_SQL, STORED_SQL, WIN_COLS, WINDOW_CTES, Y, _between, _cleaned, _ingested, _ntz_windows,
                      _once, _result_cte, r6, register)


# Files as they arrive

@_once("ingest_new")
def _arrived(spark, sf_dir):
    """Two folders of readings with columns in different order, then a third; then
    the same folders again, with the old ledger and with a new one. A folder has
    as many files as the readings have input splits, so no task writes a third
    of them."""
    csv, out, ck = (scratch_path(spark, f"arriving-{n}") for n in ("csv", "out", "ckpt"))
    r = fx.readings_long(spark, sf_dir)
    part = F.pmod(F.xxhash64("xd_id", "measurement_tstamp", "speed"), F.lit(3))
    counts = []
    for k, cols in enumerate((["speed", "xd_id", "reference_speed", "measurement_tstamp", "confidence_score"],
                              ["xd_id", "measurement_tstamp", "confidence_score", "speed", "reference_speed"],
                              ["measurement_tstamp", "speed", "reference_speed", "confidence_score", "xd_id"])):
        r.where(part == k).select(F.lit(k).alias("county"), *cols).write.options(**_CSV_WRITE).csv(f"{csv}/{k}")
        if k:
            counts.append(INC.ingest_new(spark, csv, out, ck, INGEST_HIST, INGEST_REPLAY))
    for again in (ck, f"{ck}-new"):
        counts.append(INC.ingest_new(spark, csv, out, again, INGEST_HIST, INGEST_REPLAY))
    return out, counts


@register("ingest_incremental", fx.with_views("\nUNION ALL\n".join(f"""
SELECT '{name}' AS split, xd_id, measurement_tstamp, {R6(F32.format(c='speed'))} AS speed, {Y} AS year, {M} AS month
FROM readings WHERE {_between(b)}""" for name, b in (("historical", INGEST_HIST), ("replay", INGEST_REPLAY))), long=True))
def ingest_incremental(spark, sf_dir):
    """Every file's rows are there once, also after a second look at the same
    files and after the loss of the ledger."""
    out, _ = _arrived(spark, sf_dir)
    return r6(spark.read.parquet(out).select("split", "xd_id", "measurement_tstamp", F.col("speed").cast("double").alias("speed"),
                                             "year", "month"))


@register("ingest_incremental_counters", fx.with_views(f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE {_between(INGEST_HIST)}) AS historical_rows,
       count(*) FILTER (WHERE {_between(INGEST_REPLAY)}) AS replay_rows, 0 AS rows_of_second_look FROM readings""", long=True))
def ingest_incremental_counters(spark, sf_dir):
    """Counters of the calls that took the three files, and rows counted when
    the same ledger looks again."""
    _, counts = _arrived(spark, sf_dir)
    total = [sum(c[k] for c in counts[:2]) for k in INC.COUNTERS]
    return spark.createDataFrame([(*total, counts[2]["total_rows"])],
                                 ", ".join(f"{c} long" for c in INC.COUNTERS) + ", rows_of_second_look int")


# Results merged from stored sums, one month replaced

CORRECTED = "year(measurement_tstamp) = 1997 AND month(measurement_tstamp) = 3"


@_once("sums")
def _corrected_sums(spark, sf_dir):
    _, raw = _ingested(spark, sf_dir)
    sums, again = scratch_path(spark, "sums"), scratch_path(spark, "corrected")
    RU.update_sums(spark, raw, sums)
    month = RD.read_readings(spark, raw, year=1997, months=[3])
    month.withColumn("speed", F.col("speed") * 0.5).write.partitionBy("year", "month").parquet(again)
    RU.update_sums(spark, again, sums, year=1997, months=[3])
    return sums


_CORRECTED_SQL = f"""(SELECT xd_id, measurement_tstamp, reference_speed,
  CASE WHEN {CORRECTED} THEN speed * 0.5e0 ELSE speed END AS speed FROM {STORED_SQL})"""


@register("results_from_sums", fx.with_views("\nUNION ALL\n".join(f"""
SELECT '{k}' AS kind, {year} AS year, CAST({_KEY_SQL[k][0]} AS VARCHAR) AS key, {R6('avg(speed)')} AS avg_speed,
  {R6(f'avg({SCORE_SQL})')} AS avg_congestion_score
FROM {_CORRECTED_SQL} r JOIN segments s ON r.xd_id = s.xd GROUP BY ALL""" for k in H.MEAN_KINDS for year in (Y, "NULL")), long=True))
def results_from_sums(spark, sf_dir):
    """Yearly and all-time means (year NULL) from the stored sums after one
    month was replaced."""
    sums, segments = RU.read_sums(spark, _corrected_sums(spark, sf_dir)), fx.segments(spark, sf_dir)
    parts = None
    for period in (H.YEARLY, ()):
        results = RU.results_from_sums(sums, segments, period)
        for kind in H.MEAN_KINDS:
            year = F.col("year") if period else F.lit(None).cast("int").alias("year")
            one = results[kind].select(F.lit(kind).alias("kind"), year, F.col(_KEY_SQL[kind][1]).cast("string").alias("key"),
                                       "avg_speed", "avg_congestion_score")
            parts = one if parts is None else parts.unionByName(one)
    return r6(parts)


@register("top_segments_from_sums", fx.with_views(f"""
SELECT year, xd_id, road_name, bearing, frc, {R6('avg_congestion')} AS avg_congestion, {R6('avg_speed')} AS avg_speed
FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY avg_congestion DESC NULLS LAST, xd_id) AS rn FROM m)
WHERE rn <= 20""", long=True, extra=f"""m AS (
  SELECT {Y} AS year, r.xd_id, s.road_name, s.bearing, s.frc, avg({SCORE_SQL}) AS avg_congestion, avg(speed) AS avg_speed
  FROM {_CORRECTED_SQL} r JOIN segments s ON r.xd_id = s.xd GROUP BY ALL)"""))
def top_segments_from_sums(spark, sf_dir):
    """Worst segments of every year, from the same table of sums, written and read back."""
    out = scratch_path(spark, "from-sums")
    RU.run_from_sums(spark, _corrected_sums(spark, sf_dir), fx.segments(spark, sf_dir), out)
    return r6(spark.read.parquet(f"{out}/top_segments_yearly").select(
        "year", "xd_id", "road_name", "bearing", "frc", "avg_congestion", "avg_speed"))


# Stored sketches

_SKETCH_BOUND = 1 + 5 * SK.relative_error()


@_once("sketches")
def _stored_slots(spark, sf_dir):
    path = scratch_path(spark, "slots")
    SK.slot_sketches(_cleaned(spark, sf_dir)).write.partitionBy("year", "month", "day").parquet(path)
    return path


@register("kpi_from_sketches", fx.with_views("\nUNION ALL\n".join(f"""
SELECT '{period}' AS period, {start} AS period_start, count(DISTINCT xd_id) AS total_segments,
  count(DISTINCT CASE WHEN congestion_score > 0.3e0 THEN xd_id END) AS congested_segments, count(*) AS reading_count, true AS within_bound
FROM {of} GROUP BY ALL""" for period, start, of in (
    ("window", "window_start", "win"), ("day", "CAST(date_trunc('day', measurement_tstamp) AS TIMESTAMP)", "slotted"),
    ("month", "CAST(date_trunc('month', measurement_tstamp) AS TIMESTAMP)", "slotted"))), extra=WINDOW_CTES))
def kpi_from_sketches(spark, sf_dir):
    """Network KPI of every window, day and month, merged from the stored slots:
    exact counts, and whether the estimates are within five standard errors (and
    one segment) of them."""
    slots = spark.read.parquet(_stored_slots(spark, sf_dir))
    cleaned = _cleaned(spark, sf_dir)
    hot = F.when(F.col("congestion_score") > 0.3, F.col("xd_id"))
    ts = F.col("measurement_tstamp")
    parts = None
    for period, start in (("window", F.window(ts, "60 minutes", "10 minutes").start), ("day", F.date_trunc("day", ts)),
                          ("month", F.date_trunc("month", ts))):
        exact = cleaned.where(ts.isNotNull()).groupBy(start.cast("timestamp_ntz").alias("period_start")).agg(
            F.countDistinct("xd_id").alias("total"), F.countDistinct(hot).alias("congested"), F.count(F.lit(1)).alias("n"))
        both = exact.join(SK.merged(slots, period), "period_start", "full")
        near = [F.abs(F.col(a) - F.col(b)) <= 1 + (_SKETCH_BOUND - 1) * F.col(b)
                for a, b in (("total_segments", "total"), ("congested_segments", "congested"))]
        one = both.select(F.lit(period).alias("period"), "period_start", F.col("total").alias("total_segments"),
                          F.col("congested").alias("congested_segments"), "reading_count",
                          F.coalesce(near[0] & near[1] & (F.col("n") == F.col("reading_count")), F.lit(False)).alias("within_bound"))
        parts = one if parts is None else parts.unionByName(one)
    return parts


# Chained states

def _messages(spark, sf_dir, name, twice=False):
    src = scratch_path(spark, name)
    m = to_messages(fx.readings(spark, sf_dir)).select("value")
    if twice:
        m = m.unionByName(m.where(F.pmod(F.xxhash64("value"), F.lit(10)) == 0))
    m.write.text(src)
    return LV.file_stream(spark, src)


_SEG_WIN_PLAIN = f"""xd_id, {R6('avg_speed')} AS avg_speed, {R6('avg_congestion')} AS avg_congestion, reading_count, window_start,
  window_end, year, month, day"""


@register("stream_chained_by_segment", fx.with_views(
    f"SELECT {_SEG_WIN_PLAIN} FROM seg_win WHERE {CLOSED}", extra=WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL))
def stream_chained_by_segment(spark, sf_dir):
    """Per-segment windows from two chained stateful aggregations, slots first."""
    out = scratch_path(spark, "chained")
    cleaned = LV.cleaned_stream(_messages(spark, sf_dir, "chained-in"))
    LV.start_append(SL.by_segment(cleaned), out, scratch_path(spark, "chained-ckpt"), available_now=True).awaitTermination()
    return r6(_ntz_windows(LV.read_appended(spark, out).withColumn("written_at", F.lit(None))))


# Repeats of an at-least-once topic

@register("stream_without_repeats", fx.with_views(f"""
SELECT {_SEG_WIN_PLAIN} FROM (
  SELECT xd_id, avg(speed) AS avg_speed, avg(congestion_score) AS avg_congestion, count(*) AS reading_count, {WIN_COLS}
  FROM (SELECT DISTINCT * FROM win) GROUP BY xd_id, window_start) WHERE {CLOSED}""", extra=WINDOW_CTES))
def stream_without_repeats(spark, sf_dir):
    """The windows of a topic that holds a tenth of its messages twice."""
    out = scratch_path(spark, "repeats")
    cleaned = MS.without_repeats(LV.cleaned_stream(_messages(spark, sf_dir, "repeats-in", twice=True)))
    LV.start_append(SL.by_segment(cleaned), out, scratch_path(spark, "repeats-ckpt"), available_now=True).awaitTermination()
    return r6(_ntz_windows(LV.read_appended(spark, out).withColumn("written_at", F.lit(None))))


# Malformed messages

@register("stream_malformed", fx.with_views("""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN xd_id % 50 = 1 THEN 'json' WHEN xd_id % 50 = 2 THEN 'time' WHEN xd_id % 50 = 3 THEN 'json'
              WHEN xd_id % 50 = 4 THEN 'empty' END AS reason FROM readings)
WHERE reason IS NOT NULL GROUP BY reason"""))
def stream_malformed(spark, sf_dir):
    """Messages of some segments cut short, with a broken time, a text for a
    number, or blank: each kind is kept and counted."""
    src, out = scratch_path(spark, "bad-in"), scratch_path(spark, "bad-out")
    m, kind = to_messages(fx.readings(spark, sf_dir)), F.col("key").cast("long") % 50
    value = F.col("value")
    bad = (F.when(kind == 1, F.substring(value, 1, 30)).when(kind == 2, F.regexp_replace(value, r"-\d\dT", "-99T"))
           .when(kind == 3, F.regexp_replace(value, r'"speed":[^,]*', '"speed":"fast"')).when(kind == 4, F.lit(" ")).otherwise(value))
    m.select(bad.alias("value")).write.text(src)
    MS.start_malformed(LV.file_stream(spark, src), out, scratch_path(spark, "bad-ckpt"), available_now=True).awaitTermination()
    return spark.read.parquet(out).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# K6/A5: readings by segment

@register("segment_means_bucketed", ORACLE["segment_means"])
def segment_means_bucketed(spark, sf_dir):
    """Segment means over readings bucketed by segment: no exchange of readings."""
    path = scratch_path(spark, "bucketed")
    name = f"readings_{path[-12:]}"
    LY.write_bucketed(with_partitions(fx.readings_long(spark, sf_dir)), name, path, buckets=8)
    return r6(H.segment_means(score(LY.read_bucketed(spark, name)), fx.segments(spark, sf_dir)))


# Keyed latest state; T6: late readings; T10/O6: replay as a stream

@_once("replayed")
def _replayed(spark, sf_dir):
    """The readings replayed by the slice clock, a day a batch, a file each."""
    src = scratch_path(spark, "replayed")
    RQ.replay(spark, fx.readings(spark, sf_dir), RQ.text_sink(src, files=1), scratch_path(spark, "replayed-ckpt"),
              "2024-01-01", "2024-01-31", minutes=1440)
    return src


@register("stream_replay_clock", fx.with_views(f"""
SELECT count(*) AS messages, count(DISTINCT xd_id) AS segments, min(measurement_tstamp) AS first, max(measurement_tstamp) AS last,
  true AS in_order
FROM readings WHERE measurement_tstamp BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'"""))
def stream_replay_clock(spark, sf_dir):
    """All messages of the replay, and whether every batch ends before the next begins."""
    batch = F.regexp_extract("_metadata.file_path", r"batch=(\d+)/", 1).cast("long")
    sent = spark.read.option("recursiveFileLookup", "true").text(_replayed(spark, sf_dir)).select("value", batch.alias("batch"))
    rows = parse(sent, keep=("batch",)).select("xd_id", "batch", F.col("event_time").cast("timestamp_ntz").alias("t"))
    per = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    after = per.withColumn("next", F.lead("lo").over(Window.orderBy("batch")))  # one row a batch
    return after.agg(F.sum("n").alias("messages"), F.min("lo").alias("first"), F.max("hi").alias("last"),
                     F.bool_and(F.coalesce(F.col("hi") < F.col("next"), F.lit(True))).alias("in_order")).crossJoin(
        rows.agg(F.countDistinct("xd_id").alias("segments")))  # one row each


_LATEST_PLAIN = fx.with_views(f"""
SELECT xd_id, {R6('avg_speed')} AS avg_speed, {R6('avg_congestion')} AS avg_congestion, reading_count, window_start, window_end FROM (
  SELECT *, row_number() OVER (PARTITION BY xd_id ORDER BY window_start DESC) AS rn FROM seg_win)
WHERE rn = 1""", extra=WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL)


@register("stream_keyed_latest", _LATEST_PLAIN)
def stream_keyed_latest(spark, sf_dir):
    """The latest state of every segment after many micro-batches, from keyed state."""
    root = scratch_path(spark, "latest")
    raw = spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "8").text(_replayed(spark, sf_dir))
    LT.start_latest(LV.cleaned_stream(raw), root, scratch_path(spark, "latest-ckpt"), available_now=True,
                    merge_every=3).awaitTermination()
    return r6(_ntz_windows(LT.read_latest(spark, root).withColumn("written_at", F.lit(None))))


@register("stream_late_readings", fx.with_views(f"""
SELECT xd_id, measurement_tstamp AS event_time, {R6('speed')} AS speed FROM readings
WHERE {CLEAN_WHERE} AND measurement_tstamp < TIMESTAMP '2024-01-10 00:00:00'"""))
def stream_late_readings(spark, sf_dir):
    """The days from the 12th on come first, the days before the 10th in a
    second batch: all of these are late, and all are kept."""
    src, out = scratch_path(spark, "late-in"), scratch_path(spark, "late-out")
    ck, r = scratch_path(spark, "late-ckpt"), fx.readings(spark, sf_dir)
    for part in ("measurement_tstamp >= TIMESTAMP '2024-01-12'", "measurement_tstamp < TIMESTAMP '2024-01-10'"):
        to_messages(r.where(part)).select("value").write.mode("append").text(src)
        LTE.start_late(LV.cleaned_stream(LV.file_stream(spark, src)), out, ck, available_now=True).awaitTermination()
    return r6(LTE.read_late(spark, out).select("xd_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "speed"))


# Paths of the readers and writers without a row of their own

_READING_COLS = f"""xd_id, measurement_tstamp, {R6(F32.format(c='speed'))} AS speed,
  {R6(F32.format(c='reference_speed'))} AS reference_speed"""


@register("readings_of_a_year", fx.with_views(f"""
SELECT {_READING_COLS}, {Y} AS year, {M} AS month FROM readings
WHERE {_between(INGEST_HIST)} AND year(measurement_tstamp) = 1997""", long=True))
def readings_of_a_year(spark, sf_dir):
    """One year of a partitioned root (the other years are pruned)."""
    _, raw = _ingested(spark, sf_dir)
    return r6(RD.read_readings(spark, raw, year=1997).drop("confidence_score"))


CLIP = ("1996-11-15 06:00:00", "1997-02-10 12:00:00")


@register("readings_clipped", fx.with_views(f"""
SELECT {_READING_COLS}, {Y} AS year, {M} AS month FROM readings WHERE {_between(INGEST_HIST)}
  AND measurement_tstamp BETWEEN TIMESTAMP '{CLIP[0]}' AND TIMESTAMP '{CLIP[1]}'""", long=True))
def readings_clipped(spark, sf_dir):
    """Readings of a time range over several months of a partitioned root,
    pruned to the months that it touches."""
    _, raw = _ingested(spark, sf_dir)
    return r6(RD.read_readings(spark, raw, start=CLIP[0], end=CLIP[1]).drop("confidence_score"))


@register("result_unpartitioned", fx.with_views(f"""
SELECT {Y} AS year, {_KEY_SQL['by_hour'][0]} AS hour, {R6('avg(speed)')} AS avg_speed, {R6(f'avg({SCORE_SQL})')} AS avg_congestion_score
FROM readings r JOIN segments s ON r.xd_id = s.xd GROUP BY ALL""", long=True))
def result_unpartitioned(spark, sf_dir):
    """A result written whole over an earlier one, without partitions."""
    path = scratch_path(spark, "unpartitioned")
    enriched = enrich(score(fx.readings_long(spark, sf_dir)), fx.segments(spark, sf_dir), "inner")
    write_small_single_file(H.mean_by(enriched.where("xd_id < 3"), "by_hour", H.YEARLY), path)
    write_small_single_file(H.mean_by(enriched, "by_hour", H.YEARLY), path)
    return r6(spark.read.parquet(path))


@register("files_in_time_order", fx.with_views(f"""
SELECT count(*) AS readings, 0 AS out_of_order FROM readings WHERE {_between(INGEST_HIST)}""", long=True))
def files_in_time_order(spark, sf_dir):
    """Readings of the compacted files that stand before an earlier one of their file."""
    _, raw = _ingested(spark, sf_dir)
    rows = spark.read.parquet(raw).select("measurement_tstamp", F.col("_metadata.file_path").alias("file"),
                                          F.monotonically_increasing_id().alias("place"))
    # A file has at most the writer's number of records.
    before = F.lag("measurement_tstamp").over(Window.partitionBy("file").orderBy("place"))
    return rows.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col("before") > F.col("measurement_tstamp")).cast("int").alias("out_of_order"))


@register("month_pivot_found_keys", fx.with_views(f"""
SELECT year, month, {', '.join(f"{R6(f'avg(avg_speed) FILTER (WHERE hour = {h})')} AS '{h}'" for h in range(24))},
       {MONTH_LABEL_SQL} AS month_label
FROM res GROUP BY year, month""", long=True, extra=_result_cte("by_hour")))
def month_pivot_found_keys(spark, sf_dir):
    """Month x hour matrix with a column for every key found in the results."""
    enriched = enrich(score(fx.readings_long(spark, sf_dir)), fx.segments(spark, sf_dir), "inner")
    return r6(RP.month_pivot(H.mean_by(enriched, "by_hour", H.MONTHLY), "hour"))
