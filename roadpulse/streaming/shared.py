"""The three windowed live results from one stateful query.

The reference runs one streaming query per result, so the source is read
and parsed three times (four with the snapshot) and the window state is kept
three times. Here one append query keeps a single state, per (window,
segment): sums, counts and whether any reading scored above the threshold.
All (window, segment) rows of a window close together, when the watermark
passes the window's end, so they arrive in the same micro-batch, and the
``foreachBatch`` writer derives

* per segment: the means and the reading count (lookup joined after),
* per road class: sums over the segments of the class (exact means),
* the network KPI: segments reporting and segments congested, counted
  exactly (one row per segment and window), not estimated.

Each batch overwrites only its own ``batch_id`` partitions (dynamic
overwrite), so a batch re-run after a failure replaces, never duplicates,
its rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import windows as W
from ..operators.transform import DEFAULT_MIN_CONFIDENCE, enrich
from . import live as LV


def window_partials(cleaned: DataFrame, duration=W.DEFAULT_DURATION, slide=W.DEFAULT_SLIDE,
                    threshold: float = W.DEFAULT_THRESHOLD, ts: str = "event_time") -> DataFrame:
    """Per (sliding window, segment): the sums, counts and congested flag
    every live result is derived from. Grouping on the window struct keeps
    the watermark for state eviction."""
    w = F.window(ts, f"{W.minutes(duration)} minutes", f"{W.minutes(slide)} minutes")
    hot = F.when(F.col("congestion_score") > F.lit(float(threshold)), 1).otherwise(0)
    return cleaned.groupBy(w.alias("window"), "xd_id").agg(
        F.sum("speed").alias("s_speed"), F.count("speed").alias("n_speed"),
        F.sum("congestion_score").alias("s_score"), F.count("congestion_score").alias("n_score"),
        F.count(F.lit(1)).alias("reading_count"), F.max(hot).alias("hot"))


def results_from_partials(parts: DataFrame, segments: DataFrame,
                          written_at: bool = True) -> dict[str, DataFrame]:
    """The three results (same columns as the per-result queries) from
    closed (window, segment) partials."""
    p = parts.select(F.col("window.start").alias("ws"), F.col("window.end").alias("we"), "xd_id",
                     "s_speed", "n_speed", "s_score", "n_score", "reading_count", "hot")
    wins = W.window_columns(F.col("ws"), F.col("we"))
    stamp = [F.current_timestamp().alias("written_at")] if written_at else []
    by_segment = p.select(
        "xd_id", F.try_divide(F.col("s_speed"), F.col("n_speed")).alias("avg_speed"),
        F.try_divide(F.col("s_score"), F.col("n_score")).alias("avg_congestion"),
        "reading_count", *wins, *stamp)
    total = F.count("xd_id")
    congested = F.sum(F.when(F.col("xd_id").isNotNull(), F.col("hot")).otherwise(0)).cast("long")
    network = (p.groupBy("ws", "we").agg(total.alias("total_segments"),
                                         congested.alias("congested_segments"))
               .select("total_segments", "congested_segments",
                       F.when(F.col("total_segments") > 0,
                              F.col("congested_segments") / F.col("total_segments") * F.lit(100.0))
                       .alias("pct_congested"), *wins, *stamp))
    by_class = (enrich(p, segments, "left", attrs=["frc"])
                .groupBy("ws", "we", "frc")
                .agg(F.try_divide(F.sum("s_speed"), F.sum("n_speed")).alias("avg_speed"),
                     F.try_divide(F.sum("s_score"), F.sum("n_score")).alias("avg_congestion"),
                     F.sum("reading_count").alias("reading_count"))
                .select("frc", "avg_speed", "avg_congestion", "reading_count", *wins, *stamp))
    return {"by_segment": enrich(by_segment, segments, "left"), "network": network,
            "by_road_type": by_class}


# Results with a row, or one per road class, for each window: written as one
# file per date and batch instead of one per state partition (a backfill that
# closes many windows spreads over as many tasks as dates). Per-segment rows
# grow with the network and keep the state's partitioning.
SMALL_RESULTS = ("network", "by_road_type")


class SharedResultsWriter:
    """``foreachBatch`` writer of the three results under ``out_root``
    (the folders of ``live.OUTPUTS``), partitioned by the window date, the
    run and the batch id: a replayed batch replaces its own rows, and another
    run's (a fresh checkpoint) stand beside them (see ``read_result``)."""

    def __init__(self, out_root: str, segments: DataFrame, run: str = ""):
        self.out_root = out_root.rstrip("/")
        self.segments = segments
        self.run = run or "0"

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        # three writes read the batch: keep it instead of re-running the
        # stateful plan for each
        batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch_df.isEmpty():
                return
            for kind, df in results_from_partials(batch_df, self.segments).items():
                if kind in SMALL_RESULTS:
                    df = df.repartition("year", "month", "day")
                (df.withColumn("run", F.lit(self.run)).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("year", "month", "day", "run", "batch_id")
                 .parquet(f"{self.out_root}/{LV.OUTPUTS[kind]}"))
        finally:
            batch_df.unpersist()


def start_shared(spark: SparkSession, raw: DataFrame, segments: DataFrame, out_root: str,
                 checkpoint_root: str, result_trigger: str = LV.RESULT_TRIGGER,
                 snapshot_trigger: str = LV.SNAPSHOT_TRIGGER, available_now: bool = False,
                 carry_forward: bool = False, rocksdb: bool = True,
                 min_confidence: float | None = DEFAULT_MIN_CONFIDENCE,
                 watermark: str = LV.DEFAULT_WATERMARK, duration=W.DEFAULT_DURATION,
                 slide=W.DEFAULT_SLIDE, threshold: float = W.DEFAULT_THRESHOLD) -> list[StreamingQuery]:
    """Two queries instead of four: the three windowed results from one
    append query (one window state), and the snapshot query. Returns them."""
    if rocksdb:
        LV.use_rocksdb_state(spark)
    segments = LV.static_lookup(segments)
    cleaned = LV.cleaned_stream(raw, min_confidence, watermark)
    out, ck = out_root.rstrip("/"), checkpoint_root.rstrip("/")
    parts = window_partials(cleaned, duration, slide, threshold)
    w = (parts.writeStream.outputMode("append")
         .foreachBatch(SharedResultsWriter(out, segments, LV.run_id(spark, f"{ck}/results")))
         .option("checkpointLocation", f"{ck}/results"))
    results = LV._trigger(w, result_trigger, available_now).start()
    snap_in = W.by_segment(cleaned, duration, slide, ts="event_time")
    snapshot = LV.start_snapshot(snap_in, f"{out}/{LV.OUTPUTS['snapshot']}", f"{ck}/snapshot",
                                 snapshot_trigger, available_now, carry_forward, segments=segments, rocksdb=rocksdb)
    return [results, snapshot]


def read_result(spark: SparkSession, out_root: str, kind: str) -> DataFrame:
    """One result of ``start_shared`` or ``live.start_all`` (see ``live.read_appended``)."""
    return LV.read_appended(spark, f"{out_root.rstrip('/')}/{LV.OUTPUTS[kind]}")
