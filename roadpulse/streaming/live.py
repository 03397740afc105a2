"""The live pipeline on Structured Streaming.

source (Kafka or files of JSON lines, both give a ``value`` column)
  -> parse -> clean (confidence >= 20, non-NULL, reference > 0) + score
  -> watermark on ``event_time``
  -> three sliding-window aggregates (per segment, network KPI, per road
     class) appended to date-partitioned Parquet, plus the latest-window
     snapshot through ``foreachBatch``.

Each query has its own checkpoint folder; triggers are parameters
(``processingTime`` or ``availableNow``).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators import windows as W
from ..session import scratch_path
from ..operators.transform import DEFAULT_MIN_CONFIDENCE, clean, enrich, parse
from .snapshot_sink import SnapshotWriter

DEFAULT_WATERMARK = "10 minutes"
RESULT_TRIGGER = "2 minutes"
SNAPSHOT_TRIGGER = "20 seconds"
MAX_FILE_AGE = "36500d"
OUTPUTS = {"by_segment": "congestion_by_segment", "network": "network_congestion_pct",
           "by_road_type": "congestion_by_road_type", "snapshot": "latest_congestion_by_segment"}


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files of JSON lines as a stream with one ``value`` text column (the
    same column a Kafka source gives). Files are taken oldest first."""
    # Age never drops a file: a backfill may bring files older than the newest one seen.
    r = spark.readStream.format("text").option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return r.load(path)


def cleaned_stream(raw: DataFrame, min_confidence: float | None = DEFAULT_MIN_CONFIDENCE,
                   watermark: str = DEFAULT_WATERMARK) -> DataFrame:
    return clean(parse(raw), min_confidence).withWatermark("event_time", watermark)


def live_frames(raw: DataFrame, segments: DataFrame, min_confidence: float | None = DEFAULT_MIN_CONFIDENCE,
                watermark: str = DEFAULT_WATERMARK, duration=W.DEFAULT_DURATION,
                slide=W.DEFAULT_SLIDE, threshold: float = W.DEFAULT_THRESHOLD,
                written_at: bool = True) -> dict[str, DataFrame]:
    """The three streaming aggregates (not started)."""
    cleaned = cleaned_stream(raw, min_confidence, watermark)
    return {
        "by_segment": W.by_segment(cleaned, duration, slide, ts="event_time", segments=segments,
                                   written_at=written_at),
        # the snapshot's input: same windows on the minimal key; the sink
        # joins the lookup after picking the newest window per segment
        "by_segment_keys": W.by_segment(cleaned, duration, slide, ts="event_time",
                                        written_at=written_at),
        "network": W.network(cleaned, duration, slide, threshold, exact=False, ts="event_time",
                             written_at=written_at),
        "by_road_type": W.by_road_type(enrich(cleaned, segments, "left", attrs=["frc"], repeated=True),
                                       duration, slide, ts="event_time", written_at=written_at),
    }


def _trigger(writer, interval: str | None, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


class AppendWriter:
    """``foreachBatch`` writer of closed windows, partitioned by the window's
    date, the run (a checkpoint's id) and the batch: a batch that is run again
    replaces its own rows, and a run with a fresh checkpoint, whose batches
    count from 0 again, adds its rows beside those of earlier runs. Read the
    rows with ``read_appended``."""

    def __init__(self, path: str, run: str):
        self.path, self.run = path, run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        (batch_df.withColumn("run", F.lit(self.run)).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "month", "day", "run", "batch_id").parquet(self.path))


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """Closed windows written by one or more runs, without run and batch: of a
    window that several runs wrote, the newest run's rows."""
    rows = spark.read.parquet(path).withColumn("run", F.col("run").cast("string"))
    newest = rows.groupBy("window_start").agg(F.max("run").alias("run"))
    return rows.join(newest, ["window_start", "run"], "left_semi").drop("run", "batch_id")


def start_append(df: DataFrame, path: str, checkpoint: str, interval: str = RESULT_TRIGGER,
                 available_now: bool = False, name: str | None = None, rocksdb: bool = True) -> StreamingQuery:
    """Append closed windows to Parquet partitioned by the window's date. The
    checkpoint may be replaced by a fresh one over the same output (the file
    sink's own commit log would then skip the new run's batches)."""
    if rocksdb:
        use_rocksdb_state(df.sparkSession)
    w = (df.writeStream.outputMode("append").foreachBatch(AppendWriter(path, run_id(df.sparkSession, checkpoint)))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return _trigger(w, interval, available_now).start()


def start_snapshot(by_segment: DataFrame, root: str, checkpoint: str,
                   interval: str = SNAPSHOT_TRIGGER, available_now: bool = False,
                   carry_forward: bool = False, name: str | None = None,
                   segments: DataFrame | None = None, rocksdb: bool = True) -> StreamingQuery:
    """Update-mode per-segment windows -> newest window per segment (+ the
    lookup attributes when ``segments`` is given)."""
    if rocksdb:
        use_rocksdb_state(by_segment.sparkSession)
    w = (by_segment.writeStream.outputMode("update")
         .foreachBatch(SnapshotWriter(root, carry_forward, segments=segments,
                                      run=run_id(by_segment.sparkSession, checkpoint)))
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return _trigger(w, interval, available_now).start()


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the run that a checkpoint folder belongs to: kept in the folder,
    so a restart keeps it and a fresh checkpoint gets a new, later one."""
    path = f"{checkpoint.rstrip('/')}/run_id"
    # Looked up first: reading a path that isn't there logs a Java stack trace for every fresh checkpoint.
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.text(path).first()["value"]
    made = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([(made,)], "value string").coalesce(1).write.text(path)
    return made


def static_lookup(segments: DataFrame) -> DataFrame:
    """The lookup as it is at the start of the stream, whatever its size: a
    copy in the shared checkpoint folder. (The lookup of a stream-static join
    is evaluated every micro-batch: without the copy it would be read and
    de-duplicated again, and change under the stream.) Nothing stays persisted."""
    spark = segments.sparkSession
    path = scratch_path(spark, "lookup")
    segments.write.parquet(path)
    return spark.read.schema(segments.schema).parquet(path)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
ROCKSDB_CONF = {"trackTotalNumberOfRows": "false", "boundedMemoryUsage": "true", "maxMemoryUsageMB": "1000"}
STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb_state(spark: SparkSession) -> None:
    """RocksDB state store (off-heap, incremental changelog checkpoints) for
    the per-segment window state, unless the session already chose one. A
    query keeps the provider of its first run (recorded in its checkpoint).

    The stores of an executor share one bounded cache and write buffer: the
    memory doesn't grow with the number of stores. Rows of the state are not
    counted, which would look up every key before its write."""
    current = spark.conf.get(STATE_PROVIDER_KEY, None)
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    if current in (None, "", default):
        spark.conf.set(STATE_PROVIDER_KEY, ROCKSDB_PROVIDER)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    for key, value in ROCKSDB_CONF.items():
        if spark.conf.get(f"{_ROCKSDB}.{key}", None) is None:
            spark.conf.set(f"{_ROCKSDB}.{key}", value)


def start_all(spark: SparkSession, raw: DataFrame, segments: DataFrame, out_root: str,
              checkpoint_root: str, result_trigger: str = RESULT_TRIGGER,
              snapshot_trigger: str = SNAPSHOT_TRIGGER, available_now: bool = False,
              carry_forward: bool = False, rocksdb: bool = True, **params) -> list[StreamingQuery]:
    """Start the four live queries; returns them (await with
    ``spark.streams.awaitAnyTermination()``)."""
    if rocksdb:
        use_rocksdb_state(spark)
    segments = static_lookup(segments)
    frames = live_frames(raw, segments, **params)
    out, ck = out_root.rstrip("/"), checkpoint_root.rstrip("/")
    queries = [start_append(frames[k], f"{out}/{OUTPUTS[k]}", f"{ck}/{k}", result_trigger, available_now, rocksdb=rocksdb)
               for k in ("by_segment", "network", "by_road_type")]
    queries.append(start_snapshot(frames["by_segment_keys"], f"{out}/{OUTPUTS['snapshot']}",
                                  f"{ck}/snapshot", snapshot_trigger, available_now, carry_forward,
                                  segments=segments, rocksdb=rocksdb))
    return queries


class LateRows(StreamingQueryListener):
    """Counts rows dropped as late, per query id, over every progress report
    of a session (add it with ``spark.streams.addListener`` before the start)."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(int(op.numRowsDroppedByWatermark or 0) for op in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def counted(self, query: StreamingQuery) -> int:
        """Late rows of a query; for one that has ended, after its last report."""
        return max(self.dropped.get(str(query.id), 0), dropped_by_watermark(query))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows dropped as late over the query's retained progress reports (a
    long stream keeps only the newest; ``LateRows`` counts them all)."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(v or 0)
    return total
