"""The latest state of each segment as keyed state, with timers.

``snapshot_sink`` picks the newest window among the rows of a micro-batch. Here
a stateful processor holds, per segment, the sums of its newest slot: a reading
of an older slot that the watermark still accepts changes nothing, a segment
that falls silent expires when the watermark passes its slot by a given time,
and a batch writes the segments it changed, nothing else.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import windows as W
from . import live as LV

_STATE = "slot long, s_speed double, n_speed long, s_score double, n_score long, readings long, timer long"
_CHANGE = ("xd_id long, avg_speed double, avg_congestion double, reading_count long, window_start timestamp, "
           "window_end timestamp, expired boolean")
_MINUTE = 60_000_000  # microseconds
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class LatestState(StatefulProcessor):
    """Sums of a segment's newest slot. Rows, not pandas frames: a batch brings
    a segment a few readings, less than the cost of a frame in and one out."""

    def __init__(self, duration: int, slide: int, expire: int | None):
        self.duration, self.slide, self.expire = duration * _MINUTE, slide * _MINUTE, expire and expire * _MINUTE

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.latest.get() if self.latest.exists() else None
        changed = False
        for row in rows:
            if held is not None and row["slot"] < held[0]:
                continue
            same = held is not None and row["slot"] == held[0]
            slot, s_speed, n_speed, s_score, n_score, n, timer = held if same else (
                row["slot"], 0.0, 0, 0.0, 0, 0, held[6] if held else 0)
            speed, score = row["speed"], row["congestion_score"]
            if speed is not None:
                s_speed, n_speed = s_speed + speed, n_speed + 1
            if score is not None:
                s_score, n_score = s_score + score, n_score + 1
            held = (slot, s_speed, n_speed, s_score, n_score, n + 1, timer)
            changed = True
        if not changed:
            return
        if self.expire:
            timer = (held[0] + self.slide + self.expire) // 1000
            if timer != held[6]:
                if held[6]:
                    self.handle.deleteTimer(held[6])
                self.handle.registerTimer(timer)
                held = (*held[:6], timer)
        self.latest.update(held)
        yield self._row(key, held, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.latest.get()
        self.latest.clear()
        yield self._row(key, held, True)

    def close(self) -> None:
        pass

    def _row(self, key, held, expired: bool) -> Row:
        slot, s_speed, n_speed, s_score, n_score, n, _ = held
        start = _EPOCH + dt.timedelta(microseconds=slot)
        return Row(xd_id=int(key[0]) if key[0] else None, avg_speed=s_speed / n_speed if n_speed else None,
                   avg_congestion=s_score / n_score if n_score else None, reading_count=n, window_start=start,
                   window_end=start + dt.timedelta(microseconds=self.duration), expired=expired)


def latest_changes(cleaned: DataFrame, duration=W.DEFAULT_DURATION, slide=W.DEFAULT_SLIDE, expire_minutes: int | None = None,
                   ts: str = "event_time") -> DataFrame:
    """The changed segments of each micro-batch of a watermarked stream: the
    newest window's means and count, or ``expired`` for a segment without a
    reading for ``expire_minutes`` after its last slot. Readings without a time
    have no slot; those without a segment are one segment of id NULL. Needs the
    RocksDB state store."""
    micros = F.unix_micros(ts)
    step = W.minutes(slide) * _MINUTE
    # The key is text, so that it is never null: a null among numbers would turn the keys of its batch into floats.
    key = F.coalesce(F.col("xd_id").cast("string"), F.lit(""))
    slotted = cleaned.where(F.col(ts).isNotNull()).select(
        key.alias("segment"), ts, (micros - F.pmod(micros, F.lit(step))).alias("slot"), "speed", "congestion_score")
    return slotted.groupBy("segment").transformWithState(
        LatestState(W.minutes(duration), W.minutes(slide), expire_minutes), _CHANGE, "Update", "EventTime")


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _sequences(spark: SparkSession, folder: str) -> list[str]:
    """Complete outputs ``seq=`` of a folder, in order."""
    fs, root = _hadoop(spark, folder)
    if not fs.exists(root):
        return []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return sorted(f.getPath().getName().removeprefix("seq=") for f in fs.listStatus(root)
                  if f.isDirectory() and fs.exists(hadoop.Path(f.getPath(), "_SUCCESS")))


class ChangesWriter:
    """``foreachBatch`` writer: each batch's changes under ``changes/seq=``, a
    repeated batch in its own place. Every ``merge_every`` batches the state of
    all segments is written under ``base/seq=``; what the base before it already
    covers is then removed, so storage follows the number of segments and of
    batches between merges, not the length of the stream."""

    def __init__(self, root: str, run: str, merge_every: int = 100):
        self.root, self.run, self.merge_every = root.rstrip("/"), run, int(merge_every)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark, seq = batch_df.sparkSession, f"{self.run}-{int(batch_id):012d}"
        batch_df.write.mode("overwrite").parquet(f"{self.root}/changes/seq={seq}")
        if (int(batch_id) + 1) % self.merge_every == 0:
            covered = _sequences(spark, f"{self.root}/base")
            _merged(spark, self.root).write.mode("overwrite").parquet(f"{self.root}/base/seq={seq}")
            if covered:
                for kind, last in (("base", covered[-2] if len(covered) > 1 else ""), ("changes", covered[-1])):
                    for old in _sequences(spark, f"{self.root}/{kind}"):
                        if old <= last:
                            fs, path = _hadoop(spark, f"{self.root}/{kind}/seq={old}")
                            fs.delete(path, True)


def _merged(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of each segment, expired ones left out."""
    bases = _sequences(spark, f"{root}/base")
    base = bases[-1:]
    parts = [f"{root}/base/seq={s}" for s in base]
    parts += [f"{root}/changes/seq={s}" for s in _sequences(spark, f"{root}/changes") if not base or s > base[0]]
    if not parts:
        raise FileNotFoundError(f"no batch written under {root}")
    seq = F.regexp_extract("_metadata.file_path", "seq=([^/]+)/", 1)
    rows = spark.read.schema(_CHANGE).parquet(*parts).select("*", seq.alias("seq"))
    columns = [c.split()[0] for c in _CHANGE.split(", ")]
    newest = rows.groupBy("xd_id").agg(F.max_by(F.struct(*columns), F.struct("seq", "window_start", "reading_count")).alias("row"))
    return newest.select("row.*").where(~F.col("expired"))


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """The latest state of every segment that has not expired."""
    return _merged(spark, root.rstrip("/")).drop("expired")


def start_latest(cleaned: DataFrame, root: str, checkpoint: str, interval: str = LV.SNAPSHOT_TRIGGER,
                 available_now: bool = False, expire_minutes: int | None = None, merge_every: int = 100,
                 duration=W.DEFAULT_DURATION, slide=W.DEFAULT_SLIDE) -> StreamingQuery:
    spark = cleaned.sparkSession
    LV.use_rocksdb_state(spark)
    w = (latest_changes(cleaned, duration, slide, expire_minutes).writeStream.outputMode("update")
         .foreachBatch(ChangesWriter(root, LV.run_id(spark, checkpoint), merge_every)).option("checkpointLocation", checkpoint))
    return LV._trigger(w, interval, available_now).start()
