"""Replay as a stream: a clock of slice numbers drives ordered micro-batches.

Each micro-batch stands for the next slices of the replay window; its writer
reads exactly their time range (partitions and row groups are pruned) and hands
the readings, in time order, to a sink. The checkpoint holds the slice reached,
so a replay that was stopped goes on there. No file times are set, and the
driver holds no list of slices.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.replay import _ts, clip, default_end, time_range, to_messages

TS = "measurement_tstamp"


class SliceWriter:
    """``foreachBatch`` writer: the slices whose numbers a batch holds."""

    def __init__(self, readings: DataFrame, publish: Callable[[DataFrame, int], None], start, end, minutes: int, ts: str = TS):
        self.readings, self.publish, self.ts = readings, publish, ts
        self.start, self.end = _ts(start), default_end(start) if end is None else _ts(end)
        self.step = dt.timedelta(minutes=int(minutes))
        # Clock-aligned: the first slice begins at or before the start.
        self.first = self.start - (self.start - dt.datetime(1970, 1, 1)) % self.step
        self.slices = (self.end - self.first) // self.step + 1
        self.done = threading.Event()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        row = batch.agg(F.min("value"), F.max("value")).first()
        if row[0] is not None and row[0] < self.slices:
            lo, hi = self.first + row[0] * self.step, self.first + (row[1] + 1) * self.step
            part = time_range(clip(self.readings, self.start, self.end, self.ts), lo, hi, self.ts)
            self.publish(part.repartitionByRange(self.ts, "xd_id").sortWithinPartitions(self.ts), int(batch_id))
        if row[1] is not None and row[1] + 1 >= self.slices:
            self.done.set()


def start_replay(spark: SparkSession, readings: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint: str, start,
                 end=None, minutes: int = 10, slices_per_batch: int = 1, interval: str = "0 seconds",
                 ts: str = TS) -> tuple[StreamingQuery, SliceWriter]:
    """Start a replay that calls ``publish(readings, batch)`` for each batch of
    slices in time order; ``interval`` paces it. A batch that failed is handed
    over again under its number. Tasks of one batch run side by side: readers
    whose watermark must not drop any need a delay of ``slices_per_batch``
    slices."""
    writer = SliceWriter(readings, publish, start, end, minutes, ts)
    clock = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", int(slices_per_batch))
             .option("numPartitions", 1).load())
    query = (clock.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
             .trigger(processingTime=interval).start())
    return query, writer


def replay(spark: SparkSession, readings: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint: str, start, end=None,
           minutes: int = 10, slices_per_batch: int = 1, interval: str = "0 seconds", ts: str = TS) -> int:
    """Run a replay to its end. Returns the number of slices of the window."""
    query, writer = start_replay(spark, readings, publish, checkpoint, start, end, minutes, slices_per_batch, interval, ts)
    try:
        while not writer.done.wait(0.2):
            if query.exception() is not None or not query.isActive:
                break
    finally:
        query.stop()
    if not writer.done.is_set():
        raise query.exception() or RuntimeError("the replay was stopped before its end")
    return writer.slices


def text_sink(path: str, files: int | None = None) -> Callable[[DataFrame, int], None]:
    """A sink of JSON lines, a folder a batch; a batch handed over again
    replaces its folder. The files of a batch hold consecutive time ranges but
    get no order; with ``files=1`` a file stream takes batch after batch."""
    def publish(part: DataFrame, batch: int) -> None:
        to_messages(part.coalesce(files) if files else part).select("value").write.mode("overwrite").text(f"{path.rstrip('/')}/batch={batch:09d}")
    return publish
