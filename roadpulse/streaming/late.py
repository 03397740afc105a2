"""The readings that the windows drop as late, kept in a side table.

The engine's watermark of a batch is the newest event time of all earlier
batches, less the delay. A batch closes slots by its own watermark and drops
readings by that of the batch before (its own, if an empty batch came between).
The writer of this query keeps the newest time of every batch, so it knows these
watermarks, also when a batch is run again, and keeps each reading whose slot
had closed: none that is dropped is missing, and ``surely_dropped`` marks those
behind the batch before.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import windows as W
from . import live as LV


class LateWriter:
    """``foreachBatch`` writer of late readings under ``late/`` and, for each
    batch, the newest event time up to it under ``seen/`` (one row a batch)."""

    def __init__(self, root: str, run: str, watermark: str = LV.DEFAULT_WATERMARK, slide=W.DEFAULT_SLIDE, ts: str = "event_time"):
        self.root, self.run, self.ts = root.rstrip("/"), run, ts
        self.delay, self.slide = W.minutes(watermark) * 60_000, W.minutes(slide) * 60_000
        self._known: dict[int, int | None] = {}

    def _before(self, spark: SparkSession, batch_id: int) -> int | None:
        """Newest event time (ms) of the batches before this one."""
        if batch_id <= 0:
            return None
        if batch_id - 1 not in self._known:
            try:
                row = (spark.read.schema("newest long").parquet(f"{self.root}/seen/run={self.run}")
                       .where(F.col("_metadata.file_path").rlike("batch_id=\\d+/"))
                       .select("newest", F.regexp_extract("_metadata.file_path", "batch_id=(\\d+)/", 1).cast("long").alias("b"))
                       .where(F.col("b") < batch_id).agg(F.max("newest")).first())
                self._known[batch_id - 1] = row[0]
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                self._known[batch_id - 1] = None
        return self._known[batch_id - 1]

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark, batch_id = batch_df.sparkSession, int(batch_id)
        before, earlier = self._before(spark, batch_id), self._before(spark, batch_id - 1)
        batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            own = batch_df.agg(F.max(F.floor(F.unix_micros(self.ts) / 1000))).first()[0]
            if before is not None:
                ms = F.floor(F.unix_micros(self.ts) / 1000)
                closes = ms - F.pmod(ms, F.lit(self.slide)) + self.slide
                late = batch_df.where(closes <= F.lit(before - self.delay))
                sure = F.lit(False) if earlier is None else closes <= F.lit(earlier - self.delay)
                (late.withColumn("surely_dropped", sure).withColumn("watermark", F.timestamp_millis(F.lit(before - self.delay)))
                 .withColumn("run", F.lit(self.run)).withColumn("batch_id", F.lit(batch_id).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id")
                 .parquet(f"{self.root}/late"))
        finally:
            batch_df.unpersist()
        newest = max((x for x in (before, own) if x is not None), default=None)
        (spark.createDataFrame([(newest,)], "newest long").coalesce(1).write.mode("overwrite")
         .parquet(f"{self.root}/seen/run={self.run}/batch_id={batch_id}"))
        self._known = {batch_id - 1: before, batch_id: newest}


def start_late(cleaned: DataFrame, root: str, checkpoint: str, interval: str = LV.RESULT_TRIGGER, available_now: bool = False,
               watermark: str = LV.DEFAULT_WATERMARK, slide=W.DEFAULT_SLIDE) -> StreamingQuery:
    """Keep the readings that come when their slot has closed. Lateness is that
    of this query's own batches: with the results' triggers and source options
    the batches are the same."""
    w = (cleaned.writeStream.outputMode("append")
         .foreachBatch(LateWriter(root, LV.run_id(cleaned.sparkSession, checkpoint), watermark, slide))
         .option("checkpointLocation", checkpoint))
    return LV._trigger(w, interval, available_now).start()


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """Late readings of all runs, with the ``watermark`` that they came behind and ``surely_dropped``."""
    return spark.read.parquet(f"{root.rstrip('/')}/late").drop("run", "batch_id")
