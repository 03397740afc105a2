"""What an at-least-once topic brings besides good readings: repeats, and
messages that can't be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, StringType, StructType

from ..schemas import MEASURES, MESSAGE
from . import live as LV

_CORRUPT = "corrupt"


def without_repeats(cleaned: DataFrame, ts: str = "event_time") -> DataFrame:
    """A watermarked stream with the first message of each segment and time.
    State is kept as long as the watermark allows a repeat to come. Readings
    without a segment id are repeats only when all their values are equal."""
    values = F.when(F.col("xd_id").isNull(), F.xxhash64(*MEASURES))
    return (cleaned.withColumn("repeat_of", values).dropDuplicatesWithinWatermark(["xd_id", ts, "repeat_of"])
            .drop("repeat_of"))


def malformed(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The messages that give no reading or not all of it: ``value`` (text) and
    ``reason``: ``empty``, ``json`` (no object, or a field of a wrong type),
    ``time`` (a time that can't be read). A missing or null field is no fault."""
    value = F.col(value_col).cast("string") if isinstance(raw.schema[value_col].dataType, BinaryType) else F.col(value_col)
    schema = StructType([*MESSAGE.fields]).add(_CORRUPT, StringType())
    data = F.from_json(value, schema, {"mode": "PERMISSIVE", "allowNonNumericNumbers": "true", "columnNameOfCorruptRecord": _CORRUPT})
    time = F.col("data.measurement_tstamp")
    reason = (F.when(F.trim(F.coalesce(F.col("value"), F.lit(""))) == "", "empty")
              .when(F.col("data").isNull() | F.col(f"data.{_CORRUPT}").isNotNull(), "json")
              .when(time.isNotNull() & F.try_to_timestamp(time).isNull(), "time"))
    return raw.select(value.alias("value"), data.alias("data")).select("value", reason.alias("reason")).where(F.col("reason").isNotNull())


class _BatchWriter:
    """Rows of each batch under ``path/run=/batch_id=``; a repeated batch
    replaces its rows."""

    def __init__(self, path: str, run: str):
        self.path, self.run = path, run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        (batch_df.withColumn("run", F.lit(self.run)).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id").parquet(self.path))


def start_malformed(raw: DataFrame, path: str, checkpoint: str, interval: str = LV.RESULT_TRIGGER,
                    available_now: bool = False) -> StreamingQuery:
    """Keep the malformed messages of a stream, beside the queries that drop them."""
    w = (malformed(raw).writeStream.outputMode("append").foreachBatch(_BatchWriter(path, LV.run_id(raw.sparkSession, checkpoint)))
         .option("checkpointLocation", checkpoint))
    return LV._trigger(w, interval, available_now).start()
