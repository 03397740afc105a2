"""Kafka source and sink (needs the spark-sql-kafka package on the cluster;
it is not bundled with pyspark, so nothing here runs in the local tests —
the message encoding/decoding they use is ``replay.to_messages`` /
``transform.parse``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.replay import to_messages
from ..streaming.replay_query import replay


def source_options(bootstrap: str, topic: str, starting: str = "latest",
                   fail_on_data_loss: bool = False) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str, starting: str = "latest",
                 fail_on_data_loss: bool = False, max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Streaming frame with Kafka's ``key``/``value`` (binary) columns.

    ``max_offsets_per_trigger`` bounds a micro-batch (catch-up after an
    outage); ``min_partitions`` splits topic partitions into more Spark tasks
    than the topic has partitions."""
    r = spark.readStream.format("kafka").options(**source_options(bootstrap, topic, starting,
                                                                  fail_on_data_loss))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        r = r.option("minPartitions", str(min_partitions))
    return r.load()


def kafka_dump(spark: SparkSession, bootstrap: str, topic: str) -> DataFrame:
    """Bounded read of a whole topic from the earliest offset, decoded."""
    raw = (spark.read.format("kafka")
           .options(**source_options(bootstrap, topic, "earliest"))
           .option("endingOffsets", "latest").load())
    return decode(raw)


def decode(raw: DataFrame) -> DataFrame:
    return raw.select("topic", "partition", "offset", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"))


def sink_options(bootstrap: str, topic: str) -> dict[str, str]:
    # Producer settings of the replay (lz4, all acks, 128 KiB batches, 20 ms linger).
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic,
            "kafka.compression.type": "lz4", "kafka.acks": "all",
            "kafka.batch.size": "131072", "kafka.linger.ms": "20"}


def write_kafka(readings: DataFrame, bootstrap: str, topic: str) -> None:
    """Publish readings as JSON messages keyed by segment id (one segment
    stays on one topic partition)."""
    to_messages(readings).write.format("kafka").options(**sink_options(bootstrap, topic)).save()


def replay_kafka(readings: DataFrame, bootstrap: str, topic: str, checkpoint: str, start, end=None, minutes: int = 10,
                 slices_per_batch: int = 1, interval: str = "0 seconds") -> int:
    """Publish a replay in time order, micro-batch after micro-batch of slices,
    so that no message is late for the readers' watermark; a replay that was
    stopped goes on from its checkpoint. Returns the number of slices."""
    return replay(readings.sparkSession, readings, lambda part, _: write_kafka(part, bootstrap, topic), checkpoint, start, end,
                  minutes, slices_per_batch, interval)


def console(decoded: DataFrame, rows: int = 20):
    """Print decoded messages: ``show`` for a bounded frame, a console sink
    for a stream (returns the started query)."""
    if decoded.isStreaming:
        return (decoded.writeStream.format("console").option("truncate", "false")
                .option("numRows", str(rows)).start())
    decoded.show(rows, truncate=False)
    return None
