"""The Kafka connector without a broker: option maps, and the decoding of a
frame shaped like a Kafka batch (binary key/value plus topic, partition,
offset). The connector package itself is not bundled with pyspark."""

import datetime as dt

from pyspark.sql import functions as F

from roadpulse.operators.replay import to_messages
from roadpulse.operators.transform import parse
from roadpulse.schemas import READING
from roadpulse.sources import kafka as K


def test_option_maps():
    src = K.source_options("broker:9092", "road-segments")
    assert src == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "road-segments",
                   "startingOffsets": "latest", "failOnDataLoss": "false"}
    assert K.source_options("b", "t", "earliest", True)["failOnDataLoss"] == "true"
    sink = K.sink_options("broker:9092", "road-segments")
    assert sink["topic"] == "road-segments" and sink["kafka.compression.type"] == "lz4"
    assert sink["kafka.acks"] == "all"


def test_decode_and_parse_a_kafka_shaped_batch(spark, capsys):
    t = dt.datetime
    rows = [(7, t(2023, 1, 1, 0, 10), 31.0, 50.0, 30.0), (8, t(2023, 1, 1, 0, 10, 0, 5), None, 40.0, 25.0)]
    msgs = to_messages(spark.createDataFrame(rows, READING))
    batch = msgs.select(F.lit("road-segments").alias("topic"), F.lit(3).alias("partition"),
                        F.monotonically_increasing_id().alias("offset"),
                        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    decoded = K.decode(batch)
    assert [f.dataType.simpleString() for f in decoded.schema.fields] == ["string", "int", "bigint",
                                                                           "string", "string"]
    assert sorted(r.key for r in decoded.collect()) == ["7", "8"]
    back = {r.xd_id: r for r in parse(batch).collect()}
    assert back[7].event_time == t(2023, 1, 1, 0, 10) and back[7].speed == 31.0
    assert back[8].speed is None and back[8].event_time == t(2023, 1, 1, 0, 10, 0, 5)
    K.console(decoded, rows=5)
    assert "road-segments" in capsys.readouterr().out
