import json

from pyspark.sql import functions as F

from roadpulse import fixtures as fx
from roadpulse.__main__ import main
from roadpulse.sources.readers import read_historical

SF = "/root/testdata/sf0.001"


def test_batch_jobs_from_the_command_line(spark, tmp_dir, capsys):
    csv, segs = f"{tmp_dir}/raw.csv", f"{tmp_dir}/xd.csv"
    fx.readings_long(spark, SF).write.option("header", True).csv(csv)
    fx.segments(spark, SF).select(
        "xd", F.col("road_name").alias("road-name"), "frc", "bearing",
        F.col("start_lat").alias("start_latitude"), F.col("start_long").alias("start_longitude"),
        F.col("end_lat").alias("end_latitude"), F.col("end_long").alias("end_longitude"),
    ).write.option("header", True).option("quoteAll", True).csv(segs)
    assert main(["--local", "ingest", "--csv", csv, "--out", f"{tmp_dir}/staged",
                 "--historical", "1996-01-01", "1997-12-31", "--replay", "1998-01-01", "1998-03-31"]) == 0
    counters = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counters["total_rows"] == fx.readings_long(spark, SF).count()
    assert main(["--local", "compact-raw", "--src", f"{tmp_dir}/staged/split=historical",
                 "--dst", f"{tmp_dir}/raw"]) == 0
    assert main(["--local", "historical", "--raw", f"{tmp_dir}/raw", "--segments", segs,
                 "--out", f"{tmp_dir}/hist", "--year", "1997"]) == 0
    assert main(["--local", "compact-results", "--src", f"{tmp_dir}/hist", "--dst", f"{tmp_dir}/hc",
                 "--year", "1997"]) == 0
    top = read_historical(spark, f"{tmp_dir}/hc", "top_segments", 1997, ordered=True)
    assert top.count() <= 20 * 12 and top.where(F.col("year") != 1997).count() == 0
    by_hour = read_historical(spark, f"{tmp_dir}/hc", "by_hour", 1997, month=3).collect()
    assert len(by_hour) > 12 and {r.hour for r in by_hour} <= set(range(24))


def test_live_shared_from_the_command_line(spark, tmp_dir):
    from roadpulse.operators.replay import to_messages
    from roadpulse.streaming import shared
    from roadpulse.streaming.live import OUTPUTS
    src, segs = f"{tmp_dir}/in", f"{tmp_dir}/xd.csv"
    to_messages(fx.readings(spark, SF)).select("value").write.text(src)
    fx.segments(spark, SF).select(
        "xd", F.col("road_name").alias("road-name"), "frc", "bearing",
        F.col("start_lat").alias("start_latitude"), F.col("start_long").alias("start_longitude"),
        F.col("end_lat").alias("end_latitude"), F.col("end_long").alias("end_longitude"),
    ).write.option("header", True).option("quoteAll", True).csv(segs)
    assert main(["--local", "live", "--segments", segs, "--out", f"{tmp_dir}/out",
                 "--checkpoints", f"{tmp_dir}/ck", "--files", src, "--available-now", "--shared",
                 "--late", f"{tmp_dir}/late", "--malformed", f"{tmp_dir}/bad", "--latest", f"{tmp_dir}/latest"]) == 0
    from roadpulse.streaming.latest import read_latest
    assert read_latest(spark, f"{tmp_dir}/latest").count() > 1
    assert spark.read.schema("value string, reason string").parquet(f"{tmp_dir}/bad").count() == 0
    net = shared.read_result(spark, f"{tmp_dir}/out", "network")
    assert net.count() > 0 and net.where(F.col("congested_segments") > F.col("total_segments")).count() == 0
    seg = shared.read_result(spark, f"{tmp_dir}/out", "by_segment")
    assert seg.agg(F.max("reading_count")).first()[0] >= 1
    assert spark.read.parquet(f"{tmp_dir}/out/{OUTPUTS['snapshot']}/commits").count() >= 1


def test_replay_to_a_topic_keeps_time_order(spark, tmp_dir, monkeypatch):
    """A sink that records the calls: slices come in order, each sorted by time."""
    from roadpulse.operators.prepare import with_partitions
    from roadpulse.sources import kafka
    raw, seen = f"{tmp_dir}/raw", []
    with_partitions(fx.readings(spark, SF)).write.partitionBy("year", "month").parquet(raw)
    monkeypatch.setattr(kafka, "write_kafka", lambda part, servers, topic: seen.append(
        [r.measurement_tstamp for r in part.select("measurement_tstamp").collect()]))
    assert main(["--local", "replay", "--raw", raw, "--start", "2024-01-03", "--end", "2024-01-05", "--minutes", "360",
                 "--kafka", "broker"]) == 0
    seen = [x for x in seen if x]
    assert all(a[-1] < b[0] for a, b in zip(seen, seen[1:])) and len(seen) == 8
    assert [sorted(x) for x in seen] == seen
    times = sorted(r.measurement_tstamp for r in fx.readings(spark, SF).where(
        "measurement_tstamp between '2024-01-03' and '2024-01-05'").collect())
    assert [t for x in seen for t in x] == times
