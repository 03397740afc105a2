"""Stream fixture: 18 files of JSON lines, one per 10-minute slice from
2023-01-01T00:00, segments 1-3 (segment 3 stops after slice 10), plus a
reading of segment 1 at 00:00 placed in slice 12 (late). One file per
trigger, oldest first."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from roadpulse.operators.transform import prepare_segments
from roadpulse.schemas import SEGMENT
from roadpulse.sources.readers import read_snapshot, snapshot_versions
from roadpulse.streaming import live

T0 = dt.datetime(2023, 1, 1)


def _msg(xd, ts, speed=30.0):
    return json.dumps({"xd_id": xd, "measurement_tstamp": ts.isoformat(), "speed": speed,
                       "reference_speed": 50.0, "confidence_score": 30.0})


def _write_fixture(root):
    os.makedirs(root)
    base = 1_700_000_000
    for k in range(18):
        ts = T0 + dt.timedelta(minutes=10 * k)
        lines = [_msg(1, ts), _msg(2, ts, 10.0)]
        if k <= 10:
            lines.append(_msg(3, ts, 45.0))
        if k == 12:
            lines.append(_msg(1, T0, 5.0))  # late
        p = os.path.join(root, f"slice_{k:02d}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (base + k, base + k))


def test_live_pipeline_fixture(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _write_fixture(src)
    segments = prepare_segments(spark.createDataFrame(
        [(1, "A", 1, "N", 36.0, -86.8, 36.1, -86.7), (2, "B", 3, "E", 36.0, -86.8, 36.1, -86.7)], SEGMENT))
    raw = live.file_stream(spark, src, max_files_per_trigger=1)
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    qs = live.start_all(spark, raw, segments, out, ck, available_now=True)
    for q in qs:
        q.awaitTermination()
    seg = live.read_appended(spark, f"{out}/{live.OUTPUTS['by_segment']}")
    assert seg.count() == 48
    starts = seg.agg(F.min("window_start"), F.max("window_start")).first()
    assert starts[0] == dt.datetime(2022, 12, 31, 23, 10) and starts[1] == dt.datetime(2023, 1, 1, 1, 40)
    assert live.dropped_by_watermark(qs[0]) == 6
    # the late reading (speed 5) changed nothing
    assert seg.where(F.col("xd_id") == 1).agg(F.max("avg_speed")).first()[0] == 30.0
    # unknown segment 3 kept with NULL attributes; closed windows have 6 readings at most
    assert seg.where(F.col("xd_id") == 3).where(F.col("road_name").isNull()).count() == 16
    assert seg.agg(F.max("reading_count")).first()[0] == 6
    rt = spark.read.parquet(f"{out}/{live.OUTPUTS['by_road_type']}")
    assert rt.where(F.col("frc").isNull()).count() == 16
    net = spark.read.parquet(f"{out}/{live.OUTPUTS['network']}").orderBy("window_start").collect()
    assert net[0].total_segments == 3 and net[0].congested_segments == 2  # scores 0.4, 0.8, 0.1
    # snapshot: a ring of 3 slots holds the last 3 data batches (15-17); segment 3
    # stopped after slice 10, so no retained version has it
    snap_root = f"{out}/{live.OUTPUTS['snapshot']}"
    kept = {r.version: r.slot for r in snapshot_versions(spark, snap_root).collect()}
    newest = max(kept)
    assert sorted(kept) == [newest - 2, newest - 1, newest] and sorted(kept.values()) == [0, 1, 2]
    for slot in kept.values():
        v = spark.read.parquet(f"{snap_root}/data/slot={slot}")
        assert sorted(r.xd_id for r in v.select("xd_id").collect()) == [1, 2]
    newest = read_snapshot(spark, snap_root)
    assert newest.count() == 2
    assert {r.xd_id: r.road_name for r in newest.collect()} == {1: "A", 2: "B"}  # lookup joined after
    assert newest.where(F.col("xd_id") == 1).first().window_start == dt.datetime(2023, 1, 1, 2, 50)


def test_restart_emits_nothing_twice(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    _write_fixture(src)
    segments = prepare_segments(spark.createDataFrame([], SEGMENT))
    frames = live.live_frames(live.file_stream(spark, src, max_files_per_trigger=1), segments)
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    live.start_append(frames["by_segment"], out, ck, available_now=True).awaitTermination()
    n = spark.read.parquet(out).count()
    frames = live.live_frames(live.file_stream(spark, src, max_files_per_trigger=1), segments)
    live.start_append(frames["by_segment"], out, ck, available_now=True).awaitTermination()
    assert spark.read.parquet(out).count() == n == 48


def test_snapshot_writer_modes(spark, tmp_dir):
    from roadpulse.streaming.snapshot_sink import SnapshotWriter
    schema = "xd_id LONG, avg_congestion DOUBLE, window_start TIMESTAMP_NTZ"
    b0 = spark.createDataFrame([(1, 0.1, T0), (1, 0.2, T0 + dt.timedelta(minutes=10)), (2, 0.5, T0)], schema)
    b1 = spark.createDataFrame([(1, 0.4, T0 + dt.timedelta(minutes=20))], schema)
    for carry, expect in [(False, {1}), (True, {1, 2})]:
        root = f"{tmp_dir}/snap_{carry}"
        w = SnapshotWriter(root, carry_forward=carry)
        w(b0, 0)
        first = {r.xd_id: r.avg_congestion for r in read_snapshot(spark, root).collect()}
        assert first == {1: 0.2, 2: 0.5}
        w(b1, 1)
        w(b1, 1)  # replayed batch: written once
        got = {r.xd_id: r.avg_congestion for r in read_snapshot(spark, root).collect()}
        assert set(got) == expect and got[1] == 0.4
        w(spark.createDataFrame([], schema), 2)  # empty batch: nothing committed
        assert spark.read.parquet(f"{root}/commits").agg(F.max("version")).first()[0] == 1


def test_snapshot_ring_is_bounded_and_skips_empty_batches(spark, tmp_dir):
    from roadpulse.streaming.snapshot_sink import SnapshotWriter
    schema = "xd_id LONG, avg_congestion DOUBLE, window_start TIMESTAMP_NTZ"
    root = f"{tmp_dir}/ring"
    w = SnapshotWriter(root, carry_forward=True, keep=3)
    empty = spark.createDataFrame([], schema)
    w(spark.createDataFrame([(1, 0.1, T0), (2, 0.2, T0)], schema), 0)
    w(empty, 1)
    w(empty, 2)
    w(empty, 3)
    # the newest committed version (0, slot 0) is merged, the write goes to slot 1 as version 1
    w(spark.createDataFrame([(1, 0.3, T0 + dt.timedelta(minutes=10))], schema), 4)
    assert {r.version: r.slot for r in snapshot_versions(spark, root).collect()} == {0: 0, 1: 1}
    assert {r.xd_id: r.avg_congestion for r in read_snapshot(spark, root).collect()} == {1: 0.3, 2: 0.2}
    for b in range(5, 12):
        w(spark.createDataFrame([(1, 0.01 * b, T0 + dt.timedelta(minutes=10 * b))], schema), b)
    kept = {r.version: r.slot for r in snapshot_versions(spark, root).collect()}
    assert sorted(kept) == [6, 7, 8] and sorted(kept.values()) == [0, 1, 2]
    assert sorted(os.listdir(f"{root}/data")) == ["slot=0", "slot=1", "slot=2"]
    w(spark.createDataFrame([(1, 9.9, T0)], schema), 11)  # replay of a committed batch: no write
    got = {r.xd_id: r.avg_congestion for r in read_snapshot(spark, root).collect()}
    assert got == {1: 0.11, 2: 0.2}


def test_shared_results_equal_per_result_queries(spark, tmp_dir):
    from roadpulse.streaming import shared
    src = f"{tmp_dir}/in"
    _write_fixture(src)
    segments = prepare_segments(spark.createDataFrame(
        [(1, "A", 1, "N", 36.0, -86.8, 36.1, -86.7), (2, "B", 3, "E", 36.0, -86.8, 36.1, -86.7)], SEGMENT))
    outs = {}
    for mode in ("separate", "shared"):
        raw = live.file_stream(spark, src, max_files_per_trigger=1)
        out, ck = f"{tmp_dir}/out_{mode}", f"{tmp_dir}/ck_{mode}"
        start = live.start_all if mode == "separate" else shared.start_shared
        qs = start(spark, raw, segments, out, ck, available_now=True)
        assert len(qs) == (4 if mode == "separate" else 2)
        for q in qs:
            q.awaitTermination()
        outs[mode] = out

    def rows(mode, kind):
        df = shared.read_result(spark, outs[mode], kind).drop("written_at")
        cols = sorted(df.columns)
        return sorted(tuple(r) for r in df.select(*cols).collect())

    assert rows("shared", "by_segment") == rows("separate", "by_segment")
    assert len(rows("shared", "by_segment")) == 48
    assert rows("shared", "by_road_type") == rows("separate", "by_road_type")
    net = shared.read_result(spark, outs["shared"], "network").orderBy("window_start").collect()
    approx = shared.read_result(spark, outs["separate"], "network").count()
    assert len(net) == approx
    assert net[0].total_segments == 3 and net[0].congested_segments == 2
    assert all(r.congested_segments <= r.total_segments for r in net)
    assert read_snapshot(spark, f"{outs['shared']}/{live.OUTPUTS['snapshot']}").count() == 2


def test_shared_writer_replayed_batch_replaces_rows(spark, tmp_dir):
    from roadpulse.streaming import shared
    seg = prepare_segments(spark.createDataFrame([(1, "A", 1, "N", 0.0, 0.0, 0.0, 0.0)], SEGMENT))
    w0 = T0 + dt.timedelta(hours=1)
    parts = spark.createDataFrame(
        [((w0, w0 + dt.timedelta(hours=1)), 1, 60.0, 2, 0.8, 2, 2, 1),
         ((w0, w0 + dt.timedelta(hours=1)), 7, 30.0, 1, 0.1, 1, 1, 0)],
        "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, xd_id LONG, s_speed DOUBLE, n_speed LONG, "
        "s_score DOUBLE, n_score LONG, reading_count LONG, hot INT")
    w = shared.SharedResultsWriter(f"{tmp_dir}/out", seg)
    w(parts, 3)
    w(parts, 3)  # replay of the same batch
    w(spark.createDataFrame([], parts.schema), 4)  # empty batch writes nothing
    net = shared.read_result(spark, f"{tmp_dir}/out", "network").collect()
    assert [(r.total_segments, r.congested_segments, r.pct_congested) for r in net] == [(2, 1, 50.0)]
    rt = {r.frc: (r.avg_speed, r.reading_count)
          for r in shared.read_result(spark, f"{tmp_dir}/out", "by_road_type").collect()}
    assert rt == {1: (30.0, 2), None: (30.0, 1)}
    by_seg = shared.read_result(spark, f"{tmp_dir}/out", "by_segment")
    assert by_seg.count() == 2 and by_seg.where("xd_id = 7 AND road_name IS NULL").count() == 1


def test_exact_network_on_a_stream_points_to_shared(spark, tmp_dir):
    import pytest

    from roadpulse.operators import windows as W
    src = f"{tmp_dir}/in"
    _write_fixture(src)
    cleaned = live.cleaned_stream(live.file_stream(spark, src))
    with pytest.raises(ValueError, match="start_shared"):
        W.network(cleaned, exact=True, ts="event_time")
    with pytest.raises(ValueError):
        W.latest_window(cleaned, ts="event_time")


def _windows_batch(spark, value, hour=0, xd=1):
    rows = [(xd, value, value, 1, dt.datetime(2023, 1, 1, hour), dt.datetime(2023, 1, 1, hour + 1), 2023, 1, 1)]
    return spark.createDataFrame(rows, "xd_id long, avg_speed double, avg_congestion double, reading_count long, "
                                       "window_start timestamp, window_end timestamp, year int, month int, day int")


def test_a_fresh_checkpoint_continues_the_snapshot_versions(spark, tmp_dir):
    from roadpulse.streaming.snapshot_sink import SnapshotWriter
    root = tmp_dir + "/snap"
    first = SnapshotWriter(root, run="a")
    for batch in (7, 8, 9):
        first(_windows_batch(spark, float(batch)), batch)
    again = SnapshotWriter(root, run="b")
    again(_windows_batch(spark, 100.0), 0)
    assert [r.avg_speed for r in read_snapshot(spark, root).collect()] == [100.0]
    again(_windows_batch(spark, 101.0), 9)  # the same batch id as an older run's: not skipped
    again(_windows_batch(spark, 102.0), 9)  # its replay: skipped
    assert [r.avg_speed for r in read_snapshot(spark, root).collect()] == [101.0]


def test_run_id_stays_with_its_checkpoint(spark, tmp_dir):
    a = live.run_id(spark, tmp_dir + "/ck1")
    assert live.run_id(spark, tmp_dir + "/ck1") == a and live.run_id(spark, tmp_dir + "/ck2") > a


def test_results_of_a_later_run_replace_the_same_windows(spark, tmp_dir):
    from roadpulse.streaming import shared
    rows = lambda run, value: (spark.createDataFrame(
        [(dt.datetime(2023, 1, 1, h), value, 2023, 1, 1, run, 0) for h in ((0, 1) if run == "1" else (1, 2))],
        "window_start timestamp, total_segments int, year int, month int, day int, run string, batch_id long")
        .write.mode("append").partitionBy("year", "month", "day", "run", "batch_id")
        .parquet(f"{tmp_dir}/{live.OUTPUTS['network']}"))
    rows("1", 5)
    rows("2", 6)
    got = sorted((r.window_start.hour, r.total_segments) for r in shared.read_result(spark, tmp_dir, "network").collect())
    assert [v for _, v in got] == [5, 6, 6]


def test_late_rows_are_counted_over_all_reports(spark):
    class Op:
        def __init__(self, n): self.numRowsDroppedByWatermark = n

    class Event:
        def __init__(self, n): self.progress = type("P", (), {"id": "q", "stateOperators": [Op(n), Op(0)]})()

    late = live.LateRows()
    for n in range(200):
        late.onQueryProgress(Event(n))
    assert late.dropped == {"q": sum(range(200))}


def test_a_fresh_checkpoint_adds_to_the_output(spark, tmp_dir):
    """Batches of a second run count from 0 again; none of its windows is lost."""
    segments = prepare_segments(spark.createDataFrame([], SEGMENT))
    out = f"{tmp_dir}/out"
    for day in (1, 2):
        src = f"{tmp_dir}/in{day}"
        os.makedirs(src)
        lines = [_msg(1, dt.datetime(2023, 1, day, h)) for h in range(6)]
        with open(f"{src}/a.json", "w") as f:
            f.write("\n".join(lines) + "\n")
        frames = live.live_frames(live.file_stream(spark, src), segments)
        live.start_append(frames["by_segment"], out, f"{tmp_dir}/ck{day}", available_now=True).awaitTermination()
    days = {r.day: r["count"] for r in live.read_appended(spark, out).where("hour(window_start) between 1 and 3").groupBy("day").count().collect()}
    assert days == {1: 18, 2: 18}


def test_a_later_run_replaces_the_windows_it_writes_again(spark, tmp_dir):
    def rows(speed):
        return spark.createDataFrame([(1, speed, T0, 2023, 1, 1)], "xd_id long, avg_speed double, window_start timestamp, year int, month int, day int")
    live.AppendWriter(f"{tmp_dir}/o", "0001")(rows(1.0), 0)
    live.AppendWriter(f"{tmp_dir}/o", "0002")(rows(2.0), 0)
    live.AppendWriter(f"{tmp_dir}/o", "0002")(rows(2.0), 0)
    assert [r.avg_speed for r in live.read_appended(spark, f"{tmp_dir}/o").collect()] == [2.0]
