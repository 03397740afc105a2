"""Keyed latest state, late readings, replay driven by a slice clock."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from roadpulse.schemas import READING
from roadpulse.streaming import late, latest, live, replay_query, slots

from test_increments import T0, _files, _msg


def _at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_latest_state_moves_forward_only_and_expires(spark, tmp_dir):
    files = [[_msg(1, _at(0), 10.0), _msg(1, _at(25), 20.0), _msg(2, _at(5)), _msg(None, _at(3), 7.0)],
             [_msg(1, _at(18), 99.0), _msg(1, _at(26), 40.0)],  # late but accepted; same slot as the newest
             [_msg(2, _at(95), 1.0)],
             [_msg(2, _at(96), 3.0)],  # 1 and NULL have been silent for an hour
             [_msg(2, _at(105), 5.0)]]
    _files(f"{tmp_dir}/in", files)
    root = f"{tmp_dir}/latest"
    cleaned = live.cleaned_stream(live.file_stream(spark, f"{tmp_dir}/in", 1))
    latest.start_latest(cleaned, root, f"{tmp_dir}/ck", available_now=True, expire_minutes=45, merge_every=100).awaitTermination()
    seq = F.regexp_extract("_metadata.file_path", r"seq=[^/]*-(\d+)/", 1).cast("int")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/changes").select("*", seq.alias("batch")).collect()
    seen = sorted((r.batch, r.xd_id or -1, r.avg_speed, r.reading_count, r.window_start, r.expired) for r in rows)
    assert [x for x in seen if not x[5]] == [
        (0, -1, 7.0, 1, _at(0), False), (0, 1, 20.0, 1, _at(20), False), (0, 2, 30.0, 1, _at(0), False),
        (1, 1, 30.0, 2, _at(20), False), (2, 2, 1.0, 1, _at(90), False), (3, 2, 2.0, 2, _at(90), False), (4, 2, 5.0, 1, _at(100), False)]
    assert {x[1] for x in seen if x[5]} == {-1, 1}
    got = latest.read_latest(spark, root).collect()
    assert [(r.xd_id, r.avg_speed, r.window_end - r.window_start) for r in got] == [(2, 5.0, dt.timedelta(hours=1))]


def test_changes_are_merged_and_storage_is_bounded(spark, tmp_dir):
    schema = latest._CHANGE
    w = latest.ChangesWriter(f"{tmp_dir}/l", "0001", merge_every=2)
    for b in range(9):
        rows = [(b % 3, float(b), 0.1, 1, _at(b), _at(b + 60), b == 7), (9, float(b), None, 1, _at(b), _at(b + 60), False)]
        frame = spark.createDataFrame(rows, schema)
        w(frame, b)
        w(frame, b)  # a repeated batch
    got = {r.xd_id: r.avg_speed for r in latest.read_latest(spark, f"{tmp_dir}/l").collect()}
    assert got == {0: 6.0, 2: 8.0, 9: 8.0}  # segment 1 expired in batch 7
    assert len(glob.glob(f"{tmp_dir}/l/base/seq=*")) <= 3 and len(glob.glob(f"{tmp_dir}/l/changes/seq=*")) <= 4
    with pytest.raises(FileNotFoundError):
        latest.read_latest(spark, f"{tmp_dir}/none")


def test_every_dropped_reading_is_in_the_side_table(spark, tmp_dir):
    files = [[_msg(1, _at(0)), _msg(2, _at(50))], [_msg(1, _at(31), 1.0), _msg(1, _at(41), 2.0), _msg(3, _at(12), 3.0), _msg(4, _at(90))],
             [_msg(5, _at(69), 4.0), _msg(5, _at(70), 5.0), _msg(6, _at(200))], [_msg(7, _at(10), 6.0)], [_msg(7, _at(300))]]
    _files(f"{tmp_dir}/in", files)
    source = lambda: live.cleaned_stream(live.file_stream(spark, f"{tmp_dir}/in", 1))
    q = live.start_append(slots.by_segment(source()), f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True)
    q.awaitTermination()
    dropped = max(sum(int(p["stateOperators"][k]["numRowsDroppedByWatermark"]) for p in q.recentProgress if p["stateOperators"])
                  for k in (0, 1))
    for _ in range(2):
        late.start_late(source(), f"{tmp_dir}/late", f"{tmp_dir}/ck-late", available_now=True).awaitTermination()
    got = late.read_late(spark, f"{tmp_dir}/late").collect()
    assert sorted(r.speed for r in got) == [1.0, 3.0, 4.0, 5.0, 6.0]
    assert [r.speed for r in got if r.surely_dropped] == [6.0] and dropped == 1


def test_a_repeated_batch_knows_the_same_watermark(spark, tmp_dir):
    def batch(*minutes):
        return spark.createDataFrame([(m, _at(m)) for m in minutes], "xd_id long, event_time timestamp")
    w = late.LateWriter(f"{tmp_dir}/l", "r1")
    w(batch(100), 0)
    w(batch(5, 95, 300), 1)
    late.LateWriter(f"{tmp_dir}/l", "r1")(batch(5, 95, 300), 1)  # run again after a restart
    late.LateWriter(f"{tmp_dir}/l", "r2")(batch(1), 0)  # a fresh checkpoint has no watermark yet
    late.LateWriter(f"{tmp_dir}/l", "r1")(batch(200, 295), 2)
    assert sorted(r.xd_id for r in late.read_late(spark, f"{tmp_dir}/l").collect()) == [5, 200]


def test_replay_goes_on_after_a_failure(spark, tmp_dir):
    rows = [(k, _at(7 * k), float(k), 50.0, 30.0) for k in range(60)]
    readings = spark.createDataFrame(rows, READING)
    sent, failed = {}, []

    def publish(part, batch):
        if batch == 3 and not failed:
            failed.append(batch)
            raise RuntimeError("sink lost")
        sent.setdefault(batch, []).append([r.xd_id for r in part.collect()])
    args = (spark, readings, publish, f"{tmp_dir}/ck", _at(15), _at(300))
    with pytest.raises(Exception, match="sink lost"):
        replay_query.replay(*args, minutes=30, slices_per_batch=2)
    assert sorted(sent) == [0, 1, 2]
    assert replay_query.replay(*args, minutes=30, slices_per_batch=2) == 11
    assert all(len(v) == 1 for v in sent.values())
    assert [x for b in sorted(sent) for x in sent[b][0]] == [k for k in range(60) if 15 <= 7 * k <= 300]
