"""Files taken as they arrive, sums and sketches that merge, chained stream
states, repeats, malformed messages, readings by segment."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import historical as H
from roadpulse.operators import sketches as SK
from roadpulse.operators.prepare import with_partitions
from roadpulse.operators.transform import prepare_segments, score
from roadpulse.plans import incremental as INC
from roadpulse.plans import rollup as RU
from roadpulse.plans.batch import run_historical
from roadpulse.plans.prepare import compact_raw
from roadpulse.schemas import READING, SEGMENT
from roadpulse.sources import layout as LY
from roadpulse.streaming import live, slots
from roadpulse.streaming import messages as MS

T0 = dt.datetime(2023, 1, 1)
HIST, REPLAY = ("2023-01-01", "2023-02-28"), ("2023-03-01", "2023-12-31")
NAMES = ["xd_id", "measurement_tstamp", "speed", "reference_speed", "confidence_score"]


def _csv(path, rows, names=NAMES):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(names) + "\n")
        for r in rows:
            f.write(",".join(str(dict(zip(NAMES, r)).get(n, "x")) for n in names) + "\n")


def _row(xd, month, speed=30.0):
    return (xd, f"2023-{month:02d}-05 08:00:00", speed, 50.0, 30.0)


def _ids(spark, out):
    return sorted((r.split, r.month, r.xd_id) for r in spark.read.parquet(out).collect())


def test_files_are_taken_once(spark, tmp_dir):
    csv, out, ck = f"{tmp_dir}/csv", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _csv(f"{csv}/a.csv", [_row(1, 1), _row(2, 3)])
    assert INC.ingest_new(spark, csv, out, ck, HIST, REPLAY) == {"total_rows": 2, "historical_rows": 1, "replay_rows": 1}
    os.utime(f"{csv}/a.csv")  # a newer time is not a new file
    _csv(f"{csv}/later/b.csv", [_row(3, 1)], ["speed", "miles", *NAMES[:2], *NAMES[3:]])
    os.utime(f"{csv}/later/b.csv", (1, 1))  # nor is an old file too old
    assert INC.ingest_new(spark, csv, out, ck, HIST, REPLAY)["total_rows"] == 1
    want = [("historical", 1, 1), ("historical", 1, 3), ("replay", 3, 2)]
    assert _ids(spark, out) == want
    assert INC.ingest_new(spark, csv, out, ck, HIST, REPLAY)["total_rows"] == 0
    assert INC.ingest_new(spark, csv, out, f"{ck}2", HIST, REPLAY)["total_rows"] == 3  # a lost ledger
    assert _ids(spark, out) == want
    assert {os.path.basename(r.path) for r in INC.read_ledger(spark, out).collect()} == {"a.csv", "b.csv"}
    compact_raw(spark, f"{out}/split=historical", f"{tmp_dir}/sorted")
    assert sorted(spark.read.parquet(f"{tmp_dir}/sorted").columns) == sorted([*NAMES, "year", "month"])


def test_a_crash_between_files_loses_and_repeats_nothing(spark, tmp_dir, monkeypatch):
    csv, out, ck = f"{tmp_dir}/csv", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _csv(f"{csv}/a.csv", [_row(1, 1)])
    _csv(f"{csv}/b.csv", [_row(2, 1)], NAMES[::-1])
    write, calls = INC._Ingest.write, []

    def failing(self, raw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return write(self, raw)
    monkeypatch.setattr(INC._Ingest, "write", failing)
    with pytest.raises(Exception, match="lost"):
        INC.ingest_new(spark, csv, out, ck, HIST, REPLAY)
    assert len(_ids(spark, out)) == 1
    assert INC.ingest_new(spark, csv, out, ck, HIST, REPLAY)["total_rows"] == 2
    assert _ids(spark, out) == [("historical", 1, 1), ("historical", 1, 2)]


def test_a_known_name_in_another_folder(spark, tmp_dir):
    csv, out, ck = f"{tmp_dir}/csv", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _csv(f"{csv}/1/a.csv", [_row(1, 1)])
    INC.ingest_new(spark, csv, out, ck, HIST, REPLAY, by_name=True)
    _csv(f"{csv}/2/a.csv", [_row(1, 1)])
    assert INC.ingest_new(spark, csv, out, ck, HIST, REPLAY, by_name=True)["total_rows"] == 0
    assert len(_ids(spark, out)) == 1


def _readings(spark, rows):
    return with_partitions(spark.createDataFrame([(x, dt.datetime.fromisoformat(t), s, r, c) for x, t, s, r, c in rows], READING))


def _segments(spark):
    return prepare_segments(spark.createDataFrame(
        [(1, "A", 1, "N", 36.0, -86.8, 36.1, -86.7), (2, "B", 3, "E", 36.0, -86.8, 36.1, -86.7)], SEGMENT))


def test_one_month_is_replaced_without_the_others(spark, tmp_dir):
    raw, sums, fixed = f"{tmp_dir}/raw", f"{tmp_dir}/sums", f"{tmp_dir}/fixed"
    _readings(spark, [_row(1, m, 10.0 * m) for m in (1, 2, 3)]).write.partitionBy("year", "month").parquet(raw)
    RU.update_sums(spark, raw, sums)
    before = {m: glob.glob(f"{sums}/year=2023/month={m}/*.parquet") for m in (1, 2, 3)}
    _readings(spark, [_row(1, 2, 90.0)]).write.partitionBy("year", "month").parquet(fixed)
    RU.update_sums(spark, fixed, sums, year=2023, months=[2])
    after = {m: glob.glob(f"{sums}/year=2023/month={m}/*.parquet") for m in (1, 2, 3)}
    assert before[1] == after[1] and before[3] == after[3] and before[2] != after[2]
    year = RU.results_from_sums(RU.read_sums(spark, sums), _segments(spark))
    assert [round(r.avg_speed, 6) for r in year["by_hour"].collect()] == [round((10 + 90 + 30) / 3, 6)]
    RU.update_sums(spark, fixed, sums, year=2023, months=[3])  # no readings any more
    assert sorted(r.month for r in RU.read_sums(spark, sums).collect()) == [1, 2]
    paths = RU.run_from_sums(spark, sums, _segments(spark), f"{tmp_dir}/out", year=2023, months=[2])
    assert [r.avg_speed for r in spark.read.parquet(paths["by_hour"]).collect()] == [90.0]
    assert [r.avg_speed for r in spark.read.parquet(paths["by_hour_yearly"]).collect()] == [50.0]


def test_a_year_from_some_months_is_refused(spark, tmp_dir):
    with pytest.raises(ValueError, match="replace the year"):
        run_historical(spark, tmp_dir, _segments(spark), tmp_dir, 2023, [2], H.YEARLY)
    with pytest.raises(ValueError, match="belong"):
        RU.update_sums(spark, tmp_dir, tmp_dir, months=[2])


def test_sketches_merge_to_longer_periods(spark):
    rows = [(k % 4000 if k % 7 else None, T0 + dt.timedelta(minutes=k % 2880), 10.0 if k % 3 else 49.0, 50.0, 30.0) for k in range(20_000)]
    cleaned = score(spark.createDataFrame(rows, READING))
    slots_ = SK.slot_sketches(cleaned)
    assert slots_.count() == 288
    for period in SK.PERIODS:
        got = {r.period_start: r for r in SK.merged(slots_, period).collect()}
        start = F.window("measurement_tstamp", "60 minutes", "10 minutes").start if period == "window" else F.date_trunc(period, "measurement_tstamp")
        exact = cleaned.groupBy(start.cast("timestamp_ntz").alias("p")).agg(
            F.countDistinct("xd_id").alias("n"), F.countDistinct(F.when(F.col("congestion_score") > 0.3, F.col("xd_id"))).alias("h"),
            F.count(F.lit(1)).alias("rows")).collect()
        assert len(got) == len(exact)
        for e in exact:
            r = got[e.p]
            assert abs(r.total_segments - e.n) <= 1 + 4 * SK.relative_error() * e.n
            assert abs(r.congested_segments - e.h) <= 1 + 4 * SK.relative_error() * e.h and r.reading_count == e.rows
    with pytest.raises(ValueError):
        SK.merged(slots_, "week")
    none = SK.merged(SK.slot_sketches(score(spark.createDataFrame([(None, T0, 1.0, 2.0, 30.0), (1, None, 1.0, 2.0, 30.0)], READING))), "day")
    assert [(r.total_segments, r.pct_congested, r.reading_count) for r in none.collect()] == [(0, None, 1)]


def _msg(xd, ts, speed=30.0):
    return json.dumps({"xd_id": xd, "measurement_tstamp": ts.isoformat(), "speed": speed, "reference_speed": 50.0, "confidence_score": 30.0})


def _files(root, files):
    os.makedirs(root)
    for k, lines in enumerate(files):
        path = os.path.join(root, f"{k:03}.json")
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + k,) * 2)


def _windows(df):
    return sorted((r.xd_id or -1, r.window_start, r.reading_count, r.avg_speed) for r in df.collect())


def test_chained_windows_equal_the_single_aggregation(spark, tmp_dir):
    """Over many micro-batches, with a late and a NULL reading."""
    files = [[_msg(1, T0 + dt.timedelta(minutes=7 * k), k), _msg(None, T0 + dt.timedelta(minutes=7 * k), 2 * k),
              *([_msg(2, T0, 5.0)] if k in (1, 20) else [])] for k in range(26)]
    _files(f"{tmp_dir}/in", files)
    out = {}
    for name, frame in (("one", lambda c: live.W.by_segment(c, ts="event_time")), ("chained", slots.by_segment)):
        cleaned = live.cleaned_stream(live.file_stream(spark, f"{tmp_dir}/in", 1))
        live.start_append(frame(cleaned), f"{tmp_dir}/{name}", f"{tmp_dir}/ck-{name}", available_now=True).awaitTermination()
        out[name] = _windows(live.read_appended(spark, f"{tmp_dir}/{name}"))
    assert out["one"] == out["chained"] and len(out["one"]) > 30
    with pytest.raises(ValueError):
        slots.by_segment(spark.createDataFrame([], READING), "25 minutes", "10 minutes")


def test_repeats_count_once(spark, tmp_dir):
    """A repeat in the same batch and in a later one; different readings without an id stay."""
    files = [[_msg(1, T0), _msg(1, T0), _msg(None, T0, 1.0), _msg(None, T0, 2.0), _msg(None, T0, 2.0)],
             [_msg(1, T0), _msg(2, T0)], [_msg(1, T0 + dt.timedelta(hours=3))], [_msg(1, T0 + dt.timedelta(hours=6))]]
    _files(f"{tmp_dir}/in", files)
    cleaned = MS.without_repeats(live.cleaned_stream(live.file_stream(spark, f"{tmp_dir}/in", 1)))
    live.start_append(slots.by_segment(cleaned), f"{tmp_dir}/out", f"{tmp_dir}/ck", available_now=True).awaitTermination()
    got = {(r[0], r[2]) for r in _windows(live.read_appended(spark, f"{tmp_dir}/out")) if r[1] == T0}
    assert got == {(1, 1), (2, 1), (-1, 2)}


def test_malformed_messages_are_kept_apart(spark, tmp_dir):
    good = [_msg(1, T0), json.dumps({"xd_id": 2}), '{"xd_id": 3, "speed": NaN}', json.dumps({"xd_id": None, "more": [1]})]
    bad = {"not json": "json", '{"xd_id": "x"}': "json", '{"xd_id": 1, "measurement_tstamp": "zz"}': "time", "  ": "empty", "[1": "json"}
    frame = spark.createDataFrame([(v,) for v in [*good, *bad, None]], "value string")
    got = {r.value: r.reason for r in MS.malformed(frame).collect()}
    assert got == {**bad, None: "empty"}
    binary = MS.malformed(frame.select(F.col("value").cast("binary").alias("value")))
    assert {r.value: r.reason for r in binary.collect()} == got
    _files(f"{tmp_dir}/in", [good, list(bad)])
    for _ in range(2):  # the second start finds nothing new
        MS.start_malformed(live.file_stream(spark, f"{tmp_dir}/in", 1), f"{tmp_dir}/bad", f"{tmp_dir}/ck", available_now=True).awaitTermination()
    assert {r.value: r.reason for r in spark.read.parquet(f"{tmp_dir}/bad").collect()} == bad


def test_aggregates_by_segment_need_no_exchange(spark, tmp_dir, capsys):
    rows = [_row(k % 50, 1 + k % 3, float(k)) for k in range(600)]
    readings = _readings(spark, rows)
    LY.write_bucketed(readings, "bucketed_test", f"{tmp_dir}/b", buckets=4)
    means = H.segment_means(score(LY.read_bucketed(spark, "bucketed_test")), _segments(spark))
    means.explain()
    plan = capsys.readouterr().out
    assert "Exchange hashpartitioning" not in plan and "BucketedScan" in plan or "Bucketed: true" in plan
    want = sorted(map(tuple, H.segment_means(score(readings), _segments(spark)).collect()))
    assert sorted(map(tuple, means.collect())) == want
    spark.sql("DROP TABLE bucketed_test")
    again = LY.register_bucketed(spark, "bucketed_again", f"{tmp_dir}/b", buckets=4)
    assert again.count() == 600 and LY.read_bucketed(spark, "bucketed_again", 2023, [2]).count() == 200
    means = score(again).groupBy("xd_id").agg(F.avg("speed"))
    means.explain()
    assert "Exchange" not in capsys.readouterr().out
    spark.sql("DROP TABLE bucketed_again")
