import datetime as dt

from roadpulse.functions import display as D
from roadpulse.functions.timefns import floor_minutes, iso_format
from roadpulse.operators import prepare as PP
from roadpulse.operators import replay as RY
from roadpulse.operators import report as RP
from roadpulse.schemas import READING


def test_colours_and_weights(spark):
    df = spark.createDataFrame([(None, None), (0.1499, 9), (0.15, 1), (0.3, 5)], "s DOUBLE, frc INT")
    got = df.select(D.congestion_color("s").alias("c"), D.frc_weight("frc").alias("w")).collect()
    assert [r.c for r in got] == ["#cccccc", "#16a34a", "#facc15", "#dc2626"]
    assert [r.w for r in got] == [4, 4, 6, 3]


def test_display_name_and_offsets(spark):
    df = spark.createDataFrame([(1, "  Main St \t", "N"), (2, "   ", "?"), (3, None, None)],
                               "xd_id LONG, road_name STRING, bearing STRING")
    dlat, dlon = D.bearing_offsets("bearing")
    got = df.select(D.display_name().alias("n"), dlat.alias("a"), dlon.alias("o")).collect()
    assert [r.n for r in got] == ["Main St", "Segment 2", "Segment 3"]
    assert (got[0].a, got[0].o) == (-0.00012, 0.0) and (got[1].a, got[1].o) == (0.0, 0.0)


def test_format_2f_matches_python(spark):
    vals = [0.125, 0.375, 1.005, -0.004, 2.675, 0.3, 12.345, -1.555, 1e-9]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x DOUBLE")
    got = [r.s for r in df.select(D.format_2f("x").alias("s")).collect()]
    assert got == [f"{v:.2f}" for v in vals] + ["nan"]


def test_iso_format_and_floor(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1, 0, 17, 3),), (dt.datetime(2023, 1, 1, 0, 17, 3, 25),)],
                               "ts TIMESTAMP_NTZ")
    got = df.select(iso_format("ts").alias("s"), floor_minutes("ts", 10).alias("f")).collect()
    assert [r.s for r in got] == ["2023-01-01T00:17:03", "2023-01-01T00:17:03.000025"]
    assert got[0].f == dt.datetime(2023, 1, 1, 0, 10)


def test_slices_start_and_inclusive_end(spark):
    t = dt.datetime
    rows = [(1, t(2023, 1, 1, 0, 4), 1.0, 1.0, 1.0), (1, t(2023, 1, 1, 0, 5), 1.0, 1.0, 1.0),
            (1, t(2023, 1, 1, 0, 12), 1.0, 1.0, 1.0), (1, t(2023, 1, 1, 1, 0), 1.0, 1.0, 1.0),
            (1, t(2023, 1, 1, 1, 0, 1), 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, READING)
    got = RY.slices(df, "2023-01-01 00:05:00", "2023-01-01 01:00:00", 10).orderBy("measurement_tstamp").collect()
    assert [r.measurement_tstamp for r in got] == [t(2023, 1, 1, 0, 5), t(2023, 1, 1, 0, 12), t(2023, 1, 1, 1, 0)]
    assert (got[0].slice_start, got[0].slice_end) == (t(2023, 1, 1, 0, 5), t(2023, 1, 1, 0, 10))
    assert got[1].slice_start == t(2023, 1, 1, 0, 10)


def test_slice_counts_skip_empty_slices(spark):
    t = dt.datetime
    rows = [(1, t(2023, 1, 1, 0, 5), 1.0, 1.0, 1.0), (2, t(2023, 1, 1, 0, 7), 1.0, 1.0, 1.0),
            (1, t(2023, 1, 1, 0, 12), 1.0, 1.0, 1.0), (1, t(2023, 1, 1, 0, 48), 1.0, 1.0, 1.0)]
    got = RY.slice_counts(spark.createDataFrame(rows, READING), "2023-01-01 00:05:00", None, 10).collect()
    assert sorted((r.slice_start, r.slice_end, r.rows) for r in got) == [
        (t(2023, 1, 1, 0, 5), t(2023, 1, 1, 0, 10), 2), (t(2023, 1, 1, 0, 10), t(2023, 1, 1, 0, 20), 1),
        (t(2023, 1, 1, 0, 40), t(2023, 1, 1, 0, 50), 1)]


def test_pivot_keeps_every_key(spark):
    rows = [(2024, 1, "N", 10.0), (2024, 1, "?", 20.0), (2024, 1, None, 30.0), (2024, 2, "NE", 40.0)]
    res = spark.createDataFrame(rows, "year int, month int, direction string, avg_speed double")
    found = {r.month: r.asDict() for r in RP.month_pivot(res, "direction").collect()}
    assert found[1]["N"] == 10.0 and found[1]["?"] == 20.0 and found[2]["NE"] == 40.0
    listed = {r.month: r.asDict() for r in RP.month_pivot(res, "direction", values=["N"]).collect()}
    assert listed[1]["N"] == 10.0 and listed[1]["other"] == 25.0 and listed[2]["N"] is None and listed[2]["other"] == 40.0


def test_slices_are_published_in_order(spark, tmp_path):
    from roadpulse.streaming.replay_query import replay
    t = dt.datetime
    rows = [(k, t(2023, 1, 1, h, m), 1.0, 1.0, 1.0) for k, h, m in ((1, 2, 5), (2, 0, 1), (3, 1, 59), (4, 0, 9), (5, 2, 9))]
    seen = []
    n = replay(spark, spark.createDataFrame(rows, READING), lambda part, _: seen.append(
        sorted(r.xd_id for r in part.collect())), str(tmp_path / "ck"), "2023-01-01", "2023-01-01 02:08:00", 10)
    assert n == 13 and [x for x in seen if x] == [[2, 4], [3], [1]]


def test_slice_files_are_few_and_in_time_order(spark, tmp_path):
    import glob
    import os
    t = dt.datetime(2023, 1, 1)
    rows = [(k, t + dt.timedelta(minutes=7 * k), 1.0, 1.0, 1.0) for k in range(400)]
    path = str(tmp_path / "slices")
    RY.write_message_slices(spark.createDataFrame(rows, READING).repartition(8), path, t, None, 60)
    files = sorted(glob.glob(path + "/slice_start=*/*.txt"))
    folders = {os.path.dirname(f) for f in files}
    assert len(folders) == 47 and len(files) <= len(folders) + 8
    times = [os.stat(f).st_mtime for f in files]
    assert times == sorted(times)


def test_date_split_end_bound_is_midnight_only(spark):
    t = dt.datetime
    rows = [(1, t(2023, 1, 5, 0, 0), 1.0, 1.0, 1.0), (1, t(2023, 1, 5, 0, 10), 1.0, 1.0, 1.0),
            (1, t(2023, 1, 6, 0, 0), 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, READING)
    parts = PP.date_split(df, ("2023-01-01", "2023-01-05"), ("2023-01-06", "2023-01-07"))
    assert [r.measurement_tstamp for r in parts["historical"].collect()] == [t(2023, 1, 5)]
    assert parts["replay"].count() == 1
    c = PP.ingest_counts(df, ("2023-01-01", "2023-01-05"), ("2023-01-06", "2023-01-07")).first()
    assert (c.total_rows, c.historical_rows, c.replay_rows) == (3, 1, 1)


def test_month_over_month_uses_previous_pivot_row(spark):
    from roadpulse.operators.report import month_over_month
    res = spark.createDataFrame([(2023, 1, "N", 10.0), (2023, 1, "S", 20.0), (2023, 2, "S", 25.0),
                                 (2023, 3, "N", 13.0), (2023, 3, "S", 24.0)],
                                "year INT, month INT, direction STRING, avg_speed DOUBLE")
    got = {(r.month, r.direction): r.mom_change for r in month_over_month(res, "direction").collect()}
    assert got[(1, "N")] is None and got[(2, "S")] == 5.0
    assert got[(3, "N")] is None  # N has no value in February, the previous pivot row
    assert got[(3, "S")] == -1.0


def test_month_over_month_starts_each_year_fresh(spark):
    from roadpulse.operators.report import month_over_month
    res = spark.createDataFrame([(2022, 12, "N", 10.0), (2023, 1, "N", 12.0), (2023, 2, "N", 15.0)],
                                "year INT, month INT, direction STRING, avg_speed DOUBLE")
    got = {(r.year, r.month): r.mom_change for r in month_over_month(res, "direction").collect()}
    assert got == {(2022, 12): None, (2023, 1): None, (2023, 2): 3.0}


def test_write_message_slices_round_trip(spark, tmp_dir):
    import os
    from roadpulse.operators.transform import parse
    t = dt.datetime
    rows = [(1, t(2023, 1, 1, 0, 12), 31.0, 50.0, 30.0), (2, t(2023, 1, 1, 0, 3), 10.0, 50.0, 30.0),
            (1, t(2023, 1, 1, 0, 25, 0, 5), 20.0, 50.0, 30.0)]
    df = spark.createDataFrame(rows, READING)
    RY.write_message_slices(df, f"{tmp_dir}/slices", "2023-01-01 00:05:00", "2023-01-01 01:00:00")
    folders = sorted(d for d in os.listdir(f"{tmp_dir}/slices") if d.startswith("slice_start="))
    assert len(folders) == 2
    back = parse(spark.read.text(f"{tmp_dir}/slices").select("value")).collect()
    assert sorted((r.xd_id, r.event_time) for r in back) == [(1, t(2023, 1, 1, 0, 12)),
                                                             (1, t(2023, 1, 1, 0, 25, 0, 5))]
