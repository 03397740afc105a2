import datetime as dt
import random

from pyspark.sql import functions as F

from roadpulse.operators import historical as H
from roadpulse.operators import snapshot as S
from roadpulse.operators import windows as W
from roadpulse.operators.transform import clean, score
from roadpulse.schemas import READING


def test_window_membership_midnight(spark):
    df = clean(spark.createDataFrame([(1, dt.datetime(2023, 1, 1), 30.0, 50.0, 30.0)], READING))
    starts = sorted(r.window_start for r in W.by_segment(df).collect())
    assert len(starts) == 6
    assert starts[0] == dt.datetime(2022, 12, 31, 23, 10) and starts[-1] == dt.datetime(2023, 1, 1)


def _random_readings(spark, n=3000, segs=40, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2023, 1, 1)
    rows = []
    for _ in range(n):
        ts = t0 + dt.timedelta(seconds=rnd.randrange(0, 3 * 24 * 3600))
        rows.append((rnd.randrange(segs), ts, rnd.uniform(0, 80), rnd.choice([0.0, 30.0, 50.0, 70.0]),
                     rnd.uniform(0, 100)))
    return clean(spark.createDataFrame(rows, READING))


def _rows(df, cols):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                   for r in df.select(*cols).collect()), key=repr)


def test_each_reading_in_six_windows(spark):
    df = _random_readings(spark)
    total = W.by_segment(df).agg(F.sum("reading_count")).first()[0]
    assert total == 6 * df.count()


def test_two_stage_road_type_equals_plain(spark):
    df = _random_readings(spark).withColumn("frc", (F.col("xd_id") % 5 + 1).cast("int"))
    cols = ["frc", "window_start", "window_end", "avg_speed", "avg_congestion", "reading_count", "day"]
    assert _rows(W.by_road_type(df), cols) == _rows(W.by_road_type_two_stage(df), cols)


def test_network_two_stage_equals_exact(spark):
    for seed, segs in [(1, 40), (2, 3), (3, 200)]:
        df = _random_readings(spark, n=2000, segs=segs, seed=seed)
        cols = ["window_start", "total_segments", "congested_segments", "pct_congested"]
        exact = W.network(df, exact=True)
        assert _rows(exact, cols) == _rows(W.network_exact_two_stage(df), cols)
        bad = exact.where(F.col("congested_segments") > F.col("total_segments")).count()
        assert bad == 0


def test_network_approx_close_to_exact(spark):
    df = _random_readings(spark, n=6000, segs=400)
    e = {r.window_start: r.total_segments for r in W.network(df, exact=True).collect()}
    a = {r.window_start: r.total_segments for r in W.network(df, exact=False).collect()}
    assert e.keys() == a.keys()
    assert all(abs(a[k] - e[k]) <= max(2, 0.15 * e[k]) for k in e)


def test_latest_matches_row_number(spark):
    from pyspark.sql import Window
    wins = W.by_segment(_random_readings(spark))
    w = Window.partitionBy("xd_id").orderBy(F.col("window_start").desc())
    ref = wins.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    cols = wins.columns
    assert _rows(S.latest(wins), cols) == _rows(ref, cols)


def test_latest_carry_forward(spark):
    wins = W.by_segment(_random_readings(spark))
    prev = S.latest(wins)
    newer = wins.where(F.col("xd_id") < 5).withColumn("window_start", F.col("window_start") + F.expr("INTERVAL 7 DAYS"))
    out = S.latest(newer, previous=prev)
    assert out.count() == prev.count()
    assert out.where(F.col("window_start") > F.lit(dt.datetime(2023, 1, 6))).count() == newer.select("xd_id").distinct().count()


def test_latest_carry_forward_same_window_new_row_wins(spark):
    schema = "xd_id LONG, window_start TIMESTAMP_NTZ, avg_speed DOUBLE, road_name STRING"
    t = dt.datetime(2023, 1, 1, 0, 10)
    prev = spark.createDataFrame([(1, t, 10.0, "old"), (2, t, 20.0, "kept")], schema)
    batch = spark.createDataFrame([(1, t, 11.0, "new"), (1, t - dt.timedelta(minutes=10), 9.0, "older")],
                                  schema)
    out = {r.xd_id: (r.avg_speed, r.road_name) for r in S.latest(batch, previous=prev).collect()}
    assert out == {1: (11.0, "new"), 2: (20.0, "kept")}


def test_latest_mixed_widths_keeps_rows_whole(spark):
    schema = "xd_id LONG, window_start TIMESTAMP_NTZ, avg_speed DOUBLE, road_name STRING, frc INT"
    t = dt.datetime(2023, 1, 1)
    rows = [(1, t + dt.timedelta(minutes=10 * i), float(i), f"n{i}", i) for i in range(5)]
    rows += [(2, t, None, None, None), (2, t - dt.timedelta(minutes=10), 3.0, "x", 3)]
    out = {r.xd_id: (r.window_start, r.avg_speed, r.road_name, r.frc)
           for r in S.latest(spark.createDataFrame(rows, schema)).collect()}
    assert out == {1: (t + dt.timedelta(minutes=40), 4.0, "n4", 4), 2: (t, None, None, None)}


def test_top_k_tie_lower_id_wins_and_size(spark):
    rows = [(i, dt.datetime(2023, 1, 5), 10.0, 50.0, 30.0) for i in range(30, 0, -1)]  # all equal scores
    means = H.segment_means(score(spark.createDataFrame(rows, READING)),
                            spark.createDataFrame([(i, f"r{i}", 1, "N", 0.0, 0.0, 0.0, 0.0) for i in range(1, 31)],
                                                  "xd LONG, road_name STRING, frc INT, bearing STRING, "
                                                  "start_lat DOUBLE, start_long DOUBLE, end_lat DOUBLE, end_long DOUBLE"))
    top = H.top_segments(means, 20, H.MONTHLY).collect()
    assert sorted(r.xd_id for r in top) == list(range(1, 21))


def test_top_k_plan_limits_before_shuffle(spark, capsys):
    df = _random_readings(spark)
    means = df.groupBy(F.year("measurement_tstamp").alias("year"), F.month("measurement_tstamp").alias("month"),
                       "xd_id").agg(F.avg("congestion_score").alias("avg_congestion"))
    H.top_segments(means, 20, H.MONTHLY).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_cube_and_grouping_sets_equal_plain(spark):
    df = _random_readings(spark).withColumn("frc", (F.col("xd_id") % 5 + 1).cast("int")) \
        .withColumn("bearing", F.when(F.col("xd_id") % 2 == 0, "N").otherwise(F.lit(None)))
    cols = ["kind", "year", "month", "hour", "day_of_week", "road_type", "direction", "avg_speed",
            "avg_congestion_score"]
    plain = _rows(H.all_means_plain(df), cols)
    assert plain == _rows(H.all_means_long(df), cols)
    assert plain == _rows(H.grouping_sets_means(df), cols)


def _hot_readings(spark, n=3000, seed=11):
    """A third of all readings on one segment (0), several per slot."""
    rnd = random.Random(seed)
    t0 = dt.datetime(2023, 1, 1)
    rows = []
    for i in range(n):
        seg = 0 if i % 3 == 0 else rnd.randrange(1, 60)
        ts = t0 + dt.timedelta(seconds=rnd.randrange(0, 2 * 24 * 3600))
        rows.append((seg, ts, rnd.uniform(0, 80), 50.0, rnd.uniform(20, 100)))
    return clean(spark.createDataFrame(rows, READING))


def test_hot_segment_exact_network_and_segment_windows(spark):
    df = _hot_readings(spark)
    cols = ["window_start", "total_segments", "congested_segments", "pct_congested"]
    assert _rows(W.network(df, exact=True), cols) == _rows(W.network_exact_two_stage(df), cols)
    hot = W.by_segment(df).where(F.col("xd_id") == 0).agg(F.sum("reading_count")).first()[0]
    assert hot == 6 * df.where(F.col("xd_id") == 0).count()


def test_latest_plan_has_no_sort_aggregate(spark, capsys):
    S.latest(W.by_segment(_random_readings(spark))).explain()
    plan = capsys.readouterr().out
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_month_over_month_plan_has_no_single_partition(spark, capsys):
    from roadpulse.operators.report import month_over_month
    res = spark.createDataFrame([(2023, m, d, float(m)) for m in range(1, 13) for d in "NSEW"],
                                "year INT, month INT, direction STRING, avg_speed DOUBLE")
    month_over_month(res, "direction").explain()
    assert "SinglePartition" not in capsys.readouterr().out


def test_bucketed_segment_windows_equal_plain(spark):
    cols = ["xd_id", "window_start", "window_end", "avg_speed", "avg_congestion", "reading_count",
            "year", "month", "day"]
    for df in (_random_readings(spark), _hot_readings(spark)):
        assert _rows(W.by_segment(df), cols) == _rows(W.by_segment_bucketed(df), cols)
    # buckets shorter than a day (readings near every bucket start are sent twice)
    df = _random_readings(spark, n=1500, seed=5)
    assert _rows(W.by_segment(df), cols) == _rows(W.by_segment_bucketed(df, bucket_minutes=60), cols)


def test_bucketed_segment_windows_shuffle_once(spark, capsys):
    W.by_segment_bucketed(_random_readings(spark)).explain()
    # one exchange for the slot sums, one that places them; the window copies
    # are made after both
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 2 and plan.index("Generate explode") < plan.index("Exchange")


def test_latest_window_equals_latest_of_all_windows(spark):
    cols = ["xd_id", "window_start", "window_end", "avg_speed", "avg_congestion", "reading_count",
            "year", "month", "day"]
    for df in (_random_readings(spark), _hot_readings(spark)):
        assert _rows(S.latest(W.by_segment(df)), cols) == _rows(W.latest_window(df), cols)
    df = _random_readings(spark, n=800, seed=9)
    assert (_rows(S.latest(W.by_segment(df, "30 minutes", "5 minutes")), cols)
            == _rows(W.latest_window(df, "30 minutes", "5 minutes"), cols))


def test_exact_network_equals_count_distinct_with_nulls(spark):
    df = _random_readings(spark, n=1500, segs=30, seed=4)
    extra = spark.createDataFrame(
        [(None, dt.datetime(2023, 1, 1, 5, 3), 10.0, 0.9), (3, dt.datetime(2023, 1, 1, 5, 4), 10.0, None),
         (None, dt.datetime(2023, 1, 9, 0, 0), 1.0, 0.9)],
        "xd_id LONG, measurement_tstamp TIMESTAMP_NTZ, speed DOUBLE, congestion_score DOUBLE")
    df = df.select("xd_id", "measurement_tstamp", "speed", "congestion_score").unionByName(extra)
    w = F.window("measurement_tstamp", "60 minutes", "10 minutes")
    ref = df.groupBy(w.start.alias("window_start")).agg(
        F.count_distinct("xd_id").alias("total_segments"),
        F.count_distinct(F.when(F.col("congestion_score") > 0.3, F.col("xd_id"))).alias("congested_segments"))
    cols = ["window_start", "total_segments", "congested_segments"]
    assert _rows(W.network(df, exact=True), cols) == _rows(ref, cols)


def test_unknown_segments_count_nowhere_but_keep_their_windows(spark):
    t = dt.datetime
    rows = [(1, t(2023, 1, 1, 0, 5), 10.0, 50.0, 30.0), (2, t(2023, 1, 1, 0, 5), 50.0, 50.0, 30.0),
            (None, t(2023, 1, 1, 0, 5), 10.0, 50.0, 30.0), (None, t(2023, 1, 1, 5, 5), 10.0, 50.0, 30.0)]
    cleaned = clean(spark.createDataFrame(rows, READING))
    forms = [W.network(cleaned, exact=True), W.network(cleaned, exact=True, method="slots")]
    a, b = ({r.window_start: (r.total_segments, r.congested_segments, r.pct_congested) for r in f.collect()} for f in forms)
    assert a == b and len(a) == 12 and set(a.values()) == {(2, 1, 50.0), (0, 0, None)}


def test_a_hot_segment_is_one_row_per_slot_before_the_exchange(spark):
    t = dt.datetime(2023, 1, 1)
    rows = [(7, t + dt.timedelta(seconds=k), 30.0, 50.0, 30.0) for k in range(3000)]
    cleaned = clean(spark.createDataFrame(rows, READING).repartition(4))
    key = lambda r: (r.xd_id, r.window_start, r.reading_count, round(r.avg_speed, 9))
    assert sorted(map(key, W.by_segment_bucketed(cleaned).collect())) == sorted(map(key, W.by_segment(cleaned).collect()))
