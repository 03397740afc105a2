"""What a larger input must not change: files per slice, broadcasts per batch, writers per file."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from roadpulse.operators import replay as RY
from roadpulse.operators import transform as TR
from roadpulse.schemas import READING, SEGMENT
from roadpulse.streaming import snapshot_sink as SS


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_slice_files_follow_the_rows_not_the_shuffle_partitions(spark, tmp_path):
    t = dt.datetime(2023, 1, 1)
    rows = [(k % 40, t + dt.timedelta(seconds=30 * k), 1.0, 1.0, 1.0) for k in range(400)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for per_file, most in ((500, 4), (100, 4 + 4)):
            path = str(tmp_path / f"slices-{per_file}")
            RY.write_message_slices(spark.createDataFrame(rows, READING), path, t, None, 60, rows_per_file=per_file)
            files = glob.glob(path + "/slice_start=*/*.txt")
            assert len(files) <= most, len(files)
            assert spark.read.text(path).count() == 400
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_join_of_every_batch_is_broadcast_only_when_small(spark, monkeypatch):
    segments = spark.createDataFrame([(k, f"r{k}", 1, "N", 1.0, 1.0, 1.0, 1.0) for k in range(50)], SEGMENT)
    readings = spark.createDataFrame([(1, 2.0), (None, 3.0), (70, 4.0)], "xd_id long, speed double")
    for limit, broadcast in ((1 << 20, True), (10, False)):
        monkeypatch.setattr(TR, "STREAM_MAX_BROADCAST_BYTES", limit, raising=False)
        joined = TR.enrich(readings, segments, "left", attrs=["frc"], repeated=True)
        assert ("strategy=broadcast" in _plan(joined)) == broadcast
        assert sorted((r.speed, r.frc) for r in joined.collect()) == [(2.0, 1), (3.0, None), (4.0, None)]


def test_the_snapshot_keeps_a_row_a_segment_of_a_batch(spark, tmp_path, monkeypatch):
    kept = []
    real = SS.latest

    def latest(windows, previous=None):
        out = real(windows, previous=previous)
        if previous is None:
            kept.append(out)
        return out
    monkeypatch.setattr(SS, "latest", latest)
    t = F.timestamp_seconds(F.col("id") * 600)
    batch = spark.range(600).select(F.pmod("id", F.lit(3)).alias("xd_id"), F.col("id").cast("double").alias("avg_speed"),
                                    t.alias("window_start"))
    persisted = []
    frame = type(batch)
    monkeypatch.setattr(frame, "persist", lambda self, *a, _real=frame.persist: (persisted.append(self), _real(self, *a))[1])
    SS.SnapshotWriter(str(tmp_path / "snap"), run="r")(batch, 0)
    assert len(persisted) == 1 and persisted[0] is kept[0]
    rows = spark.read.parquet(str(tmp_path / "snap/data/slot=0")).collect()
    assert sorted((r.xd_id, r.avg_speed) for r in rows) == [(0, 597.0), (1, 598.0), (2, 599.0)]


def _lineitem(spark, path, files=3, rows=300):
    n = F.col("id")
    spark.range(0, rows, 1, files).select(
        (n % 7).alias("l_suppkey"), n.alias("l_orderkey"), (n % 50 + 1).cast("double").alias("l_quantity"),
        (n + 100).cast("double").alias("l_extendedprice"), F.lit(0.1).alias("l_discount"),
        F.timestamp_add("DAY", (n % 1200).cast("int"), F.lit("1996-01-01").cast("timestamp_ntz")).alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")


def test_arriving_files_are_written_by_every_input_task(spark, tmp_path):
    from roadpulse.plans import catalog_increments as CI
    from roadpulse.plans import incremental as INC
    _lineitem(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for every file
    try:
        out, counts = CI._arrived(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    taken = INC.read_ledger(spark, out).select(F.regexp_extract("path", "/(\\d)/[^/]*$", 1).alias("folder"), "path").distinct()
    assert {r.folder: r["count"] for r in taken.groupBy("folder").count().collect()} == {"0": 3, "1": 3, "2": 3}
    assert [c["total_rows"] for c in counts][2:] == [0, 300] and sum(c["total_rows"] for c in counts[:2]) == 300
    assert spark.read.parquet(out).count() == 300


def test_historical_results_shuffle_no_row_per_reading(spark):
    from roadpulse.operators import historical as H
    from roadpulse.plans import batch as B
    t = dt.datetime(2023, 1, 1)
    readings = spark.createDataFrame([(k % 3, t + dt.timedelta(hours=k), 10.0 + k % 5, 20.0, 30.0) for k in range(200)]
                                     + [(9, t, 1.0, 1.0, 1.0), (None, t, 1.0, 1.0, 1.0)], READING)
    segments = spark.createDataFrame([(k, f"r{k}", k + 1, "N", 1.0, 1.0, 1.0, 1.0) for k in range(3)], SEGMENT)
    scored = TR.score(readings)
    cube, seg = B.historical_aggregates(scored, segments)
    for part in (cube, seg):  # no aggregate over hour, weekday and segment
        assert not any("xd_id" in line and "hour" in line for line in _plan(part).splitlines() if line.lstrip("+-: !").startswith("Aggregate"))
    sums = H.segment_hour_sums(scored)
    for got, want in ((cube, H.cube_from_sums(sums, segments)),
                      (seg, H.fold(sums.where("xd_id < 3"), ["year", "month", "xd_id"]))):
        def rows(df):
            return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(want.columns)).collect())
        assert rows(got) == rows(want)


def test_compaction_and_ingest_size_their_sorts_by_rows(spark, tmp_path, monkeypatch):
    from roadpulse.plans import prepare as PR
    monkeypatch.setattr(PR, "SORTED_ROWS", 50, raising=False)
    t = dt.datetime(2023, 1, 5)
    rows = [(k % 9, t + dt.timedelta(minutes=k), 1.0, 2.0, 3.0, 2023, 1) for k in range(400)]
    spark.createDataFrame(rows, "xd_id long, measurement_tstamp timestamp_ntz, speed double, reference_speed double, "
                          "confidence_score double, year int, month int").write.partitionBy("year", "month").parquet(str(tmp_path / "raw"))
    PR.compact_raw(spark, str(tmp_path / "raw"), str(tmp_path / "sorted"))
    files = glob.glob(str(tmp_path / "sorted/year=2023/month=1/*.parquet"))
    assert len(files) >= 6 and spark.read.parquet(str(tmp_path / "sorted")).count() == 400


def test_append_queries_keep_their_state_in_bounded_rocksdb(spark, tmp_path):
    from roadpulse.operators import windows as W
    from roadpulse.streaming import live as LV
    keys = [LV.STATE_PROVIDER_KEY, *(f"spark.sql.streaming.stateStore.rocksdb.{k}" for k in
                                     ("trackTotalNumberOfRows", "boundedMemoryUsage", "maxMemoryUsageMB"))]
    for k in keys:
        spark.conf.unset(k)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("".join(
        '{"xd_id": 1, "measurement_tstamp": "2023-01-01T%02d:00:00", "speed": 30.0, "reference_speed": 50.0, "confidence_score": 30.0}\n' % h
        for h in range(6)))
    frame = W.by_segment(LV.cleaned_stream(LV.file_stream(spark, str(tmp_path / "in"))), ts="event_time")
    LV.start_append(frame, str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True).awaitTermination()
    assert [spark.conf.get(k) for k in keys] == [LV.ROCKSDB_PROVIDER, "false", "true", "1000"]
    assert LV.read_appended(spark, str(tmp_path / "out")).count() == 29


def test_latest_state_takes_rows(spark):
    from pyspark.sql import Row
    from roadpulse.streaming.latest import LatestState

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            self.held = v

        def clear(self):
            self.held = None
    state = LatestState(60, 10, None)
    state.latest = Value()
    slot = 1_704_067_200_000_000  # 2024-01-01
    rows = [Row(slot=slot, speed=10.0, congestion_score=0.5), Row(slot=slot - 600_000_000, speed=99.0, congestion_score=0.1),
            Row(slot=slot, speed=20.0, congestion_score=None)]
    out, = state.handleInputRows(("",), iter(rows), None)
    assert (out.xd_id, out.avg_speed, out.avg_congestion, out.reading_count, out.expired) == (None, 15.0, 0.5, 2, False)
    assert out.window_start == dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) and out.window_end - out.window_start == dt.timedelta(hours=1)
    assert list(state.handleInputRows(("",), iter(rows[1:2]), None)) == []
