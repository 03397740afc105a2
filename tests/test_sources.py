import datetime as dt

from pyspark.sql import functions as F

from roadpulse.schemas import READING
from roadpulse.sources import readers
from roadpulse.sources.readers import read_historical, read_readings, read_readings_csv, read_segments_csv
from roadpulse.sources.writers import to_json_records, write_partitioned


def test_csv_by_header_name(spark, tmp_dir):
    p = f"{tmp_dir}/xd.csv"
    with open(p, "w") as f:
        f.write("miles,xd,road-name,frc,end_longitude,bearing,start_latitude,start_longitude,end_latitude\n")
        f.write("1.5,7,I-40,1,-86.7,E,36.0,-86.8,36.1\n")
        f.write("0.2,8,,9,-86.6,W,36.2,-86.9,36.3\n")
    rows = {r.xd: r for r in read_segments_csv(spark, p).collect()}
    assert rows[7].road_name == "I-40" and rows[7].frc == 1 and rows[7].bearing == "E"
    assert rows[7].start_lat == 36.0 and rows[7].end_long == -86.7
    assert rows[8].road_name is None and rows[8].frc == 9


def test_readings_csv_bad_values_become_null(spark, tmp_dir):
    p = f"{tmp_dir}/raw.csv"
    with open(p, "w") as f:
        f.write("speed,xd_id,county,measurement_tstamp,reference_speed,confidence_score\n")
        f.write("31.5,1,county_a,2023-01-01 00:10:00,50,30\n")
        f.write("x,2,county_a,zz,50,30\n")
    rows = sorted(read_readings_csv(spark, p).collect(), key=lambda r: r.xd_id)
    assert rows[0].speed == 31.5 and rows[0].measurement_tstamp == dt.datetime(2023, 1, 1, 0, 10)
    assert rows[1].speed is None and rows[1].measurement_tstamp is None


def test_partitioned_round_trip_and_pruning(spark, tmp_dir, capsys):
    from roadpulse.operators.prepare import with_partitions
    from roadpulse.schemas import READING
    df = spark.createDataFrame([(1, dt.datetime(2023, 1, 31, 23, 50), 30.0, 50.0, 30.0),
                                (1, dt.datetime(2023, 2, 1, 0, 0), 30.0, 50.0, 30.0),
                                (2, dt.datetime(2023, 3, 1, 0, 0), 30.0, 50.0, 30.0)], READING)
    root = f"{tmp_dir}/raw"
    write_partitioned(with_partitions(df), root)
    got = read_readings(spark, root, start="2023-02-01", end="2023-03-01", end_exclusive=True)
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters" in plan
    assert [(r.year, r.month) for r in got.collect()] == [(2023, 2)]
    assert read_readings(spark, root, year=2023, months=[1, 3]).count() == 2


def test_read_historical_validation(spark, tmp_dir):
    import pytest
    with pytest.raises(ValueError):
        read_historical(spark, tmp_dir, "by_minute", 2023)
    with pytest.raises(ValueError):
        read_historical(spark, tmp_dir, "by_hour", 2023, month=13)


def test_read_historical_ordered_and_month(spark, tmp_dir):
    top = spark.createDataFrame(
        [(2023, 2, 5, "a", "N", 1, 0.2, 40.0), (2023, 2, 3, "b", "S", 2, 0.5, 30.0),
         (2023, 2, 4, "c", "E", 3, 0.5, 35.0), (2023, 3, 9, "d", "W", 4, None, 50.0),
         (2023, 3, 8, "e", "N", 5, 0.1, 20.0), (2022, 3, 1, "f", "N", 1, 0.9, 10.0)],
        "year INT, month INT, xd_id LONG, road_name STRING, bearing STRING, frc INT, "
        "avg_congestion DOUBLE, avg_speed DOUBLE")
    write_partitioned(top, f"{tmp_dir}/hist/top_segments")
    rows = read_historical(spark, f"{tmp_dir}/hist", "top_segments", 2023, ordered=True).collect()
    # by month, then worst first (NULL last), ties by lower id
    assert [(r.month, r.xd_id) for r in rows] == [(2, 3), (2, 4), (2, 5), (3, 8), (3, 9)]
    march = read_historical(spark, f"{tmp_dir}/hist", "top_segments", 2023, month=3).collect()
    assert sorted(r.xd_id for r in march) == [8, 9]


def test_json_records_nan_inf_null(spark):
    df = spark.createDataFrame([(1, float("nan"), float("inf"), 2.5)], "id INT, a DOUBLE, b DOUBLE, c DOUBLE")
    assert to_json_records(df).first().json == '{"id":1,"a":null,"b":null,"c":2.5}'


def test_compact_sorted_row_groups_and_order(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from roadpulse.sources.writers import compact_sorted
    t0 = dt.datetime(2023, 1, 1)
    rows = [(i % 50, t0 + dt.timedelta(seconds=37 * ((i * 7919) % 20000)), float(i), 50.0, 30.0)
            for i in range(20000)]
    df = spark.createDataFrame(rows, READING).withColumn("year", F.lit(2023)).withColumn("month", F.lit(1))
    compact_sorted(df, f"{tmp_dir}/c", num_partitions=2, row_group_bytes=64 * 1024)
    files = glob.glob(f"{tmp_dir}/c/year=2023/month=1/*.parquet")
    assert files
    groups = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        groups += meta.num_row_groups
        ts = pq.read_table(f, columns=["measurement_tstamp"]).column(0).to_pylist()
        assert ts == sorted(ts)
    assert groups > len(files)
    assert spark.read.parquet(f"{tmp_dir}/c").count() == 20000


def test_each_time_bound_holds_by_itself(spark, tmp_path):
    from roadpulse.plans.prepare import compact_raw
    from roadpulse.operators.prepare import with_partitions
    t = dt.datetime
    rows = [(1, t(2023, m, 1), 1.0, 1.0, 1.0) for m in (1, 2, 3, 4)]
    root, out = str(tmp_path / "raw"), str(tmp_path / "sorted")
    with_partitions(spark.createDataFrame(rows, READING)).write.partitionBy("year", "month").parquet(root)
    months = lambda **k: sorted(r.month for r in readers.read_readings(spark, root, **k).collect())
    assert months(end="2023-02-01") == [1, 2] and months(end="2023-02-01", end_exclusive=True) == [1]
    assert months(start="2023-03-01") == [3, 4] and months(start="2023-02-01", end="2023-03-01") == [2, 3]
    assert months(months=[]) == [] and months() == [1, 2, 3, 4]
    compact_raw(spark, root, out)
    spark.read.parquet(root).where("month < 3").write.partitionBy("year", "month").parquet(root + "2")
    compact_raw(spark, root + "2", out)
    assert sorted(r.month for r in spark.read.parquet(out).collect()) == [1, 2]


def test_a_missing_year_is_not_found(spark, tmp_path):
    import pytest
    spark.createDataFrame([(2023, 1, 5, 1.0, 2.0)], "year int, month int, hour int, avg_speed double, avg_congestion_score double"
                          ).write.partitionBy("year", "month").parquet(str(tmp_path / "by_hour"))
    assert readers.read_historical(spark, str(tmp_path), "by_hour", 2023).count() == 1
    for year, month in ((2022, None), (2023, 2)):
        with pytest.raises(FileNotFoundError):
            readers.read_historical(spark, str(tmp_path), "by_hour", year, month)


def test_a_hot_time_stamp_is_spread_over_tasks(spark, tmp_path):
    import glob
    from roadpulse.sources.writers import compact_sorted
    from roadpulse.operators.prepare import with_partitions
    rows = [(k, dt.datetime(2023, 1, 1), 1.0, 1.0, 1.0) for k in range(4000)]
    compact_sorted(with_partitions(spark.createDataFrame(rows, READING)), str(tmp_path / "hot"), num_partitions=8)
    assert len(glob.glob(str(tmp_path / "hot/year=2023/month=1/*.parquet"))) >= 6
