"""Time ranges, replay slices and the message encoding of readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefns import floor_minutes, iso_format, month_index

TS = "measurement_tstamp"


def _ts(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


def _lit(v) -> Column:
    """Zone-free timestamp literal (TIMESTAMP_NTZ)."""
    return F.expr(f"TIMESTAMP_NTZ'{_ts(v).isoformat(sep=' ')}'")


def partition_predicate(lo=None, hi_incl=None) -> Column:
    """Predicate on ``year``/``month`` partition columns derived from a time
    range (either bound may be open), so a range read prunes partitions
    (Catalyst cannot infer it from the timestamp filter)."""
    idx = month_index(F.col("year"), F.col("month"))
    out = F.lit(True)
    if lo is not None:
        out = out & (idx >= _ts(lo).year * 12 + _ts(lo).month)
    if hi_incl is not None:
        out = out & (idx <= _ts(hi_incl).year * 12 + _ts(hi_incl).month)
    return out


def time_range(df: DataFrame, lo=None, hi_excl=None, ts: str = TS) -> DataFrame:
    """Rows with ``lo <= ts < hi_excl``, each bound only if given; adds the
    partition predicate when the frame has ``year``/``month`` columns (a
    partitioned readings root)."""
    out = df if lo is None else df.where(F.col(ts) >= _lit(lo))
    out = out if hi_excl is None else out.where(F.col(ts) < _lit(hi_excl))
    if {"year", "month"} <= set(df.columns):
        last = None if hi_excl is None else _ts(hi_excl) - dt.timedelta(microseconds=1)
        out = out.where(partition_predicate(lo, last))
    return out


def default_end(start) -> dt.datetime:
    """End of a replay when none is given: last second of the start year."""
    s = _ts(start)
    return dt.datetime(s.year, 12, 31, 23, 59, 59)


def clip(df: DataFrame, start, end=None, ts: str = TS) -> DataFrame:
    """Rows with ``start <= ts <= end`` (end inclusive; default end of the
    start year)."""
    e = default_end(start) if end is None else _ts(end)
    out = df.where(F.col(ts).between(_lit(start), _lit(e)))
    if {"year", "month"} <= set(df.columns):
        out = out.where(partition_predicate(start, e))
    return out


def slices(df: DataFrame, start, end=None, minutes: int = 10, ts: str = TS) -> DataFrame:
    """Cut the replay window into clock-aligned slices of ``minutes``.

    Adds ``slice_start`` (the slice's clock start, but never before
    ``start``) and ``slice_end`` (exclusive). Empty slices simply have no
    rows. Writing the result ``partitionBy("slice_start")`` gives one folder
    per slice, oldest first, for a file-stream replay.
    """
    floor = floor_minutes(F.col(ts), minutes)
    return clip(df, start, end, ts).select(
        "*", F.greatest(floor, _lit(start)).alias("slice_start"),
        F.timestamp_add("MINUTE", F.lit(minutes), floor).alias("slice_end"))


def slice_counts(df: DataFrame, start, end=None, minutes: int = 10, ts: str = TS) -> DataFrame:
    """Rows per non-empty replay slice (``slice_start``, ``slice_end``,
    ``rows``): the per-slice report of a verbose replay. Empty slices have
    no row, as the replay skips them."""
    return (slices(df, start, end, minutes, ts).groupBy("slice_start", "slice_end")
            .agg(F.count(F.lit(1)).alias("rows")))


def to_messages(df: DataFrame, ts: str = TS) -> DataFrame:
    """Readings -> (``key``, ``value``) messages: key is the segment id as
    text, value the JSON object with the timestamp in ISO form. NULL
    measures are written as ``null`` (not dropped)."""
    body = F.struct(F.col("xd_id"), iso_format(F.col(ts)).alias("measurement_tstamp"),
                    F.col("speed"), F.col("reference_speed"), F.col("confidence_score"))
    return df.select(F.col("xd_id").cast("string").alias("key"),
                     F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def write_message_slices(df: DataFrame, path: str, start, end=None, minutes: int = 10,
                         ts: str = TS, rows_per_file: int = 500_000) -> None:
    """Replay input for a file stream: the JSON messages of each slice under
    ``path/slice_start=<t>/``, in time order.

    Rows are range-partitioned by (slice, spread) into as many parts as they
    fill files (``rows_per_file``): the files, and with them the micro-batches
    of their reader, are at most the slices and these parts together, whatever
    the number of shuffle partitions.
    The files then get modification times in slice order: a file stream takes
    files oldest first, so no reading arrives after a later slice's. The
    slices are not paced."""
    sliced = slices(df, start, end, minutes, ts)
    body = F.struct(F.col("xd_id"), iso_format(F.col(ts)).alias("measurement_tstamp"),
                    F.col("speed"), F.col("reference_speed"), F.col("confidence_score"))
    out = sliced.select("slice_start", F.col(ts).alias("_ts"), F.xxhash64("xd_id").alias("_spread"),
                        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))
    parts = max(1, -(-sliced.count() // rows_per_file))
    (out.repartitionByRange(parts, "slice_start", "_spread").sortWithinPartitions("slice_start", "_ts").drop("_ts", "_spread")
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("slice_start").text(path))
    order_files(df.sparkSession, path)


def order_files(spark, path: str) -> int:
    """Give the files under ``path/slice_start=<t>/`` modification times in
    slice order, ending now (metadata calls only, one per file). Returns the
    number of files."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = sorted((str(f.getPath().getName()), f.getPath()) for f in fs.listStatus(root) if f.isDirectory())
    files = [f.getPath() for _, folder in folders for f in sorted(fs.listStatus(folder), key=lambda f: f.getPath().getName())]
    first = int(dt.datetime.now().timestamp() * 1000) - 1000 * len(files)
    for i, f in enumerate(files):
        fs.setTimes(f, first + 1000 * i, -1)
    return len(files)
