"""Sinks: partitioned Parquet, time-sorted compaction, JSON records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import null_out_non_finite

# Rows per output file of a compaction.
DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000
# Parquet row-group size of a compaction, in bytes (the reference asks for
# 500k-row groups; at the 4-5 narrow columns kept that is a few MB, so a
# byte target of Parquet's usual 128 MB gives fewer, larger groups whose
# min/max statistics still follow the time order).
DEFAULT_ROW_GROUP_BYTES = 128 * 1024 * 1024


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = ("year", "month"),
                      dynamic: bool = True, compression: str = "snappy") -> None:
    """Overwrite only the partitions present in ``df`` (``dynamic``), or the
    whole path. Set per write, not session-wide."""
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .option("compression", compression)
     .partitionBy(*partition_cols).parquet(path))


def compact_sorted(df: DataFrame, path: str, ts: str = "measurement_tstamp",
                   partition_cols: Sequence[str] = ("year", "month"),
                   num_partitions: int | None = None,
                   max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                   row_group_bytes: int = DEFAULT_ROW_GROUP_BYTES,
                   spread: str = "xd_id", dynamic: bool = False) -> None:
    """Rewrite readings as time-ordered files per partition, replacing the
    whole path (``dynamic``: only the partitions present in ``df``).

    Range partitioning on (partition columns, time, ``spread``) splits a large
    month, and a time stamp that many segments share, over
    many tasks, each writing one contiguous time range sorted by time, so
    the min/max statistics of every file and row group are tight and range
    scans skip most of them. ``maxRecordsPerFile`` bounds file size and
    ``row_group_bytes`` the Parquet row groups (``parquet.block.size``).
    """
    keys = [*partition_cols, ts]
    ranged = [*keys, spread] if spread in df.columns else keys
    parts = df.repartitionByRange(num_partitions, *ranged) if num_partitions else df.repartitionByRange(*ranged)
    (parts.sortWithinPartitions(*keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .option("maxRecordsPerFile", max_records_per_file)
     .option("parquet.block.size", str(int(row_group_bytes)))
     .option("compression", "snappy")
     .partitionBy(*partition_cols).parquet(path))


def write_small_single_file(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """One file per output folder, for results whose size is bounded by the
    calendar and the key domain (historical means, top-k lists)."""
    w = df.coalesce(1).write.mode("overwrite")
    if partition_cols:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    w.parquet(path)


# Times keep their microseconds (the default format stops at milliseconds).
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def to_json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row, with NaN and +-Inf written as ``null``."""
    clean = null_out_non_finite(df)
    return clean.select(F.to_json(F.struct(*[F.col(c) for c in clean.columns]),
                                  {"ignoreNullFields": "false", **JSON_TIMES}).alias("json"))
