"""Stored partial sums: every historical result from one mergeable table.

``segment_hour_sums`` of each month is a partition of the table. Sums and
counts add up, so results of any period, monthly, yearly or of all time, are
folds of it: a corrected month is written again alone, and the year is merged
from the twelve partitions without reading a reading.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import historical as H
from ..operators.transform import enrich, score
from ..sources.readers import read_readings
from ..sources.writers import write_partitioned
from .batch import segment_means_from_sums


def update_sums(spark: SparkSession, raw_root: str, sums_root: str, year: int | None = None,
                months: Iterable[int] | None = None) -> None:
    """Write the sums of the selected months of ``raw_root`` (all, if none is
    given), replacing these partitions of the table only. A selected month
    without readings loses its partition."""
    months = None if months is None else sorted(int(m) for m in months)
    if months is not None and year is None:
        raise ValueError("months belong to a year")
    readings = read_readings(spark, raw_root, year=year, months=months)
    sums = H.segment_hour_sums(score(readings), H.MONTHLY).where(F.col("year").isNotNull())
    write_partitioned(sums.hint("rebalance", "year", "month"), sums_root, H.MONTHLY)
    if year is not None:
        found = {r["month"] for r in readings.select("month").distinct().collect()} if "month" in readings.columns else set()
        for m in (months if months is not None else range(1, 13)):
            if m not in found:
                _remove(spark, f"{sums_root.rstrip('/')}/year={int(year)}/month={m}")


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_sums(spark: SparkSession, sums_root: str, year: int | None = None, months: Iterable[int] | None = None) -> DataFrame:
    """Stored sums; the selection prunes partitions."""
    df = spark.read.parquet(sums_root)
    df = df if year is None else df.where(F.col("year") == int(year))
    return df if months is None else df.where(F.col("month").isin([int(m) for m in months]))


def results_from_sums(sums: DataFrame, segments: DataFrame, period: Sequence[str] = H.YEARLY, k: int = 20) -> dict[str, DataFrame]:
    """The five historical results of a period, merged from stored sums."""
    merged = H.fold(sums, [*period, "hour", "day_of_week", "xd_id"])
    cube = H.cube_from_sums(merged, segments, period)
    out = {kind: H.from_cube(cube, kind, period) for kind in H.MEAN_KINDS}
    known = enrich(H.fold(sums, [*period, "xd_id"]), segments, "inner", attrs=[])
    out["top_segments"] = H.top_segments(segment_means_from_sums(known, segments, period), k, period)
    return out


def run_from_sums(spark: SparkSession, sums_root: str, segments: DataFrame, out_root: str, year: int | None = None,
                  months: Iterable[int] | None = None, k: int = 20) -> dict[str, str]:
    """Write the monthly results of the selected months and the yearly ones of
    their years (always of all months stored), replacing their partitions only.
    Returns kind -> path; the yearly kinds end in ``_yearly``."""
    paths = {}
    for period, chosen, suffix in ((H.MONTHLY, months, ""), (H.YEARLY, None, "_yearly")):
        for kind, df in results_from_sums(read_sums(spark, sums_root, year, chosen), segments, period, k).items():
            paths[kind + suffix] = f"{out_root.rstrip('/')}/{kind}{suffix}"
            write_partitioned(df, paths[kind + suffix], partition_cols=list(period))
    return paths
