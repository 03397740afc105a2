"""The historical batch job and the yearly compaction of its results.

Two scans of the readings feed all five results: one for the (period, hour,
weekday, class, direction) cube, which is bounded by the calendar and leaves
each task as a few thousand rows, one for the sums per (period, segment). (Sums
per hour, weekday and segment, which would feed both, are nearly as many as the
readings: they were shuffled twice and checkpointed in between.) The cube is
checkpointed to the shared checkpoint folder (lineage cut, survives executor
loss) and the four means are derived from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import historical as H
from ..operators.transform import enrich, score
from ..schemas import HISTORICAL_KINDS
from ..session import ensure_checkpoint_dir
from ..sources.readers import read_readings
from ..sources.writers import write_partitioned, write_small_single_file

def historical_aggregates(scored: DataFrame, segments: DataFrame,
                          period: Sequence[str] = H.MONTHLY,
                          checkpoint: bool = False) -> tuple[DataFrame, DataFrame]:
    """(cube, per-segment sums) of scored readings, readings of unknown
    segments excluded. The cube, which several results read, is checkpointed
    when asked; no reading is shuffled for its join with a lookup that can be
    broadcast."""
    cube = H.mean_cube(enrich(scored, segments, "inner", attrs=["frc", "bearing"]), period)
    if checkpoint:
        ensure_checkpoint_dir(scored.sparkSession)
        cube = cube.checkpoint()
    return cube, enrich(H.segment_sums(scored, period), segments, "inner", attrs=[])


def segment_means_from_sums(seg: DataFrame, segments: DataFrame,
                            period: Sequence[str] = H.MONTHLY) -> DataFrame:
    means = seg.select(*period, "xd_id",
                       F.try_divide(F.col("sum_score"), F.col("n_score")).alias("avg_congestion"),
                       F.try_divide(F.col("sum_speed"), F.col("n_speed")).alias("avg_speed"))
    return enrich(means, segments, "inner", attrs=["road_name", "bearing", "frc"]).select(
        *period, "xd_id", "road_name", "bearing", "frc", "avg_congestion", "avg_speed")


def historical_results(scored: DataFrame, segments: DataFrame, period: Sequence[str] = H.MONTHLY,
                       k: int = 20, checkpoint: bool = True) -> dict[str, DataFrame]:
    """The five results as DataFrames (``by_hour`` … ``top_segments``)."""
    cube, seg = historical_aggregates(scored, segments, period, checkpoint)
    out = {kind: H.from_cube(cube, kind, period) for kind in H.MEAN_KINDS}
    out["top_segments"] = H.top_segments(segment_means_from_sums(seg, segments, period), k, period)
    return out


def run_historical(spark: SparkSession, raw_root: str, segments: DataFrame, out_root: str,
                   year: int | None = None, months: list[int] | None = None,
                   period: Sequence[str] = H.MONTHLY, k: int = 20) -> dict[str, str]:
    """Compute the five results for the selected partitions and overwrite
    only the (year, month) partitions they touch. Returns kind -> path.

    A yearly result of some months would replace the whole year's: with
    ``months``, use a monthly period, or ``rollup.run_from_sums``, which merges
    stored sums."""
    if months is not None and "month" not in period:
        raise ValueError("months with a yearly period would replace the year's results by those of the months")
    readings = read_readings(spark, raw_root, year=year, months=months)
    results = historical_results(score(readings), segments, period, k)
    paths = {}
    for kind, df in results.items():
        path = f"{out_root.rstrip('/')}/{kind}"
        write_partitioned(df, path, partition_cols=list(period))
        paths[kind] = path
    return paths


def compact_results(spark: SparkSession, src_root: str, dst_root: str, year: int,
                    kinds: Sequence[str] = HISTORICAL_KINDS) -> None:
    """One file per result and year under a *separate* root (rewriting the
    folder being read would lose the input if an executor died mid-write)."""
    if src_root.rstrip("/") == dst_root.rstrip("/"):
        raise ValueError("compaction must write to a different root than it reads")
    for kind in kinds:
        df = spark.read.parquet(f"{src_root.rstrip('/')}/{kind}").where(F.col("year") == F.lit(int(year)))
        write_small_single_file(df, f"{dst_root.rstrip('/')}/{kind}", partition_cols=("year",))
