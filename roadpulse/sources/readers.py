"""Readers: raw CSV, partitioned readings, segment lookup, results, snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.replay import _ts, time_range
from ..operators.transform import prepare_segments
from ..schemas import HISTORICAL_KINDS, READING_COLUMNS, READING_CSV_COLUMNS, SEGMENT_CSV_COLUMNS


def _csv_by_name(spark: SparkSession, path: str | list[str], wanted: list[tuple[str, str, str]],
                 source: str | None = None) -> DataFrame:
    """Read a headed CSV with every column as STRING and pick columns by
    header *name* (a schema given to the reader maps by position and would
    silently shift columns). Values that do not parse become NULL. ``source``
    names a further column with each row's file."""
    raw = (spark.read.option("header", "true").option("inferSchema", "false")
           .option("mode", "PERMISSIVE").csv(path))
    missing = [src for src, _, _ in wanted if src not in raw.columns]
    if missing:
        raise ValueError(f"{path}: missing CSV columns {missing}")
    more = [F.col("_metadata.file_path").alias(source)] if source else []
    return raw.select(*[F.col(f"`{src}`").try_cast(typ).alias(dst) for src, dst, typ in wanted], *more)


def read_readings_csv(spark: SparkSession, path: str | list[str], source: str | None = None) -> DataFrame:
    """Raw readings CSV (any superset of columns, any order; several files or a
    folder must have one header) -> typed readings."""
    return _csv_by_name(spark, path, [(c, c, t) for c, t in READING_CSV_COLUMNS], source)


def read_segments_csv(spark: SparkSession, path: str) -> DataFrame:
    """Segment lookup CSV -> snake-case, typed, one row per ``xd``."""
    return prepare_segments(_csv_by_name(spark, path, SEGMENT_CSV_COLUMNS))


def read_readings(spark: SparkSession, root: str, year: int | None = None,
                  months: list[int] | None = None, start=None, end=None,
                  end_exclusive: bool = False) -> DataFrame:
    """Readings from a ``year=/month=`` partitioned Parquet root.

    ``year``/``months`` and the time range become partition filters (pruned
    at planning) and pushed-down row-group filters; measures are widened to
    DOUBLE. Each bound holds by itself; ``end`` is inclusive unless
    ``end_exclusive``. An empty ``months`` selects nothing.
    """
    df = spark.read.parquet(root)
    if year is not None:
        df = df.where(F.col("year") == F.lit(int(year)))
    if months is not None:
        df = df.where(F.col("month").isin([int(m) for m in months]))
    if end is not None and not end_exclusive:
        # inclusive: up to the next representable instant
        df = time_range(df, start, _ts(end) + dt.timedelta(microseconds=1))
    elif start is not None or end is not None:
        df = time_range(df, start, end)
    cols = [F.col("xd_id").cast("bigint").alias("xd_id"),
            F.col("measurement_tstamp").cast("timestamp_ntz").alias("measurement_tstamp")]
    cols += [F.col(c).cast("double").alias(c) for c in READING_COLUMNS[2:]]
    extra = [c for c in ("year", "month") if c in df.columns]
    return df.select(*cols, *extra)


# Presentation order of each result kind (applied at the reader; a sort
# before a Parquet write would only be layout).
RESULT_ORDER = {"by_hour": ["hour"], "by_day_of_week": ["day_of_week"], "by_road_type": ["road_type"],
                "by_direction": ["direction"], "top_segments": ["-avg_congestion", "xd_id"]}


def _order_col(spec: str):
    return F.col(spec[1:]).desc_nulls_last() if spec.startswith("-") else F.col(spec)


def read_historical(spark: SparkSession, root: str, kind: str, year: int,
                    month: int | None = None, ordered: bool = False) -> DataFrame:
    """One historical result for a year (optionally one month; ``ordered``
    sorts by period then the kind's key).

    Raises ``ValueError`` for an unknown kind or a month outside 1-12 and
    ``FileNotFoundError`` for a year (or month) without results; a missing
    root raises Spark's ``AnalysisException`` (PATH_NOT_FOUND).
    """
    if kind not in HISTORICAL_KINDS:
        raise ValueError(f"unknown result kind {kind!r}; expected one of {HISTORICAL_KINDS}")
    if month is not None and not 1 <= int(month) <= 12:
        raise ValueError("month must be in 1..12")
    df = spark.read.parquet(f"{root.rstrip('/')}/{kind}").where(F.col("year") == F.lit(int(year)))
    if month is not None:
        df = df.where(F.col("month") == F.lit(int(month)))
    if df.select(F.lit(1)).isEmpty():
        raise FileNotFoundError(f"no {kind} result for {year}" + (f"-{int(month):02d}" if month is not None else ""))
    if ordered:
        period = [c for c in ("year", "month") if c in df.columns]
        df = df.orderBy(*period, *[_order_col(c) for c in RESULT_ORDER[kind]])
    return df


def snapshot_versions(spark: SparkSession, root: str) -> DataFrame:
    """Committed snapshot versions: ``version``, the ``run`` and ``batch_id``
    that wrote it and the ``slot`` holding it."""
    return spark.read.parquet(f"{root.rstrip('/')}/commits").select("version", "run", "batch_id", "slot")


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest *committed* snapshot.

    The snapshot writer overwrites the data of a slot first and only then
    that slot's commit record, and never rewrites the slot of the newest
    committed version, so the highest committed version always points at
    complete data.
    """
    root = root.rstrip("/")
    newest = snapshot_versions(spark, root).orderBy(F.col("version").desc()).first()
    if newest is None:
        raise FileNotFoundError(f"no committed snapshot under {root}")
    return spark.read.parquet(f"{root}/data/slot={int(newest['slot'])}")
