"""Preparation of raw readings: date split, partition columns, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MEASURES
from .replay import _lit

TS = "measurement_tstamp"


def in_range(lo, hi, ts: str = TS):
    """Both bounds inclusive *as timestamps*: an end bound given as a date
    keeps only 00:00:00 of that day."""
    return F.col(ts).between(_lit(lo), _lit(hi))


def date_split(df: DataFrame, historical: tuple, replay: tuple, ts: str = TS) -> dict[str, DataFrame]:
    """The historical set and the replay set (rows outside both are dropped;
    overlapping ranges put a row in both)."""
    return {"historical": df.where(in_range(*historical, ts=ts)),
            "replay": df.where(in_range(*replay, ts=ts))}


def with_partitions(df: DataFrame, ts: str = TS) -> DataFrame:
    """Add ``year`` and ``month`` partition columns from the timestamp."""
    return df.withColumn("year", F.year(ts)).withColumn("month", F.month(ts))


def downcast(df: DataFrame) -> DataFrame:
    """Store measures as float32 (compute stays DOUBLE after reading)."""
    return df.select(*[F.col(c).cast("float").alias(c) if c in MEASURES else F.col(c)
                       for c in df.columns])


def ingest_counts(df: DataFrame, historical: tuple, replay: tuple, ts: str = TS) -> DataFrame:
    """Total rows and rows of each split, in one aggregation."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(in_range(*historical, ts=ts)).alias("historical_rows"),
                  F.count_if(in_range(*replay, ts=ts)).alias("replay_rows"))


def union_raw(historical: DataFrame, replay: DataFrame) -> DataFrame:
    """Both sets under one partitioned tree (rows of a month present in both
    are kept, not replaced)."""
    return with_partitions(historical).unionByName(with_partitions(replay))
