"""Latest state per segment (the snapshot the live map reads)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, NumericType,
                               TimestampNTZType, TimestampType)


def _fixed_width(t: DataType) -> bool:
    """Types whose ``max_by`` buffer fits a hash-aggregation row."""
    if isinstance(t, DecimalType):
        return t.precision <= 18
    return isinstance(t, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType))


def latest(windows: DataFrame, key: str = "xd_id", order: str = "window_start",
           previous: DataFrame | None = None) -> DataFrame:
    """The row with the newest ``order`` value per ``key``.

    Same rows as ``row_number() OVER (PARTITION BY key ORDER BY order DESC) = 1``
    (keys of a windowed aggregate are unique per window, so there are no
    ties), planned as an aggregate: partial aggregation keeps one row per key
    and task before the shuffle. Fixed-width columns each take their own
    ``max_by`` so the plan stays a hash aggregate (no sort) and unused
    columns are pruned; variable-width columns (names, bearings) travel in
    one struct ``max_by`` (sort-based aggregate).

    ``previous`` (carry-forward mode) is the last snapshot; its rows stay
    for keys absent from ``windows``, and on an equal ``order`` value the row
    of ``windows`` wins.
    """
    others = [f for f in windows.schema.fields if f.name != key]
    names = [f.name for f in others]
    if previous is not None:
        src = (windows.withColumn("_src", F.lit(1))
               .unionByName(previous.select(*windows.columns).withColumn("_src", F.lit(0))))
        packed = F.struct(*[F.col(c) for c in names])
        return (src.groupBy(key)
                .agg(F.max_by(packed, F.struct(F.col(order), F.col("_src"))).alias("_row"))
                .select(key, *[F.col(f"_row.{c}").alias(c) for c in names]))
    fixed = [f.name for f in others if _fixed_width(f.dataType)]
    varying = [c for c in names if c not in fixed]
    ordering = F.col(order)
    aggs = [(F.max(ordering) if c == order else F.max_by(F.col(c), ordering)).alias(c) for c in fixed]
    if varying:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in varying]), ordering).alias("_row"))
    out = windows.groupBy(key).agg(*aggs)
    return out.select(key, *[F.col(c) if c in fixed else F.col(f"_row.{c}").alias(c) for c in names])
