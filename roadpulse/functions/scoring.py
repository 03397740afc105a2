"""Column expressions for scoring and cleaning measures (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def congestion_score(speed: str | Column = "speed",
                     reference: str | Column = "reference_speed") -> Column:
    """``(reference - speed) / reference``; NULL when the reference is 0 or NULL.

    ``try_divide`` keeps the Spark 4 ANSI default on (plain ``/`` would raise
    DIVIDE_BY_ZERO) and is NULL-safe.
    """
    ref = _c(reference)
    return F.try_divide(ref - _c(speed), ref)


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL (``from_json`` turns the token ``NaN`` into a real NaN, which
    passes ``>= 20`` / ``IS NOT NULL`` and poisons ``avg``)."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def non_finite_to_null(c: str | Column) -> Column:
    """NaN, +Inf, -Inf -> NULL."""
    c = _c(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def null_out_non_finite(df: DataFrame) -> DataFrame:
    """Replace NaN / +-Inf by NULL in every float and double column (the JSON
    sanitiser of the serving layer, as one projection)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(non_finite_to_null(F.col(f.name)).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
