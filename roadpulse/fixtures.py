"""Stand-in inputs built from the shared test tables.

``readings`` comes from ``events``, ``segments`` from ``supplier`` and
``readings_long`` (many months, all hours) from ``lineitem``. Each view is
a DataFrame for Spark and the same text as a SQL CTE for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.transform import prepare_segments

# DataFrames are immutable plans: the stand-in views are built once per
# session and folder (saves the file listing and footer reads per query).
_views: dict = {}


def _memo(fn):
    def wrapper(spark: SparkSession, sf_dir: str, *args):
        key = (fn.__name__, spark.sparkContext.applicationId, sf_dir.rstrip("/"), args)
        if key not in _views:
            _views[key] = fn(spark, sf_dir, *args)
        return _views[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


@_memo
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_memo
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.when(F.col("user_id") % 40 != 11, F.col("user_id")).alias("xd_id"),
        F.col("ts").alias("measurement_tstamp"),
        F.col("value").alias("speed"),
        ((F.col("user_id") % 8) * 15).cast("double").alias("reference_speed"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("confidence_score"),
    )


@_memo
def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    nk = F.col("s_nationkey")
    raw = s.select(
        k.alias("xd"),
        F.when(k % 10 == 3, F.lit("  ")).otherwise(F.col("s_name")).alias("road_name"),
        F.when(k % 10 == 9, 0).when(k % 11 == 7, 6).otherwise(nk % 5 + 1).cast("int").alias("frc"),
        F.when(k % 13 == 4, "?").when(k % 17 == 6, None).when(nk % 4 == 0, "N").when(nk % 4 == 1, "S").when(nk % 4 == 2, "E")
         .otherwise("W").alias("bearing"),
        (F.lit(36.0) + k * F.lit(0.001)).alias("start_lat"),
        (F.lit(-86.8) + k * F.lit(0.001)).alias("start_long"),
        (F.lit(36.0005) + k * F.lit(0.001)).alias("end_lat"),
        (F.lit(-86.7995) + k * F.lit(0.001)).alias("end_long"),
    )
    return prepare_segments(raw)


@_memo
def readings_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("xd_id"),
        F.timestamp_add("HOUR", (F.col("l_orderkey") % 24).cast("int"), F.col("l_shipdate")).alias("measurement_tstamp"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("speed"),
        F.col("l_extendedprice").alias("reference_speed"),
        F.col("l_quantity").alias("confidence_score"),
    )


# Same views as SQL for the DuckDB oracle.
READINGS_SQL = """readings AS (
  SELECT CASE WHEN user_id % 40 <> 11 THEN user_id END AS xd_id, ts AS measurement_tstamp, value AS speed,
         CAST((user_id % 8) * 15 AS DOUBLE) AS reference_speed,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS confidence_score
  FROM events)"""

SEGMENTS_SQL = """segments AS (
  SELECT s_suppkey AS xd,
         CASE WHEN s_suppkey % 10 = 3 THEN '  ' ELSE s_name END AS road_name,
         CAST(CASE WHEN s_suppkey % 10 = 9 THEN 0 WHEN s_suppkey % 11 = 7 THEN 6 ELSE s_nationkey % 5 + 1 END AS INTEGER) AS frc,
         CASE WHEN s_suppkey % 13 = 4 THEN '?' WHEN s_suppkey % 17 = 6 THEN NULL WHEN s_nationkey % 4 = 0 THEN 'N'
              WHEN s_nationkey % 4 = 1 THEN 'S' WHEN s_nationkey % 4 = 2 THEN 'E' ELSE 'W' END AS bearing,
         36.0e0 + s_suppkey * 0.001e0 AS start_lat, -86.8e0 + s_suppkey * 0.001e0 AS start_long,
         36.0005e0 + s_suppkey * 0.001e0 AS end_lat, -86.7995e0 + s_suppkey * 0.001e0 AS end_long
  FROM supplier)"""

READINGS_LONG_SQL = """readings AS (
  SELECT l_suppkey AS xd_id, l_shipdate + (l_orderkey % 24) * INTERVAL 1 HOUR AS measurement_tstamp,
         l_extendedprice * (1.0e0 - l_discount) AS speed, l_extendedprice AS reference_speed,
         l_quantity AS confidence_score
  FROM lineitem)"""


def with_views(body: str, long: bool = False, extra: str = "") -> str:
    """Prefix an oracle query with the stand-in views as CTEs."""
    ctes = [READINGS_LONG_SQL if long else READINGS_SQL, SEGMENTS_SQL]
    if extra:
        ctes.append(extra)
    return "WITH " + ",\n".join(ctes) + "\n" + body
