"""Registered queries: each one runs library operators over the whole
stand-in tables, with the equivalent DuckDB SQL as its oracle.

Doubles are rounded to 6 decimals on both sides (sums run in a different
order in the two engines); ``written_at`` (wall clock) is never part of a
registered query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .. import fixtures as fx
from ..operators import historical as H
from ..operators.transform import clean, enrich, score

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (comparison form).

    Both sides compute ``round(round(x * 1e9) / 1e9 * 1e6) / 1e6``: the
    first step snaps the last-bit noise of a different summation order back
    onto the decimal grid (the inputs have few decimals, so exact half-way
    averages are common), the second rounds half away from zero on the same
    IEEE double in both engines (``round(x, 6)`` differs between them).
    Built as one SQL projection (one call to the JVM, not ten per column)."""
    def one(f):
        name = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (DoubleType, FloatType)):
            return f"{R6(name)} AS {name}"
        return name
    return df.selectExpr(*[one(f) for f in df.schema.fields])


def R6(expr: str) -> str:
    """SQL twin of ``r6`` for one expression."""
    return f"round(round(({expr}) * 1e9) / 1e9 * 1e6) / 1e6"


# ---------------------------------------------------------------------------
# Shared inputs
# ---------------------------------------------------------------------------

def _scored(spark, sf_dir, long=False):
    r = fx.readings_long(spark, sf_dir) if long else fx.readings(spark, sf_dir)
    return score(r)


def _enriched_inner(spark, sf_dir, long=False):
    return enrich(_scored(spark, sf_dir, long), fx.segments(spark, sf_dir), "inner")


SCORE_SQL = "(reference_speed - speed) / NULLIF(reference_speed, 0)"
Y = "CAST(year(measurement_tstamp) AS INTEGER)"
M = "CAST(month(measurement_tstamp) AS INTEGER)"
HOUR = "CAST(hour(measurement_tstamp) AS INTEGER)"
DOW = "CAST(dayofweek(measurement_tstamp) + 1 AS INTEGER)"

_KEY_SQL = {"by_hour": (HOUR, "hour"), "by_day_of_week": (DOW, "day_of_week"),
            "by_road_type": ("frc", "road_type"), "by_direction": ("bearing", "direction")}


def _mean_sql(kind: str, monthly: bool = True, long: bool = False) -> str:
    expr, name = _KEY_SQL[kind]
    period = f"{Y} AS year, {M} AS month" if monthly else f"{Y} AS year"
    return fx.with_views(f"""
SELECT {period}, {expr} AS {name},
       round(round((avg(speed)) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_speed,
       round(round((avg({SCORE_SQL})) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_congestion_score
FROM readings r JOIN segments s ON r.xd_id = s.xd
GROUP BY ALL""", long=long)


# ---------------------------------------------------------------------------
# A1-A4: monthly means (readings: every hour of one month)
# ---------------------------------------------------------------------------

def _monthly(kind):
    def q(spark, sf_dir):
        return r6(H.mean_by(_enriched_inner(spark, sf_dir), kind, H.MONTHLY))
    return q


for _k in H.MEAN_KINDS:
    register(_k, _mean_sql(_k))(_monthly(_k))


# Yearly means over the multi-year readings
def _yearly(kind):
    def q(spark, sf_dir):
        return r6(H.mean_by(_enriched_inner(spark, sf_dir, long=True), kind, H.YEARLY))
    return q


for _k in H.MEAN_KINDS:
    register("year_" + _k, _mean_sql(_k, monthly=False, long=True))(_yearly(_k))


# ---------------------------------------------------------------------------
# A1-A4 in one pass
# ---------------------------------------------------------------------------

def _all_means_sql(long: bool = False) -> str:
    parts = []
    cols = {"hour": "NULL::INTEGER", "day_of_week": "NULL::INTEGER",
            "road_type": "NULL::INTEGER", "direction": "NULL::VARCHAR"}
    for kind, (expr, name) in _KEY_SQL.items():
        sel = ", ".join(f"{expr if n == name else cols[n]} AS {n}" for n in cols)
        parts.append(f"""SELECT '{kind}' AS kind, {Y} AS year, {M} AS month, {sel},
       round(round((avg(speed)) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_speed, round(round((avg({SCORE_SQL})) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_congestion_score
FROM readings r JOIN segments s ON r.xd_id = s.xd GROUP BY ALL""")
    return fx.with_views("\nUNION ALL\n".join(parts), long=long)


@register("historical_cube", _all_means_sql())
def historical_cube(spark, sf_dir):
    """All four monthly means from one bounded sums/counts cube."""
    return r6(H.all_means_long(_enriched_inner(spark, sf_dir), H.MONTHLY))


@register("historical_grouping_sets", _all_means_sql())
def historical_grouping_sets(spark, sf_dir):
    return r6(H.grouping_sets_means(_enriched_inner(spark, sf_dir), H.MONTHLY))


# ---------------------------------------------------------------------------
# A5 / O1 / O2: worst segments (multi-month readings)
# ---------------------------------------------------------------------------

def _segment_means_sql(monthly=True) -> str:
    period = f"{Y} AS year, {M} AS month" if monthly else f"{Y} AS year"
    return f"""seg_means AS (
  SELECT {period}, r.xd_id, s.road_name, s.bearing, s.frc,
         avg({SCORE_SQL}) AS avg_congestion, avg(speed) AS avg_speed
  FROM readings r JOIN segments s ON r.xd_id = s.xd
  GROUP BY ALL)"""


@register("segment_means", fx.with_views(
    "SELECT year, month, xd_id, road_name, bearing, frc, round(round((avg_congestion) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_congestion, "
    "round(round((avg_speed) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_speed FROM seg_means", long=True, extra=_segment_means_sql()))
def segment_means(spark, sf_dir):
    return r6(H.segment_means(_scored(spark, sf_dir, long=True), fx.segments(spark, sf_dir), H.MONTHLY))


@register("top_segments_month", fx.with_views("""
SELECT year, month, xd_id, road_name, bearing, frc,
       round(round((avg_congestion) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_congestion, round(round((avg_speed) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_speed
FROM (SELECT *, row_number() OVER (PARTITION BY year, month
                                   ORDER BY avg_congestion DESC NULLS LAST, xd_id) AS rn
      FROM seg_means) WHERE rn <= 20""", long=True, extra=_segment_means_sql()))
def top_segments_month(spark, sf_dir):
    means = H.segment_means(_scored(spark, sf_dir, long=True), fx.segments(spark, sf_dir), H.MONTHLY)
    return r6(H.top_segments(means, 20, H.MONTHLY))


@register("top_segments_year", fx.with_views("""
SELECT year, xd_id, road_name, bearing, frc,
       round(round((avg_congestion) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_congestion, round(round((avg_speed) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_speed
FROM (SELECT *, row_number() OVER (PARTITION BY year
                                   ORDER BY avg_congestion DESC NULLS LAST, xd_id) AS rn
      FROM seg_means) WHERE rn <= 20""", long=True, extra=_segment_means_sql(monthly=False)))
def top_segments_year(spark, sf_dir):
    means = H.segment_means(_scored(spark, sf_dir, long=True), fx.segments(spark, sf_dir), H.YEARLY)
    return r6(H.top_segments(means, 20, H.YEARLY))


@register("top_segments_all_time", fx.with_views("""
SELECT r.xd_id, s.road_name, s.bearing, s.frc,
       round(round((avg({score})) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_congestion, round(round((avg(speed)) * 1e9) / 1e9 * 1e6) / 1e6 AS avg_speed
FROM readings r JOIN segments s ON r.xd_id = s.xd
GROUP BY ALL
ORDER BY avg({score}) DESC NULLS LAST, r.xd_id LIMIT 20""".format(score=SCORE_SQL), long=True))
def top_segments_all_time(spark, sf_dir):
    means = H.segment_means(_scored(spark, sf_dir, long=True), fx.segments(spark, sf_dir), ())
    return r6(H.top_segments(means, 20, ()))


# ---------------------------------------------------------------------------
# Row-level transforms
# ---------------------------------------------------------------------------

CLEAN_WHERE = ("confidence_score >= 20 AND speed IS NOT NULL AND reference_speed IS NOT NULL "
               "AND reference_speed > 0")


@register("cleaned_readings", fx.with_views(f"""
SELECT xd_id, measurement_tstamp, speed, reference_speed, confidence_score,
       round(round(((reference_speed - speed) / reference_speed) * 1e9) / 1e9 * 1e6) / 1e6 AS congestion_score
FROM readings WHERE {CLEAN_WHERE}"""))
def cleaned_readings(spark, sf_dir):
    return r6(clean(fx.readings(spark, sf_dir), 20.0))


@register("enriched_left", fx.with_views(f"""
SELECT r.xd_id, measurement_tstamp, speed, reference_speed, confidence_score,
       round(round(((reference_speed - speed) / reference_speed) * 1e9) / 1e9 * 1e6) / 1e6 AS congestion_score,
       road_name, frc, bearing, start_lat, start_long, end_lat, end_long
FROM readings r LEFT JOIN segments s ON r.xd_id = s.xd
WHERE {CLEAN_WHERE}"""))
def enriched_left(spark, sf_dir):
    return r6(enrich(clean(fx.readings(spark, sf_dir), 20.0), fx.segments(spark, sf_dir), "left"))


# ---------------------------------------------------------------------------
# Sliding windows (60 / 10 minutes) over cleaned readings
# ---------------------------------------------------------------------------

from ..operators import snapshot as S  # noqa: E402
from ..operators import windows as W  # noqa: E402

WINDOW_CTES = f"""cleaned AS (
  SELECT *, (reference_speed - speed) / reference_speed AS congestion_score
  FROM readings WHERE {CLEAN_WHERE}),
slotted AS (
  SELECT *, time_bucket(INTERVAL '10 minutes', measurement_tstamp, TIMESTAMP '1970-01-01 00:00:00') AS b
  FROM cleaned WHERE measurement_tstamp IS NOT NULL),
win AS (
  SELECT slotted.*, b - k * INTERVAL '10 minutes' AS window_start
  FROM slotted, generate_series(0, 5) g(k))"""

WIN_COLS = """window_start, window_start + INTERVAL '60 minutes' AS window_end,
       CAST(year(window_start) AS INTEGER) AS year, CAST(month(window_start) AS INTEGER) AS month,
       CAST(day(window_start) AS INTEGER) AS day"""

SEG_WINDOWS_SQL = f"""seg_win AS (
  SELECT xd_id, avg(speed) AS avg_speed, avg(congestion_score) AS avg_congestion,
         count(*) AS reading_count, {WIN_COLS}
  FROM win GROUP BY xd_id, window_start),
seg_win_attr AS (
  SELECT w.*, s.road_name, s.frc, s.bearing, s.start_lat, s.start_long, s.end_lat, s.end_long
  FROM seg_win w LEFT JOIN segments s ON w.xd_id = s.xd)"""

SEG_WIN_SELECT = f"""xd_id, {R6('avg_speed')} AS avg_speed, {R6('avg_congestion')} AS avg_congestion,
       reading_count, window_start, window_end, year, month, day, road_name, frc, bearing,
       {R6('start_lat')} AS start_lat, {R6('start_long')} AS start_long,
       {R6('end_lat')} AS end_lat, {R6('end_long')} AS end_long"""


def _cleaned(spark, sf_dir):
    return clean(fx.readings(spark, sf_dir), 20.0)


def _window_by_segment(spark, sf_dir):
    return W.by_segment(_cleaned(spark, sf_dir), segments=fx.segments(spark, sf_dir))


@register("window_by_segment", fx.with_views(
    f"SELECT {SEG_WIN_SELECT} FROM seg_win_attr",
    extra=WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL))
def window_by_segment(spark, sf_dir):
    return r6(_window_by_segment(spark, sf_dir))


@register("window_by_segment_bucketed", fx.with_views(
    f"SELECT {SEG_WIN_SELECT} FROM seg_win_attr",
    extra=WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL))
def window_by_segment_bucketed(spark, sf_dir):
    """``window_by_segment`` with one shuffle of the readings by (segment, day)."""
    return r6(W.by_segment_bucketed(_cleaned(spark, sf_dir), segments=fx.segments(spark, sf_dir)))


ROAD_TYPE_WINDOW_SQL = fx.with_views(f"""
SELECT s.frc, {R6('avg(speed)')} AS avg_speed, {R6('avg(congestion_score)')} AS avg_congestion,
       count(*) AS reading_count, {WIN_COLS}
FROM win LEFT JOIN segments s ON win.xd_id = s.xd
GROUP BY s.frc, window_start""", extra=WINDOW_CTES)


@register("window_by_road_type", ROAD_TYPE_WINDOW_SQL)
def window_by_road_type(spark, sf_dir):
    enriched = enrich(_cleaned(spark, sf_dir), fx.segments(spark, sf_dir), "left", attrs=["frc"])
    return r6(W.by_road_type(enriched))


@register("sliding_two_stage", ROAD_TYPE_WINDOW_SQL)
def sliding_two_stage(spark, sf_dir):
    enriched = enrich(_cleaned(spark, sf_dir), fx.segments(spark, sf_dir), "left", attrs=["frc"])
    return r6(W.by_road_type_two_stage(enriched))


NETWORK_CORE = f"""
SELECT count(DISTINCT xd_id) AS total_segments,
       count(DISTINCT CASE WHEN congestion_score > 0.3e0 THEN xd_id END) AS congested_segments,
       {R6("CASE WHEN count(DISTINCT xd_id) > 0 THEN count(DISTINCT CASE WHEN congestion_score > 0.3e0 THEN xd_id END) / count(DISTINCT xd_id) * 100.0e0 END")} AS pct_congested,
       {WIN_COLS}
FROM win GROUP BY window_start"""
NETWORK_SQL = fx.with_views(NETWORK_CORE, extra=WINDOW_CTES)


@register("window_network_exact", NETWORK_SQL)
def window_network_exact(spark, sf_dir):
    return r6(W.network(_cleaned(spark, sf_dir), exact=True))


@register("window_network_two_stage", NETWORK_SQL)
def window_network_two_stage(spark, sf_dir):
    return r6(W.network_exact_two_stage(_cleaned(spark, sf_dir)))


def _within_bound(approx, exact):
    """Each window's exact counts, and whether the estimates are within five
    relative standard deviations (and one segment) of them."""
    def near(c):
        return F.abs(F.col(f"a.{c}") - F.col(f"e.{c}")) <= 1 + 5 * W.DEFAULT_RSD * F.col(f"e.{c}")
    both = exact.alias("e").join(approx.alias("a"), F.col("a.window_start") == F.col("e.window_start"), "full")
    return both.select(F.col("e.window_start").alias("window_start"), F.col("e.total_segments").alias("total_segments"),
                       F.col("e.congested_segments").alias("congested_segments"),
                       F.coalesce(near("total_segments") & near("congested_segments"), F.lit(False)).alias("within_bound"))


BOUND_SQL = ("SELECT window_start, total_segments, congested_segments, true AS within_bound "
             f"FROM ({NETWORK_CORE})")


@register("window_network_approx", fx.with_views(BOUND_SQL, extra=WINDOW_CTES))
def window_network_approx(spark, sf_dir):
    """HyperLogLog++ estimate (the live KPI) against the exact counts."""
    cleaned = _cleaned(spark, sf_dir)
    return _within_bound(W.network(cleaned, exact=False), W.network(cleaned, exact=True))


LATEST_SQL = fx.with_views(f"""
SELECT {SEG_WIN_SELECT} FROM (
  SELECT *, row_number() OVER (PARTITION BY xd_id ORDER BY window_start DESC) AS rn FROM seg_win_attr)
WHERE rn = 1""", extra=WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL)


@register("latest_per_segment", LATEST_SQL)
def latest_per_segment(spark, sf_dir):
    return r6(_latest_view(spark, sf_dir))


def _latest_view(spark, sf_dir):
    """Newest window per segment straight from the newest slot of each
    segment (no other window is built), lookup joined after."""
    return enrich(W.latest_window(_cleaned(spark, sf_dir)), fx.segments(spark, sf_dir), "left")


@register("latest_per_segment_all_windows", LATEST_SQL)
def latest_per_segment_all_windows(spark, sf_dir):
    """W1 as the snapshot sink runs it: every window per segment, then the
    newest one (``snapshot.latest``)."""
    wins = W.by_segment(_cleaned(spark, sf_dir))
    return r6(enrich(S.latest(wins), fx.segments(spark, sf_dir), "left"))


# ---------------------------------------------------------------------------
# Report tables
# ---------------------------------------------------------------------------

from ..operators import report as RP  # noqa: E402

MONTH_LABEL_SQL = ("CASE month WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr' "
                   "WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' "
                   "WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' WHEN 12 THEN 'Dec' END")


def _result_cte(kind: str, name: str = "res") -> str:
    expr, key = _KEY_SQL[kind]
    return f"""{name} AS (
  SELECT {Y} AS year, {M} AS month, {expr} AS {key},
         avg(speed) AS avg_speed, avg({SCORE_SQL}) AS avg_congestion_score
  FROM readings r JOIN segments s ON r.xd_id = s.xd GROUP BY ALL)"""


def _monthly_result(spark, sf_dir, kind, long):
    return H.mean_by(_enriched_inner(spark, sf_dir, long=long), kind, H.MONTHLY)


@register("month_pivot_direction", fx.with_views(f"""
SELECT year, month, {R6("avg(avg_speed) FILTER (WHERE direction = 'E')")} AS "E",
       {R6("avg(avg_speed) FILTER (WHERE direction = 'N')")} AS "N",
       {R6("avg(avg_speed) FILTER (WHERE direction = 'S')")} AS "S",
       {R6("avg(avg_speed) FILTER (WHERE direction = 'W')")} AS "W",
       {R6("avg(avg_speed) FILTER (WHERE direction IS NULL OR direction NOT IN ('E', 'N', 'S', 'W'))")} AS other,
       {MONTH_LABEL_SQL} AS month_label
FROM res GROUP BY year, month""", long=True, extra=_result_cte("by_direction")))
def month_pivot_direction(spark, sf_dir):
    res = _monthly_result(spark, sf_dir, "by_direction", long=True)
    return r6(RP.month_pivot(res, "direction", values=["E", "N", "S", "W"]))


@register("month_pivot_road_type", fx.with_views(f"""
SELECT year, month, {', '.join(f'{R6(f"avg(avg_speed) FILTER (WHERE road_type = {v})")} AS "{v}"' for v in (0, 1, 2, 3, 4, 5, 6))},
       CAST(NULL AS DOUBLE) AS other,
       {MONTH_LABEL_SQL} AS month_label
FROM res GROUP BY year, month""", long=True, extra=_result_cte("by_road_type")))
def month_pivot_road_type(spark, sf_dir):
    res = _monthly_result(spark, sf_dir, "by_road_type", long=True)
    return r6(RP.month_pivot(res, "road_type", values=[0, 1, 2, 3, 4, 5, 6]))


@register("month_cells_direction", fx.with_views(f"""
SELECT year, month, direction, {R6('avg(avg_speed)')} AS avg_speed FROM res GROUP BY ALL""",
                                                 long=True, extra=_result_cte("by_direction")))
def month_cells_direction(spark, sf_dir):
    """The long form of the pivot: every key in the data, NULL included."""
    return r6(RP.month_cells(_monthly_result(spark, sf_dir, "by_direction", long=True), "direction"))


@register("month_over_month", fx.with_views(f"""
SELECT c.year, c.month, {MONTH_LABEL_SQL.replace('month', 'c.month')} AS month_label,
       c.direction, {R6('c.avg_speed')} AS avg_speed, {R6('c.avg_speed - b.avg_speed')} AS mom_change
FROM cells c JOIN prev p ON c.year = p.year AND c.month = p.month
LEFT JOIN cells b ON b.year = c.year AND b.month = p.prev_month AND b.direction = c.direction""",
    long=True, extra=_result_cte("by_direction") + """,
cells AS (SELECT year, month, direction, avg(avg_speed) AS avg_speed FROM res GROUP BY ALL),
months AS (SELECT DISTINCT year, month FROM cells),
prev AS (SELECT year, month, lag(month) OVER (PARTITION BY year ORDER BY month) AS prev_month
         FROM months)"""))
def month_over_month(spark, sf_dir):
    res = _monthly_result(spark, sf_dir, "by_direction", long=True)
    return r6(RP.month_over_month(res, "direction"))


@register("hour_heatmap", fx.with_views(f"""
SELECT year, month, {MONTH_LABEL_SQL} AS month_label,
       {', '.join(f"{R6(f'avg(avg_congestion_score) FILTER (WHERE hour = {h})')} AS h{h:02d}" for h in range(24))}
FROM res GROUP BY year, month""", long=True, extra=_result_cte("by_hour")))
def hour_heatmap(spark, sf_dir):
    return r6(RP.hour_heatmap(_monthly_result(spark, sf_dir, "by_hour", long=True)))


@register("seasonality", fx.with_views(f"""
SELECT year, month, {MONTH_LABEL_SQL} AS month_label,
       CASE WHEN day_of_week IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       {R6('avg(avg_speed)')} AS avg_speed
FROM res GROUP BY ALL""", long=True, extra=_result_cte("by_day_of_week")))
def seasonality(spark, sf_dir):
    return r6(RP.seasonality(_monthly_result(spark, sf_dir, "by_day_of_week", long=True)))


@register("drilldown_hour", fx.with_views(f"""
SELECT year, hour, {R6('avg(avg_speed)')} AS avg_speed FROM res WHERE month = 1 AND hour IS NOT NULL GROUP BY ALL""",
                                          extra=_result_cte("by_hour")))
def drilldown_hour(spark, sf_dir):
    """Month drill-down (January: the month the readings cover)."""
    return r6(RP.drilldown(_monthly_result(spark, sf_dir, "by_hour", long=False), "hour", month=1))


@register("drilldown_day_of_week", fx.with_views(f"""
SELECT year, day_of_week, {R6('avg(avg_speed)')} AS avg_speed FROM res WHERE month = 3 GROUP BY ALL""",
                                                 long=True, extra=_result_cte("by_day_of_week")))
def drilldown_day_of_week(spark, sf_dir):
    return r6(RP.drilldown(_monthly_result(spark, sf_dir, "by_day_of_week", long=True), "day_of_week", month=3))


@register("drilldown_direction", fx.with_views(f"""
SELECT year, direction, {R6('avg(avg_speed)')} AS avg_speed FROM res WHERE direction IS NOT NULL GROUP BY ALL""",
                                               long=True, extra=_result_cte("by_direction")))
def drilldown_direction(spark, sf_dir):
    return r6(RP.drilldown(_monthly_result(spark, sf_dir, "by_direction", long=True), "direction"))


@register("top_table_month", fx.with_views(f"""
SELECT year, month, xd_id, road_name, bearing, frc, {R6('avg_congestion')} AS avg_congestion, {R6('avg_speed')} AS avg_speed
FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY avg_congestion DESC NULLS LAST, xd_id) AS rn2
      FROM (SELECT *, row_number() OVER (PARTITION BY year, month
                                         ORDER BY avg_congestion DESC NULLS LAST, xd_id) AS rn FROM seg_means)
      WHERE rn <= 20 AND month = 2) WHERE rn2 <= 20""", long=True, extra=_segment_means_sql()))
def top_table_month(spark, sf_dir):
    """The month's top-20 table."""
    means = H.segment_means(_scored(spark, sf_dir, long=True), fx.segments(spark, sf_dir), H.MONTHLY)
    return r6(RP.top_table(H.top_segments(means, 20, H.MONTHLY), month=2))


@register("drilldown_road_type", fx.with_views(f"""
SELECT year, road_type, {R6('avg(avg_speed)')} AS avg_speed FROM res WHERE road_type IS NOT NULL GROUP BY ALL""",
                                               long=True, extra=_result_cte("by_road_type")))
def drilldown_road_type(spark, sf_dir):
    """Year overview (no month selected) by road class."""
    return r6(RP.drilldown(_monthly_result(spark, sf_dir, "by_road_type", long=True), "road_type"))


@register("top_segments_year_summary", fx.with_views(f"""
SELECT year, xd_id, road_name, frc, {R6('avg_congestion')} AS avg_congestion, {R6('avg_speed')} AS avg_speed
FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY avg_congestion DESC NULLS LAST, xd_id) AS rn2
      FROM (SELECT year, xd_id, road_name, frc, avg(avg_congestion) AS avg_congestion, avg(avg_speed) AS avg_speed
            FROM (SELECT *, row_number() OVER (PARTITION BY year, month
                                                ORDER BY avg_congestion DESC NULLS LAST, xd_id) AS rn
                  FROM seg_means) WHERE rn <= 20
            GROUP BY ALL))
WHERE rn2 <= 20""", long=True, extra=_segment_means_sql()))
def top_segments_year_summary(spark, sf_dir):
    means = H.segment_means(_scored(spark, sf_dir, long=True), fx.segments(spark, sf_dir), H.MONTHLY)
    return r6(RP.year_summary(H.top_segments(means, 20, H.MONTHLY), 20))


# Snapshot views (over the latest window per segment)

SNAP_CTES = WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL + r""",
snap AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY xd_id ORDER BY window_start DESC) AS rn FROM seg_win_attr)
  WHERE rn = 1),
view AS (SELECT *,
  CASE WHEN regexp_replace(coalesce(road_name, ''), '^\s+|\s+$', '', 'g') <> ''
       THEN regexp_replace(coalesce(road_name, ''), '^\s+|\s+$', '', 'g')
       ELSE 'Segment ' || CAST(xd_id AS VARCHAR) END AS display_name,
  (start_lat + end_lat) / 2.0e0 AS mid_lat, (start_long + end_long) / 2.0e0 AS mid_long
  FROM snap)"""


def _snapshot_view(spark, sf_dir):
    return RP.with_display(_latest_view(spark, sf_dir))


@register("snapshot_display", fx.with_views(
    f"SELECT xd_id, display_name, {R6('mid_lat')} AS mid_lat, {R6('mid_long')} AS mid_long FROM view",
    extra=SNAP_CTES))
def snapshot_display(spark, sf_dir):
    return r6(_snapshot_view(spark, sf_dir).select("xd_id", "display_name", "mid_lat", "mid_long"))


@register("distinct_road_names", fx.with_views("SELECT DISTINCT display_name FROM view", extra=SNAP_CTES))
def distinct_road_names(spark, sf_dir):
    return RP.display_names(_snapshot_view(spark, sf_dir))


def _stats_sql(cond: str) -> str:
    return fx.with_views(f"""
SELECT count(*) AS total_segments, count(*) FILTER (WHERE {cond}) AS shown_segments,
       {R6(f'avg(avg_congestion) FILTER (WHERE {cond})')} AS avg_congestion,
       max(window_end) AS data_as_of, min(frc) AS frc_min, max(frc) AS frc_max,
       {R6(f'avg(mid_lat) FILTER (WHERE {cond})')} AS center_lat,
       {R6(f'avg(mid_long) FILTER (WHERE {cond})')} AS center_long
FROM view""", extra=SNAP_CTES)


@register("snapshot_stats", _stats_sql("frc IS NOT NULL"))
def snapshot_stats(spark, sf_dir):
    return r6(RP.snapshot_stats(_snapshot_view(spark, sf_dir)))


@register("snapshot_stats_filtered", _stats_sql("frc BETWEEN 2 AND 4"))
def snapshot_stats_filtered(spark, sf_dir):
    """Map filters applied: road classes 2 to 4."""
    return r6(RP.snapshot_stats(_snapshot_view(spark, sf_dir), frc_range=(2, 4)))


@register("snapshot_stats_named", _stats_sql("frc IS NOT NULL AND display_name = 'Segment 3'"))
def snapshot_stats_named(spark, sf_dir):
    """The optional display-name filter."""
    return r6(RP.snapshot_stats(_snapshot_view(spark, sf_dir), name="Segment 3"))


MAP_SQL = fx.with_views(f"""
SELECT xd_id,
  CASE WHEN avg_congestion IS NULL OR isnan(avg_congestion) THEN 'missing'
       WHEN avg_congestion < 0.15e0 THEN 'low' WHEN avg_congestion < 0.3e0 THEN 'moderate'
       ELSE 'high' END AS congestion_level,
  CASE WHEN avg_congestion IS NULL OR isnan(avg_congestion) THEN '#cccccc'
       WHEN avg_congestion < 0.15e0 THEN '#16a34a' WHEN avg_congestion < 0.3e0 THEN '#facc15'
       ELSE '#dc2626' END AS color,
  CASE frc WHEN 1 THEN 6 WHEN 2 THEN 5 WHEN 3 THEN 5 WHEN 4 THEN 4 WHEN 5 THEN 3 ELSE 4 END AS weight,
  {R6("start_long + CASE bearing WHEN 'E' THEN 0.00012e0 WHEN 'W' THEN -0.00012e0 ELSE 0.0e0 END")} AS lon0,
  {R6("start_lat + CASE bearing WHEN 'N' THEN -0.00012e0 WHEN 'S' THEN 0.00012e0 ELSE 0.0e0 END")} AS lat0,
  {R6("end_long + CASE bearing WHEN 'E' THEN 0.00012e0 WHEN 'W' THEN -0.00012e0 ELSE 0.0e0 END")} AS lon1,
  {R6("end_lat + CASE bearing WHEN 'N' THEN -0.00012e0 WHEN 'S' THEN 0.00012e0 ELSE 0.0e0 END")} AS lat1,
  display_name || ' · ' || coalesce(bearing, 'nan') || '-bound · Cong: ' ||
    CASE WHEN avg_congestion IS NULL OR isnan(avg_congestion) THEN 'nan'
         ELSE printf('%.2f', avg_congestion) END AS tooltip
FROM view WHERE frc IS NOT NULL""", extra=SNAP_CTES)


@register("map_features", MAP_SQL)
def map_features(spark, sf_dir):
    return r6(RP.map_features(_snapshot_view(spark, sf_dir)))


@register("map_geojson", MAP_SQL)
def map_geojson(spark, sf_dir):
    """The GeoJSON text of each feature, read again."""
    text = RP.map_features(_snapshot_view(spark, sf_dir), as_json=True)
    feature = ("type string, geometry struct<type: string, coordinates: array<array<double>>>, "
               "properties struct<color: string, weight: int, tooltip: string, congestion_level: string>")
    f = text.select("xd_id", F.from_json("feature", feature).alias("f"))
    at = lambda i, j: F.col("f.geometry.coordinates")[i][j]
    return r6(f.where("f.type = 'Feature' AND f.geometry.type = 'LineString'").select(
        "xd_id", "f.properties.congestion_level", "f.properties.color", "f.properties.weight", at(0, 0).alias("lon0"),
        at(0, 1).alias("lat0"), at(1, 0).alias("lon1"), at(1, 1).alias("lat1"), "f.properties.tooltip"))


# ---------------------------------------------------------------------------
# Message round trip; F14: non-finite -> NULL
# ---------------------------------------------------------------------------

from ..functions.scoring import null_out_non_finite  # noqa: E402
from ..operators import prepare as PP  # noqa: E402
from ..operators import replay as RY  # noqa: E402
from ..operators.transform import parse  # noqa: E402
from ..sources.writers import JSON_TIMES, to_json_records  # noqa: E402

READINGS_SELECT = (f"xd_id, measurement_tstamp, {R6('speed')} AS speed, "
                   f"{R6('reference_speed')} AS reference_speed, {R6('confidence_score')} AS confidence_score")


@register("parsed_messages", fx.with_views(
    f"SELECT CAST(xd_id AS VARCHAR) AS key, {READINGS_SELECT} FROM readings"))
def parsed_messages(spark, sf_dir):
    """Readings -> JSON messages -> parsed readings (must give the rows back)."""
    msgs = RY.to_messages(fx.readings(spark, sf_dir))
    p = parse(msgs, keep=("key",))
    return r6(p.select("key", "xd_id", F.col("event_time").cast("timestamp_ntz").alias("measurement_tstamp"),
                       "speed", "reference_speed", "confidence_score"))


NON_FINITE_SQL = """SELECT * REPLACE (CASE xd_id % 7 WHEN 1 THEN 'nan'::DOUBLE WHEN 2 THEN 'inf'::DOUBLE
  WHEN 3 THEN '-inf'::DOUBLE ELSE speed END AS speed) FROM readings"""


@register("null_out_non_finite", fx.with_views(f"""
SELECT xd_id, measurement_tstamp, {R6('speed')} AS speed, {R6('reference_speed')} AS reference_speed,
       {R6('confidence_score')} AS confidence_score,
       {R6('CASE WHEN isnan(x) OR isinf(x) THEN NULL ELSE x END')} AS congestion_score
FROM (SELECT * EXCLUDE (speed), CASE WHEN isnan(speed) OR isinf(speed) THEN NULL ELSE speed END AS speed,
        (reference_speed - speed) / NULLIF(reference_speed, 0) AS x FROM ({NON_FINITE_SQL}))"""))
def null_out_non_finite_q(spark, sf_dir):
    """NaN and both infinities among the speeds and the scores they give."""
    return r6(null_out_non_finite(score(_non_finite(spark, sf_dir))))


def _non_finite(spark, sf_dir):
    r = fx.readings(spark, sf_dir)
    odd = F.col("xd_id") % 7
    return r.withColumn("speed", F.when(odd == 1, F.lit(float("nan"))).when(odd == 2, F.lit(float("inf")))
                        .when(odd == 3, F.lit(float("-inf"))).otherwise(F.col("speed")))


@register("json_records", fx.with_views(f"""
SELECT xd_id, measurement_tstamp, {R6('speed')} AS speed, speed IS NULL AS speed_null FROM (
  SELECT xd_id, measurement_tstamp, CASE WHEN isnan(speed) OR isinf(speed) THEN NULL ELSE speed END AS speed
  FROM ({NON_FINITE_SQL}))"""))
def json_records(spark, sf_dir):
    """Records as JSON text, non-finite numbers as ``null`` (K9), read again."""
    text = to_json_records(_non_finite(spark, sf_dir).select("xd_id", "measurement_tstamp", "speed"))
    fields = "xd_id long, measurement_tstamp timestamp_ntz, speed double"
    read = text.select(F.from_json("json", fields, JSON_TIMES).alias("r"), F.col("json").contains('"speed":null').alias("speed_null"))
    return r6(read.select("r.*", "speed_null"))


# ---------------------------------------------------------------------------
# Replay slices and time ranges
# ---------------------------------------------------------------------------

REPLAY_START = "2024-01-01 00:05:00"


@register("replay_slices", fx.with_views(f"""
SELECT {READINGS_SELECT},
       greatest(time_bucket(INTERVAL '10 minutes', measurement_tstamp, TIMESTAMP '1970-01-01 00:00:00'),
                TIMESTAMP '{REPLAY_START}') AS slice_start,
       time_bucket(INTERVAL '10 minutes', measurement_tstamp, TIMESTAMP '1970-01-01 00:00:00')
         + INTERVAL '10 minutes' AS slice_end
FROM readings
WHERE measurement_tstamp BETWEEN TIMESTAMP '{REPLAY_START}' AND TIMESTAMP '2024-12-31 23:59:59'"""))
def replay_slices(spark, sf_dir):
    """Replay from 00:05 on the first day to the end of that year, 10-minute slices."""
    return r6(RY.slices(fx.readings(spark, sf_dir), REPLAY_START, None, 10))


@register("replay_slice_counts", fx.with_views(f"""
SELECT greatest(time_bucket(INTERVAL '10 minutes', measurement_tstamp, TIMESTAMP '1970-01-01 00:00:00'),
                TIMESTAMP '{REPLAY_START}') AS slice_start,
       time_bucket(INTERVAL '10 minutes', measurement_tstamp, TIMESTAMP '1970-01-01 00:00:00')
         + INTERVAL '10 minutes' AS slice_end,
       count(*) AS rows
FROM readings
WHERE measurement_tstamp BETWEEN TIMESTAMP '{REPLAY_START}' AND TIMESTAMP '2024-12-31 23:59:59'
GROUP BY ALL"""))
def replay_slice_counts(spark, sf_dir):
    """Rows per non-empty 10-minute slice of the replay (verbose replay report)."""
    return RY.slice_counts(fx.readings(spark, sf_dir), REPLAY_START, None, 10)


@register("time_range_clip", fx.with_views(f"""
SELECT {READINGS_SELECT}, {Y} AS year, {M} AS month FROM readings
WHERE measurement_tstamp >= TIMESTAMP '1996-03-15 00:00:00'
  AND measurement_tstamp < TIMESTAMP '1998-07-01 00:00:00'""", long=True))
def time_range_clip(spark, sf_dir):
    """Half-open range read with the derived year/month partition predicate."""
    df = PP.with_partitions(fx.readings_long(spark, sf_dir))
    return r6(RY.time_range(df, "1996-03-15", "1998-07-01"))


# ---------------------------------------------------------------------------
# preparation
# ---------------------------------------------------------------------------

HIST = ("1995-01-01", "1999-12-31")
REPLAY = ("2000-01-01", "2000-12-31")


def _between(b):
    return f"measurement_tstamp BETWEEN TIMESTAMP '{b[0]} 00:00:00' AND TIMESTAMP '{b[1]} 00:00:00'"


@register("date_split", fx.with_views(f"""
SELECT 'historical' AS split, {READINGS_SELECT} FROM readings WHERE {_between(HIST)}
UNION ALL
SELECT 'replay' AS split, {READINGS_SELECT} FROM readings WHERE {_between(REPLAY)}""", long=True))
def date_split(spark, sf_dir):
    parts = PP.date_split(fx.readings_long(spark, sf_dir), HIST, REPLAY)
    return r6(parts["historical"].select(F.lit("historical").alias("split"), "*")
              .unionByName(parts["replay"].select(F.lit("replay").alias("split"), "*")))


@register("ingest_counts", fx.with_views(f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE {_between(HIST)}) AS historical_rows,
       count(*) FILTER (WHERE {_between(REPLAY)}) AS replay_rows FROM readings""", long=True))
def ingest_counts(spark, sf_dir):
    return PP.ingest_counts(fx.readings_long(spark, sf_dir), HIST, REPLAY)


@register("union_raw", fx.with_views(f"""
SELECT {READINGS_SELECT}, {Y} AS year, {M} AS month FROM readings WHERE {_between(HIST)}
UNION ALL
SELECT {READINGS_SELECT}, {Y} AS year, {M} AS month FROM readings WHERE {_between(REPLAY)}""", long=True))
def union_raw(spark, sf_dir):
    parts = PP.date_split(fx.readings_long(spark, sf_dir), HIST, REPLAY)
    return r6(PP.union_raw(parts["historical"], parts["replay"]))


# ---------------------------------------------------------------------------
# S1/S4/K5/K6/F19, run_historical: job plans end to end (intermediate files
# go to the shared checkpoint folder)
# ---------------------------------------------------------------------------

from ..plans import batch as B  # noqa: E402
from ..plans import prepare as PR  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import readers as RD  # noqa: E402

_CSV_WRITE = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
              "quoteAll": "true", "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false"}


@register("csv_readings_roundtrip", fx.with_views(f"SELECT {READINGS_SELECT} FROM readings"))
def csv_readings_roundtrip(spark, sf_dir):
    """Readings written as CSV with extra columns in another order, read back
    by header name (S1)."""
    path = scratch_path(spark, "readings-csv")
    r = fx.readings(spark, sf_dir)
    (r.select(F.lit(0.5).alias("miles"), "confidence_score", "speed", "measurement_tstamp",
              F.lit("x").alias("zip"), "reference_speed", "xd_id")
     .write.options(**_CSV_WRITE).csv(path))
    return r6(RD.read_readings_csv(spark, path))


@register("csv_segments_roundtrip", fx.with_views(f"""
SELECT xd, road_name, frc, bearing, {R6('start_lat')} AS start_lat, {R6('start_long')} AS start_long,
       {R6('end_lat')} AS end_lat, {R6('end_long')} AS end_long FROM segments"""))
def csv_segments_roundtrip(spark, sf_dir):
    """Segment lookup as a headed CSV (original column names, extra columns,
    duplicated keys) read back by name and de-duplicated (S4, P1)."""
    path = scratch_path(spark, "segments-csv")
    s = fx.segments(spark, sf_dir)
    csv = s.select(F.lit(1.25).alias("miles"), F.col("road_name").alias("road-name"),
                   F.col("end_lat").alias("end_latitude"), F.col("start_lat").alias("start_latitude"),
                   F.col("start_long").alias("start_longitude"),
                   F.col("end_long").alias("end_longitude"), "bearing", "frc", "xd")
    # one exact repeat, and one row that differs and loses (its name sorts after)
    dup = csv.where(F.col("xd") == F.lit(1)).unionByName(
        csv.where(F.col("xd") == F.lit(2)).withColumn("road-name", F.concat("road-name", F.lit(" (later)"))))
    csv.unionByName(dup).write.options(**_CSV_WRITE).csv(path)
    return r6(RD.read_segments_csv(spark, path))


INGEST_HIST = ("1996-01-01", "1998-12-31")
INGEST_REPLAY = ("1999-01-01", "1999-06-30")


_job_runs: dict = {}


def _once(name):
    """Run a job once per session and folder; its queries read the outputs."""
    def deco(fn):
        def run(spark, sf_dir):
            key = (name, spark.sparkContext.applicationId, sf_dir)
            if key not in _job_runs:
                _job_runs[key] = fn(spark, sf_dir)
            return _job_runs[key]
        return run
    return deco


@_once("ingest")
def _ingested(spark, sf_dir):
    """readings_long -> CSV -> ingest (split, partitioned, float32) ->
    time-sorted compaction. Returns (counters, compacted historical root)."""
    csv = scratch_path(spark, "raw-csv")
    r = fx.readings_long(spark, sf_dir)
    r.select("speed", "xd_id", F.lit("county_a").alias("county"), "reference_speed",
             "measurement_tstamp", "confidence_score").write.options(**_CSV_WRITE).csv(csv)
    staged = scratch_path(spark, "staged")
    counters = PR.ingest(spark, csv, staged, INGEST_HIST, INGEST_REPLAY)
    compacted = scratch_path(spark, "raw")
    PR.compact_raw(spark, f"{staged}/split=historical", compacted, max_records_per_file=20_000)
    return counters, compacted


F32 = "CAST(CAST({c} AS FLOAT) AS DOUBLE)"


@register("ingest_compacted", fx.with_views(f"""
SELECT xd_id, measurement_tstamp, {R6(F32.format(c='speed'))} AS speed,
       {R6(F32.format(c='reference_speed'))} AS reference_speed,
       {R6(F32.format(c='confidence_score'))} AS confidence_score, {Y} AS year, {M} AS month
FROM readings WHERE {_between(INGEST_HIST)}""", long=True))
def ingest_compacted(spark, sf_dir):
    _, root = _ingested(spark, sf_dir)
    return r6(RD.read_readings(spark, root))


@_once("historical")
def _historical_job(spark, sf_dir):
    _, raw = _ingested(spark, sf_dir)
    out = scratch_path(spark, "historical")
    B.run_historical(spark, raw, fx.segments(spark, sf_dir), out)
    return out


STORED_SQL = f"""(SELECT xd_id, measurement_tstamp, {F32.format(c='speed')} AS speed,
  {F32.format(c='reference_speed')} AS reference_speed FROM readings WHERE {_between(INGEST_HIST)})"""


@register("historical_job_means", fx.with_views("\nUNION ALL\n".join(f"""
SELECT '{k}' AS kind, {Y} AS year, {M} AS month, CAST({_KEY_SQL[k][0]} AS VARCHAR) AS key, {R6('avg(speed)')} AS avg_speed,
  {R6(f'avg({SCORE_SQL})')} AS avg_congestion_score
FROM {STORED_SQL} r JOIN segments s ON r.xd_id = s.xd GROUP BY ALL""" for k in H.MEAN_KINDS), long=True))
def historical_job_means(spark, sf_dir):
    """The four means of the historical job, all years and months."""
    out, parts = _historical_job(spark, sf_dir), None
    for kind in H.MEAN_KINDS:
        one = spark.read.parquet(f"{out}/{kind}").select(
            F.lit(kind).alias("kind"), "year", "month", F.col(_KEY_SQL[kind][1]).cast("string").alias("key"), "avg_speed",
            "avg_congestion_score")
        parts = one if parts is None else parts.unionByName(one)
    return r6(parts)


@register("historical_job_month", fx.with_views(f"""
SELECT {Y} AS year, {M} AS month, {HOUR} AS hour, {R6('avg(speed)')} AS avg_speed, {R6(f'avg({SCORE_SQL})')} AS avg_congestion_score
FROM {STORED_SQL} r JOIN segments s ON r.xd_id = s.xd
WHERE year(measurement_tstamp) = 1997 AND month(measurement_tstamp) IN (2, 5) GROUP BY ALL""", long=True))
def historical_job_month(spark, sf_dir):
    """The job over two months of a year (partition-pruned input)."""
    _, raw = _ingested(spark, sf_dir)
    out = scratch_path(spark, "historical-month")
    B.run_historical(spark, raw, fx.segments(spark, sf_dir), out, year=1997, months=[2, 5])
    return r6(RD.read_historical(spark, out, "by_hour", 1997).select("year", "month", "hour", "avg_speed",
                                                                     "avg_congestion_score"))


@register("ingest_job_counters", fx.with_views(f"""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE {_between(INGEST_HIST)}) AS historical_rows,
       count(*) FILTER (WHERE {_between(INGEST_REPLAY)}) AS replay_rows FROM readings""", long=True))
def ingest_job_counters(spark, sf_dir):
    """The counters the ingest job observed."""
    counters, _ = _ingested(spark, sf_dir)
    return spark.createDataFrame([(counters["total_rows"], counters["historical_rows"], counters["replay_rows"])],
                                 "total_rows long, historical_rows long, replay_rows long")


@register("ingest_rerun", fx.with_views("\nUNION ALL\n".join(f"""
SELECT '{name}' AS split, xd_id, measurement_tstamp, {R6(F32.format(c='speed'))} AS speed, {Y} AS year, {M} AS month
FROM readings WHERE {_between(b)}""" for name, b in (("historical", ("1996-01-01", "1996-03-31")), ("replay", INGEST_REPLAY))),
    long=True))
def ingest_rerun(spark, sf_dir):
    """Ingest again with a narrower range into the same root: nothing of the
    first run stays."""
    csv, root = scratch_path(spark, "rerun-csv"), scratch_path(spark, "rerun")
    fx.readings_long(spark, sf_dir).write.options(**_CSV_WRITE).csv(csv)
    PR.ingest(spark, csv, root, INGEST_HIST, INGEST_REPLAY)
    PR.ingest(spark, csv, root, ("1996-01-01", "1996-03-31"), INGEST_REPLAY)
    return r6(spark.read.parquet(root).select("split", "xd_id", "measurement_tstamp", F.col("speed").cast("double").alias("speed"),
                                              "year", "month"))


@register("historical_job_top_segments", fx.with_views(f"""
SELECT year, month, xd_id, road_name, bearing, frc,
       {R6('avg_congestion')} AS avg_congestion, {R6('avg_speed')} AS avg_speed
FROM (SELECT *, row_number() OVER (PARTITION BY year, month
                                   ORDER BY avg_congestion DESC NULLS LAST, xd_id) AS rn
      FROM seg_means) WHERE rn <= 20 AND year = 1997""", long=True, extra=f"""seg_means AS (
  SELECT {Y} AS year, {M} AS month, r.xd_id, s.road_name, s.bearing, s.frc,
         avg({SCORE_SQL}) AS avg_congestion, avg(speed) AS avg_speed
  FROM (SELECT xd_id, measurement_tstamp, {F32.format(c='speed')} AS speed,
               {F32.format(c='reference_speed')} AS reference_speed FROM readings
        WHERE {_between(INGEST_HIST)}) r JOIN segments s ON r.xd_id = s.xd
  GROUP BY ALL)"""))
def historical_job_top_segments(spark, sf_dir):
    """CSV -> ingest -> compaction -> historical job (one scan, five results)
    -> read back the 1997 worst segments."""
    return r6(RD.read_historical(spark, _historical_job(spark, sf_dir), "top_segments", 1997)
              .select("year", "month", "xd_id", "road_name", "bearing", "frc", "avg_congestion",
                      "avg_speed"))


@register("historical_job_by_hour_compacted", fx.with_views(f"""
SELECT {HOUR} AS hour, {R6('avg(speed)')} AS avg_speed, {R6(f'avg({SCORE_SQL})')} AS avg_congestion_score,
       {Y} AS year, {M} AS month
FROM (SELECT xd_id, measurement_tstamp, {F32.format(c='speed')} AS speed,
             {F32.format(c='reference_speed')} AS reference_speed FROM readings
      WHERE {_between(INGEST_HIST)}) r JOIN segments s ON r.xd_id = s.xd
WHERE year(measurement_tstamp) = 1998
GROUP BY ALL""", long=True))
def historical_job_by_hour_compacted(spark, sf_dir):
    """Historical job, then the yearly compaction to a separate root (K7),
    read back for 1998 (S11)."""
    out = _historical_job(spark, sf_dir)
    compacted = scratch_path(spark, "historical-compacted")
    B.compact_results(spark, out, compacted, 1998, kinds=["by_hour"])
    return r6(RD.read_historical(spark, compacted, "by_hour", 1998))


# ---------------------------------------------------------------------------
# The live pipeline on Structured Streaming. The readings
# are replayed as JSON-line files (the Kafka value), the four queries run
# with an availableNow trigger, and the sinks are read back. Append mode
# emits only windows closed by the final watermark (newest cleaned reading
# minus 10 minutes); the snapshot of the single data batch is the newest
# window per segment.
# ---------------------------------------------------------------------------

from ..operators.replay import to_messages, write_message_slices  # noqa: E402
from ..streaming import live as LV  # noqa: E402

_stream_runs: dict = {}


def _live_run(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stream_runs:
        src = scratch_path(spark, "live-in")
        to_messages(fx.readings(spark, sf_dir)).select("value").write.text(src)
        out, ck = scratch_path(spark, "live-out"), scratch_path(spark, "live-ckpt")
        qs = LV.start_all(spark, LV.file_stream(spark, src), fx.segments(spark, sf_dir), out, ck,
                          available_now=True)
        for q in qs:
            q.awaitTermination()
        _stream_runs[key] = out
    return _stream_runs[key]


def _ntz_windows(df: DataFrame) -> DataFrame:
    return (df.drop("written_at")
            .withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
            .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


CLOSED = "window_end <= (SELECT max(measurement_tstamp) FROM cleaned) - INTERVAL '10 minutes'"


@register("stream_by_segment", fx.with_views(
    f"SELECT {SEG_WIN_SELECT} FROM seg_win_attr WHERE {CLOSED}",
    extra=WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL))
def stream_by_segment(spark, sf_dir):
    out = _live_run(spark, sf_dir)
    return r6(_ntz_windows(SH.read_result(spark, out, "by_segment")))


@register("stream_by_road_type", fx.with_views(f"""
SELECT * FROM (
  SELECT s.frc, {R6('avg(speed)')} AS avg_speed, {R6('avg(congestion_score)')} AS avg_congestion,
         count(*) AS reading_count, {WIN_COLS}
  FROM win LEFT JOIN segments s ON win.xd_id = s.xd
  GROUP BY s.frc, window_start)
WHERE {CLOSED}""", extra=WINDOW_CTES))
def stream_by_road_type(spark, sf_dir):
    out = _live_run(spark, sf_dir)
    return r6(_ntz_windows(SH.read_result(spark, out, "by_road_type")))


@register("stream_network_approx", fx.with_views(f"{BOUND_SQL} WHERE {CLOSED}", extra=WINDOW_CTES))
def stream_network_approx(spark, sf_dir):
    """HyperLogLog++ KPI of the live pipeline against the exact counts of the
    shared pipeline."""
    out = _live_run(spark, sf_dir)
    approx = _ntz_windows(SH.read_result(spark, out, "network"))
    return _within_bound(approx, _ntz_windows(SH.read_result(spark, _shared_run(spark, sf_dir), "network")))


@_once("replay")
def _replay_run(spark, sf_dir) -> str:
    """Readings replayed as ordered day slices, a few files per micro-batch."""
    src = scratch_path(spark, "replay-in")
    write_message_slices(fx.readings(spark, sf_dir), src, "2024-01-01", minutes=1440)
    out, ck = scratch_path(spark, "replay-out"), scratch_path(spark, "replay-ckpt")
    segments = LV.static_lookup(fx.segments(spark, sf_dir))
    frames = LV.live_frames(LV.file_stream(spark, src, max_files_per_trigger=4), segments)
    qs = [LV.start_append(frames["by_road_type"], f"{out}/by_road_type", f"{ck}/by_road_type", available_now=True),
          LV.start_snapshot(frames["by_segment_keys"], f"{out}/snapshot", f"{ck}/snapshot", available_now=True,
                            carry_forward=True, segments=segments)]
    for q in qs:
        q.awaitTermination()
    return out


@register("stream_replay_append", fx.with_views(f"""
SELECT * FROM (
  SELECT s.frc, {R6('avg(speed)')} AS avg_speed, {R6('avg(congestion_score)')} AS avg_congestion,
         count(*) AS reading_count, {WIN_COLS}
  FROM win LEFT JOIN segments s ON win.xd_id = s.xd
  GROUP BY s.frc, window_start)
WHERE {CLOSED}""", extra=WINDOW_CTES))
def stream_replay_append(spark, sf_dir):
    """Written slices, streamed in order over several micro-batches: no reading
    is late, all closed windows are complete."""
    return r6(_ntz_windows(LV.read_appended(spark, f"{_replay_run(spark, sf_dir)}/by_road_type")))


@register("stream_replay_snapshot", LATEST_SQL)
def stream_replay_snapshot(spark, sf_dir):
    """The carried-forward snapshot after many micro-batches."""
    return r6(_ntz_windows(RD.read_snapshot(spark, f"{_replay_run(spark, sf_dir)}/snapshot")))


@register("stream_latest_snapshot", fx.with_views(f"""
SELECT {SEG_WIN_SELECT} FROM (
  SELECT *, row_number() OVER (PARTITION BY xd_id ORDER BY window_start DESC) AS rn FROM seg_win_attr)
WHERE rn = 1""", extra=WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL))
def stream_latest_snapshot(spark, sf_dir):
    out = _live_run(spark, sf_dir)
    return r6(_ntz_windows(RD.read_snapshot(spark, f"{out}/{LV.OUTPUTS['snapshot']}")))


RESET = "TIMESTAMP '2024-01-15 00:00:00'"


@register("stream_two_runs", fx.with_views(f"""
SELECT {SEG_WIN_SELECT} FROM (
  SELECT xd_id, measurement_tstamp >= {RESET} AS later, avg(speed) AS avg_speed, avg(congestion_score) AS avg_congestion,
         count(*) AS reading_count, {WIN_COLS}
  FROM win GROUP BY xd_id, later, window_start) w LEFT JOIN segments s ON w.xd_id = s.xd
WHERE window_end <= (SELECT max(measurement_tstamp) FROM cleaned c WHERE (c.measurement_tstamp >= {RESET}) = w.later)
  - INTERVAL '10 minutes'""", extra=WINDOW_CTES))
def stream_two_runs(spark, sf_dir):
    """Two live runs with a fresh checkpoint each over one output, the days
    before the 15th and the rest: the windows of both are there."""
    out = scratch_path(spark, "two-runs")
    segments = LV.static_lookup(fx.segments(spark, sf_dir))
    for part in (f"measurement_tstamp < {RESET}", f"measurement_tstamp >= {RESET}"):
        src = scratch_path(spark, "two-runs-in")
        to_messages(fx.readings(spark, sf_dir).where(part)).select("value").write.text(src)
        frames = LV.live_frames(LV.file_stream(spark, src), segments)
        LV.start_append(frames["by_segment"], out, scratch_path(spark, "two-runs-ckpt"), available_now=True).awaitTermination()
    return r6(_ntz_windows(LV.read_appended(spark, out)))


# The same three results from the shared-state pipeline (one append query
# for all three, exact network KPI).

from ..streaming import shared as SH  # noqa: E402

_shared_runs: dict = {}


def _shared_run(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _shared_runs:
        src = scratch_path(spark, "shared-in")
        to_messages(fx.readings(spark, sf_dir)).select("value").write.text(src)
        out, ck = scratch_path(spark, "shared-out"), scratch_path(spark, "shared-ckpt")
        qs = SH.start_shared(spark, LV.file_stream(spark, src), fx.segments(spark, sf_dir), out, ck,
                             available_now=True)
        for q in qs:
            q.awaitTermination()
        _shared_runs[key] = out
    return _shared_runs[key]


@register("stream_shared_by_segment", fx.with_views(
    f"SELECT {SEG_WIN_SELECT} FROM seg_win_attr WHERE {CLOSED}",
    extra=WINDOW_CTES + ",\n" + SEG_WINDOWS_SQL))
def stream_shared_by_segment(spark, sf_dir):
    return r6(_ntz_windows(SH.read_result(spark, _shared_run(spark, sf_dir), "by_segment")))


@register("stream_shared_by_road_type", fx.with_views(f"""
SELECT * FROM (
  SELECT s.frc, {R6('avg(speed)')} AS avg_speed, {R6('avg(congestion_score)')} AS avg_congestion,
         count(*) AS reading_count, {WIN_COLS}
  FROM win LEFT JOIN segments s ON win.xd_id = s.xd
  GROUP BY s.frc, window_start)
WHERE {CLOSED}""", extra=WINDOW_CTES))
def stream_shared_by_road_type(spark, sf_dir):
    return r6(_ntz_windows(SH.read_result(spark, _shared_run(spark, sf_dir), "by_road_type")))


@register("stream_shared_network", fx.with_views(
    f"SELECT * FROM ({NETWORK_CORE}) WHERE {CLOSED}", extra=WINDOW_CTES))
def stream_shared_network(spark, sf_dir):
    """Exact network KPI of the shared-state pipeline."""
    return r6(_ntz_windows(SH.read_result(spark, _shared_run(spark, sf_dir), "network")))


@register("historical_four_scans", _all_means_sql())
def historical_four_scans(spark, sf_dir):
    """Plain form of ``historical_cube``: four separate aggregations (bench
    comparison)."""
    return r6(H.all_means_plain(_enriched_inner(spark, sf_dir), H.MONTHLY))


from . import catalog_increments  # noqa: E402, F401  (registers its queries)
