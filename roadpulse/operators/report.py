"""Report tables built from the historical results and the live snapshot:
month pivots, month-over-month changes, the hour heatmap, weekend/weekday
seasonality, month drill-downs, the year summary of worst segments, and the
map / filter / statistics views of the snapshot.

All of them are DataFrame -> DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import display as D
from .historical import rank_order

HOURS = list(range(24))
PERIOD = ("year", "month")


def month_pivot(results: DataFrame, key: str, value: str = "avg_speed",
                values: Sequence | None = None, period: Sequence[str] = PERIOD) -> DataFrame:
    """Month x key matrix of the (unweighted) mean of ``value``, plus
    ``month_label``. One column per key value found in the results (a NULL key
    is none, as in the dashboard's table). With explicit ``values`` (a stable
    schema) these have a column each, and the mean of all other keys, NULL
    included, stands in ``other``: nothing is left out."""
    if values is None:
        out = results.where(F.col(key).isNotNull()).groupBy(*period).pivot(key).agg(F.avg(value))
    else:
        listed = F.coalesce(F.col(key).isin(list(values)), F.lit(False))
        out = results.groupBy(*period).agg(
            *[F.avg(F.when(F.col(key) == F.lit(v), F.col(value))).alias(str(v)) for v in values],
            F.avg(F.when(~listed, F.col(value))).alias("other"))
    return out.withColumn("month_label", D.month_label("month"))


def month_cells(results: DataFrame, key: str, value: str = "avg_speed",
                period: Sequence[str] = PERIOD) -> DataFrame:
    """The long form of ``month_pivot``: one row per (period, key)."""
    return results.groupBy(*period, key).agg(F.avg(value).alias(value))


def month_over_month(results: DataFrame, key: str, value: str = "avg_speed") -> DataFrame:
    """Change of each pivot cell against the previous month *row* of the same
    year's pivot (the previous month of that year present in the data for any
    key); NULL for the first month of a year, for a NULL key and when the key
    has no value in the previous month. Each year is its own table, as in the
    dashboard, which loads one year at a time.

    One pass over the cells: the months of a year are ranked, then each
    key's previous cell counts only if it sits in the previous ranked month.
    The cells are shuffled once, by year (a year holds at most 12 x key
    domain cells, the size of its pivot), and the per-key window reuses that
    partitioning.
    """
    cells = month_cells(results, key, value)
    rank = F.dense_rank().over(Window.partitionBy("year").orderBy("month"))
    per_key = Window.partitionBy("year", key).orderBy("month")
    ranked = cells.withColumn("_r", rank)
    prev_ok = F.col(key).isNotNull() & (F.lag("_r").over(per_key) == F.col("_r") - F.lit(1))
    change = F.when(prev_ok, F.col(value) - F.lag(value).over(per_key))
    return ranked.select("year", "month", D.month_label("month").alias("month_label"), key, value,
                         change.alias("mom_change"))


def hour_heatmap(by_hour: DataFrame, value: str = "avg_congestion_score",
                 period: Sequence[str] = PERIOD) -> DataFrame:
    """Month x hour matrix with all 24 hour columns ``h00`` .. ``h23``
    (NULL where an hour has no data)."""
    piv = by_hour.groupBy(*period).pivot("hour", HOURS).agg(F.avg(value))
    return piv.select(*period, D.month_label("month").alias("month_label"),
                      *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])


def seasonality(by_day_of_week: DataFrame, value: str = "avg_speed",
                period: Sequence[str] = PERIOD) -> DataFrame:
    """Weekend vs weekday mean per month (unweighted over the weekdays)."""
    return (by_day_of_week.groupBy(*period, D.month_label("month").alias("month_label"),
                                   D.day_type("day_of_week").alias("day_type"))
            .agg(F.avg(value).alias(value)))


def drilldown(results: DataFrame, key: str, month: int | None = None,
              value: str = "avg_speed") -> DataFrame:
    """Mean of ``value`` per key over the months of each year, optionally for
    one month only (1-12). A NULL key (e.g. a segment without road class) is
    not a group of its own here, as in the dashboard's grouping."""
    df = results.where(F.col(key).isNotNull())
    if month is not None:
        if not 1 <= int(month) <= 12:
            raise ValueError("month must be in 1..12")
        df = df.where(F.col("month") == F.lit(int(month)))
    return df.groupBy("year", key).agg(F.avg(value).alias(value))


def year_summary(top_monthly: DataFrame, k: int = 20) -> DataFrame:
    """Per year: mean of each segment's monthly top-k entries (only the
    months it made the list), then the top ``k`` of those. Segments without a
    road name stay in (the dashboard's pandas grouping would silently drop
    them)."""
    means = (top_monthly.groupBy("year", "xd_id", "road_name", "frc")
             .agg(F.avg("avg_congestion").alias("avg_congestion"),
                  F.avg("avg_speed").alias("avg_speed")))
    w = Window.partitionBy("year").orderBy(*rank_order())
    return means.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def top_table(top_monthly: DataFrame, month: int | None = None, k: int = 20) -> DataFrame:
    """Display subset of the monthly worst segments, optionally one month."""
    df = top_monthly if month is None else top_monthly.where(F.col("month") == F.lit(int(month)))
    cols = ["year", "month", "xd_id", "road_name", "bearing", "frc", "avg_congestion", "avg_speed"]
    w = Window.partitionBy("year").orderBy(*rank_order())
    return (df.select(*cols).withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= k).drop("_rn"))


# ---------------------------------------------------------------------------
# Snapshot views
# ---------------------------------------------------------------------------

def with_display(snapshot: DataFrame) -> DataFrame:
    """Add ``display_name``, ``mid_lat``, ``mid_long``."""
    return snapshot.select(
        "*", D.display_name("road_name", "xd_id").alias("display_name"),
        D.midpoint("start_lat", "end_lat").alias("mid_lat"),
        D.midpoint("start_long", "end_long").alias("mid_long"))


def segment_filter(frc_range: tuple[int, int] | None = None, name: str | None = None):
    """Predicate of the map filters: ``frc`` in the inclusive range (default:
    the full range of the data, i.e. any non-NULL class) and an optional
    display name."""
    cond = (F.col("frc").isNotNull() if frc_range is None
            else F.col("frc").between(int(frc_range[0]), int(frc_range[1])))
    if name is not None:
        cond = cond & (F.col("display_name") == F.lit(name))
    return cond


def filter_segments(view: DataFrame, frc_range=None, name=None) -> DataFrame:
    return view.where(segment_filter(frc_range, name))


def snapshot_stats(view: DataFrame, frc_range=None, name=None) -> DataFrame:
    """One row: segments in the snapshot, segments shown by the filters, mean
    congestion and map centre of the shown ones, newest ``window_end``, and
    the ``frc`` range of the data."""
    keep = segment_filter(frc_range, name)
    return view.agg(
        F.count(F.lit(1)).alias("total_segments"),
        F.count_if(keep).alias("shown_segments"),
        F.avg(F.when(keep, F.col("avg_congestion"))).alias("avg_congestion"),
        F.max("window_end").alias("data_as_of"),
        F.min("frc").alias("frc_min"), F.max("frc").alias("frc_max"),
        F.avg(F.when(keep, F.col("mid_lat"))).alias("center_lat"),
        F.avg(F.when(keep, F.col("mid_long"))).alias("center_long"))


def display_names(view: DataFrame) -> DataFrame:
    """Distinct display names (sort at the reader: ``orderBy`` on a tiny frame)."""
    return view.select("display_name").distinct()


def map_features(view: DataFrame, frc_range=None, name=None, as_json: bool = False) -> DataFrame:
    """One LineString feature per shown segment: end points shifted by the
    bearing offset, colour by congestion level, line weight by road class and
    a tooltip. With ``as_json`` each row is one GeoJSON Feature text (a
    consumer wraps the rows in a FeatureCollection; the collection is never
    assembled in one task)."""
    dlat, dlon = D.bearing_offsets("bearing")
    f = filter_segments(view, frc_range, name).select(
        "xd_id",
        D.congestion_level("avg_congestion").alias("congestion_level"),
        D.congestion_color("avg_congestion").alias("color"),
        D.frc_weight("frc").alias("weight"),
        (F.col("start_long") + dlon).alias("lon0"), (F.col("start_lat") + dlat).alias("lat0"),
        (F.col("end_long") + dlon).alias("lon1"), (F.col("end_lat") + dlat).alias("lat1"),
        D.tooltip("display_name", "bearing", "avg_congestion").alias("tooltip"))
    if not as_json:
        return f
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("LineString").alias("type"),
                 F.array(F.array("lon0", "lat0"), F.array("lon1", "lat1")).alias("coordinates"))
        .alias("geometry"),
        F.struct("color", "weight", "tooltip", "congestion_level").alias("properties"))
    return f.select("xd_id", F.to_json(feature).alias("feature"))
