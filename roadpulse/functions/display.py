"""Presentation expressions of the serving layer, as native Column logic
(names, labels, colours, line weights, map geometry)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical output)
# ---------------------------------------------------------------------------
MONTH_LABELS = {1: "Jan", 2: "Feb", 3: "Mar", 4: "Apr", 5: "May", 6: "Jun",
                7: "Jul", 8: "Aug", 9: "Sep", 10: "Oct", 11: "Nov", 12: "Dec"}
WEEKEND_DAYS = (1, 7)  # dayofweek: 1 = Sunday, 7 = Saturday
COLOR_MISSING = "#cccccc"
COLOR_LOW = "#16a34a"
COLOR_MODERATE = "#facc15"
COLOR_HIGH = "#dc2626"
LOW_BELOW = 0.15
MODERATE_BELOW = 0.3
FRC_WEIGHT = {1: 6, 2: 5, 3: 5, 4: 4, 5: 3}
FRC_WEIGHT_DEFAULT = 4
BEARING_OFFSET_DEG = 0.00012
# bearing -> (dlat, dlon)
BEARING_OFFSET = {
    "N": (-BEARING_OFFSET_DEG, 0.0),
    "S": (BEARING_OFFSET_DEG, 0.0),
    "E": (0.0, BEARING_OFFSET_DEG),
    "W": (0.0, -BEARING_OFFSET_DEG),
    "?": (0.0, 0.0),
}


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(mapping: dict, key: Column) -> Column:
    """Small constant map lookup as a CASE chain (stays in codegen)."""
    out = None
    for k, v in mapping.items():
        out = (F.when(key == F.lit(k), F.lit(v)) if out is None
               else out.when(key == F.lit(k), F.lit(v)))
    return out


def month_label(month: str | Column = "month") -> Column:
    return _lookup(MONTH_LABELS, _c(month))


def day_type(day_of_week: str | Column = "day_of_week") -> Column:
    return F.when(_c(day_of_week).isin(*WEEKEND_DAYS), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def strip(c: str | Column) -> Column:
    """Python ``str.strip()``: leading/trailing whitespace of any kind."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def display_name(road_name: str | Column = "road_name", xd_id: str | Column = "xd_id") -> Column:
    """Trimmed road name, else ``Segment <id>``."""
    name = strip(F.coalesce(_c(road_name), F.lit("")))
    return F.when(name != F.lit(""), name).otherwise(
        F.concat(F.lit("Segment "), _c(xd_id).cast("string")))


def midpoint(a: str | Column, b: str | Column) -> Column:
    return (_c(a) + _c(b)) / F.lit(2.0)


def congestion_level(score: str | Column = "avg_congestion") -> Column:
    s = _c(score)
    return (F.when(s.isNull() | F.isnan(s), F.lit("missing"))
            .when(s < F.lit(LOW_BELOW), F.lit("low"))
            .when(s < F.lit(MODERATE_BELOW), F.lit("moderate"))
            .otherwise(F.lit("high")))


def congestion_color(score: str | Column = "avg_congestion") -> Column:
    s = _c(score)
    return (F.when(s.isNull() | F.isnan(s), F.lit(COLOR_MISSING))
            .when(s < F.lit(LOW_BELOW), F.lit(COLOR_LOW))
            .when(s < F.lit(MODERATE_BELOW), F.lit(COLOR_MODERATE))
            .otherwise(F.lit(COLOR_HIGH)))


def frc_weight(frc: str | Column = "frc") -> Column:
    return F.coalesce(_lookup(FRC_WEIGHT, _c(frc)), F.lit(FRC_WEIGHT_DEFAULT))


def bearing_offsets(bearing: str | Column = "bearing") -> tuple[Column, Column]:
    """(dlat, dlon) for a bearing; (0, 0) when unknown."""
    b = _c(bearing)
    dlat = F.coalesce(_lookup({k: v[0] for k, v in BEARING_OFFSET.items()}, b), F.lit(0.0))
    dlon = F.coalesce(_lookup({k: v[1] for k, v in BEARING_OFFSET.items()}, b), F.lit(0.0))
    return dlat, dlon


def format_2f(x: str | Column) -> Column:
    """``f"{x:.2f}"``: correctly rounded on the binary value (DecimalFormat,
    half-even), ``nan`` for NULL/NaN like pandas would print."""
    x = _c(x)
    return F.when(x.isNull() | F.isnan(x), F.lit("nan")).otherwise(F.call_function("format_number", x, F.lit("0.00")))


def tooltip(name: str | Column, bearing: str | Column, score: str | Column) -> Column:
    """``"<name> · <bearing>-bound · Cong: <score:.2f>"``."""
    return F.concat(_c(name), F.lit(" · "), F.coalesce(_c(bearing), F.lit("nan")),
                    F.lit("-bound · Cong: "), format_2f(score))
