"""Row-level transforms: parse messages, clean, score, enrich with the lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions.scoring import congestion_score, nan_to_null
from ..schemas import MEASURES, MESSAGE, SEGMENT_ATTRS

# The live filter threshold of the reference (``confidence_score >= 20``).
DEFAULT_MIN_CONFIDENCE = 20.0
# Largest lookup we hint as broadcast, in measured bytes of the columns
# carried. A road network has at
# most a few million segments, a few tens of MB; beyond the limit the join is
# left to Spark (sort-merge, or an AQE runtime switch) and callers aggregate
# before joining.
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024
# The same for a join that every micro-batch repeats: a broadcast passes
# through the driver each time.
STREAM_MAX_BROADCAST_BYTES = 2 * 1024 * 1024
# Bytes of a fixed-width value, and of a row besides its values.
_WIDTH = {"bigint": 8, "int": 4, "double": 8, "float": 4, "boolean": 1,
          "timestamp": 8, "timestamp_ntz": 8, "date": 4}
_ROW_BYTES = 16


def parse(raw: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode JSON messages (``value`` as bytes or text) into reading columns.

    Malformed JSON gives an all-NULL row (PERMISSIVE), a bad timestamp a NULL
    ``event_time``; the token ``NaN`` becomes NULL. ``event_time`` is a
    TIMESTAMP (watermarks need it), ``measurement_tstamp`` stays the text.
    ``keep`` names source columns carried along (e.g. ``key``).
    """
    value = F.col(value_col)
    if isinstance(raw.schema[value_col].dataType, BinaryType):
        value = value.cast("string")
    data = F.from_json(value, MESSAGE, {"mode": "PERMISSIVE", "allowNonNumericNumbers": "true"})
    parsed = raw.select(*keep, data.alias("data")).select(*keep, "data.*")
    return parsed.select(
        *keep, "xd_id", "measurement_tstamp",
        *[nan_to_null(m).alias(m) for m in MEASURES],
        F.try_to_timestamp(F.col("measurement_tstamp")).alias("event_time"),
    )


def score(df: DataFrame) -> DataFrame:
    """Add ``congestion_score``; NULL when the reference speed is 0 or NULL
    (the historical path: no filtering)."""
    return df.withColumn("congestion_score", congestion_score("speed", "reference_speed"))


def clean(df: DataFrame, min_confidence: float | None = DEFAULT_MIN_CONFIDENCE) -> DataFrame:
    """The live quality filter plus the score.

    Keeps rows with ``confidence_score >= min_confidence`` (skipped when
    ``None``), non-NULL speed and reference speed, and reference speed > 0.
    """
    out = df
    if min_confidence is not None:
        out = out.where(F.col("confidence_score") >= F.lit(float(min_confidence)))
    out = out.where(F.col("speed").isNotNull() & F.col("reference_speed").isNotNull()
                    & (F.col("reference_speed") > F.lit(0.0)))
    return score(out)


def prepare_segments(df: DataFrame) -> DataFrame:
    """Lookup with one row per ``xd`` (a duplicate key would fan readings out):
    of differing rows the smallest by its attributes, in ``SEGMENT_ATTRS``
    order with NULL first. A distributed aggregate at any size."""
    row = F.min(F.struct(*SEGMENT_ATTRS)).alias("_row")
    return df.where(F.col("xd").isNotNull()).groupBy("xd").agg(row).select("xd", "_row.*")


def measure(segments: DataFrame) -> dict[str, int]:
    """Bytes per column of a lookup and its ``rows``, measured in one pass
    (text by its actual length)."""
    def width(f):
        fixed = _WIDTH.get(f.dataType.simpleString())
        if fixed is not None:
            return F.count(F.lit(1)) * fixed
        return F.coalesce(F.sum(F.octet_length(F.col(f.name).cast("string")) + 8), F.lit(0))
    r = segments.agg(F.count(F.lit(1)).alias("rows"),
                     *[width(f).cast("long").alias(f"b_{f.name}") for f in segments.schema.fields]).first()
    return {"rows": r["rows"], **{f.name: r[f"b_{f.name}"] for f in segments.schema.fields}}


def estimated_bytes(segments: DataFrame, cols: list[str] | None = None, again: bool = False) -> int:
    """Measured bytes of ``cols`` (default: all columns). The measure belongs
    to this DataFrame object, so a lookup that is read anew is measured anew;
    ``again`` repeats it (a long-running stream)."""
    held = None if again else getattr(segments, "_measured", None)
    if held is None:
        held = segments._measured = measure(segments)
    return held["rows"] * _ROW_BYTES + sum(held[f.name] for f in segments.schema.fields if cols is None or f.name in cols)


def is_broadcastable(segments: DataFrame, cols: list[str] | None = None,
                     max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, again: bool = False) -> bool:
    """True when the lookup (restricted to ``cols``) is measured to be small."""
    return estimated_bytes(segments, cols, again) <= max_bytes


def enrich(df: DataFrame, segments: DataFrame, how: str = "inner",
           attrs: list[str] | None = None,
           max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES, again: bool = False,
           repeated: bool = False) -> DataFrame:
    """Join readings (``xd_id``) to the lookup (``xd``).

    ``inner`` drops readings of unknown segments (historical path), ``left``
    keeps them with NULL attributes (live path). ``attrs`` limits the lookup
    columns carried (default: all). ``again`` measures the lookup anew.
    ``repeated``: the join runs again in every micro-batch, so a lookup above
    ``STREAM_MAX_BROADCAST_BYTES`` is shuffled, not sent through the driver.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    cols = list(attrs) if attrs is not None else SEGMENT_ATTRS
    lookup = segments.select(F.col("xd").alias("xd_id"), *cols)
    limit = min(max_broadcast_bytes, STREAM_MAX_BROADCAST_BYTES) if repeated else max_broadcast_bytes
    if is_broadcastable(segments, ["xd", *cols], limit, again):
        lookup = F.broadcast(lookup)
    elif repeated:
        lookup = lookup.hint("merge")  # without a hint Spark may still broadcast it
    return df.join(lookup, "xd_id", how)
