"""Schemas of the inputs and outputs (decided once, at ingestion)."""

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

# One reading after ingestion. Measures are DOUBLE on both paths (float32 on
# disk is widened at read so batch and live arithmetic agree).
READING = StructType([
    StructField("xd_id", LongType(), True),
    StructField("measurement_tstamp", TimestampNTZType(), True),
    StructField("speed", DoubleType(), True),
    StructField("reference_speed", DoubleType(), True),
    StructField("confidence_score", DoubleType(), True),
])

READING_COLUMNS = [f.name for f in READING.fields]
MEASURES = ["speed", "reference_speed", "confidence_score"]

# One message on the wire: JSON object, timestamp as ISO text.
MESSAGE = StructType([
    StructField("xd_id", LongType(), True),
    StructField("measurement_tstamp", StringType(), True),
    StructField("speed", DoubleType(), True),
    StructField("reference_speed", DoubleType(), True),
    StructField("confidence_score", DoubleType(), True),
])

# Segment lookup after renaming to snake case.
SEGMENT = StructType([
    StructField("xd", LongType(), True),
    StructField("road_name", StringType(), True),
    StructField("frc", IntegerType(), True),
    StructField("bearing", StringType(), True),
    StructField("start_lat", DoubleType(), True),
    StructField("start_long", DoubleType(), True),
    StructField("end_lat", DoubleType(), True),
    StructField("end_long", DoubleType(), True),
])

SEGMENT_ATTRS = [f.name for f in SEGMENT.fields if f.name != "xd"]

# Lookup CSV header name -> our column name, and its type.
SEGMENT_CSV_COLUMNS = [
    ("xd", "xd", "bigint"),
    ("road-name", "road_name", "string"),
    ("frc", "frc", "int"),
    ("bearing", "bearing", "string"),
    ("start_latitude", "start_lat", "double"),
    ("start_longitude", "start_long", "double"),
    ("end_latitude", "end_lat", "double"),
    ("end_longitude", "end_long", "double"),
]

# Raw readings CSV columns kept, and their types.
READING_CSV_COLUMNS = [
    ("xd_id", "bigint"),
    ("measurement_tstamp", "timestamp_ntz"),
    ("speed", "double"),
    ("reference_speed", "double"),
    ("confidence_score", "double"),
]

# The five historical result kinds.
HISTORICAL_KINDS = ("by_hour", "by_day_of_week", "by_road_type", "by_direction", "top_segments")
