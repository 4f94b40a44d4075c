"""Fixed schemas of the raw layer (never inferred)."""

from pyspark.sql import types as T

TRACKS = T.StructType([
    T.StructField("source_file", T.StringType(), False),
    T.StructField("track_id", T.IntegerType(), False),
    T.StructField("vehicle_type", T.StringType(), True),
    T.StructField("traveled_d", T.DoubleType(), True),
    T.StructField("avg_speed", T.DoubleType(), True),
    T.StructField("loaded_at", T.TimestampType(), False),
])

POINT_MEASURES = ["lat", "lon", "speed", "lon_acc", "lat_acc", "time_sec"]

TRAJECTORY_POINTS = T.StructType(
    [
        T.StructField("source_file", T.StringType(), False),
        T.StructField("track_id", T.IntegerType(), False),
        T.StructField("frame_idx", T.IntegerType(), False),
    ]
    + [T.StructField(c, T.DoubleType(), True) for c in POINT_MEASURES]
    + [T.StructField("loaded_at", T.TimestampType(), False)]
)

# Rejected lines, equal lines of a file once with their number.
REJECTS = T.StructType([
    T.StructField("source_file", T.StringType(), False),
    T.StructField("line", T.StringType(), True),
    T.StructField("first_field", T.StringType(), True),
    T.StructField("n_fields", T.IntegerType(), True),
    T.StructField("reject_reason", T.StringType(), True),
    T.StructField("n_lines", T.LongType(), True),
    T.StructField("loaded_at", T.TimestampType(), False),
])
REJECT_KEY = ["source_file", "line"]

TRACK_KEY = ["source_file", "track_id"]
POINT_KEY = ["source_file", "track_id", "frame_idx"]

# The vehicle categories accepted by the staging checks.
VEHICLE_TYPES = ["Car", "Motorcycle", "Taxi", "Bus", "Medium Vehicle", "Heavy Vehicle"]

# Speed bucket labels, slowest first.
SPEED_BUCKETS = ["STOPPED", "SLOW", "NORMAL", "FAST"]
