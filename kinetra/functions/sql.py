"""The library's column functions for SQL text: temporary SQL functions, whose bodies
Spark inlines into the plan (no UDF)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from kinetra.functions.columns import (EARTH_RADIUS_M, SURROGATE_KEY_NULL,
                                       SURROGATE_KEY_SEPARATOR)

#: Name, parameters, result and body of each function.
FUNCTIONS = [
    ("haversine_meters", "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE", "DOUBLE",
     f"""CAST({EARTH_RADIUS_M} AS DOUBLE) * 2 * asin(sqrt(
           power(sin(radians(lat2 - lat1) / 2), 2)
           + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon1) / 2), 2)))"""),
    # key columns as text, in an array: array(source_file, CAST(track_id AS STRING))
    ("surrogate_key", "parts ARRAY<STRING>", "STRING",
     f"""md5(array_join(transform(parts, p -> coalesce(p, '{SURROGATE_KEY_NULL}')),
           '{SURROGATE_KEY_SEPARATOR}'))"""),
    ("speed_bucket", "speed DOUBLE", "STRING",
     """CASE WHEN speed < 1 THEN 'STOPPED' WHEN speed < 10 THEN 'SLOW'
             WHEN speed < 50 THEN 'NORMAL' ELSE 'FAST' END"""),
]


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to ``spark.sql``; returns their names."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [f[0] for f in FUNCTIONS]
