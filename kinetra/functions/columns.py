"""Column functions: everything here compiles to Catalyst expressions (no UDF),
so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL placeholder of the surrogate-key rule
# (md5 over the key columns cast to text, NULLs replaced, joined by '-').
SURROGATE_KEY_SEPARATOR = "-"
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"

# Fixed value: mean Earth radius in metres used for great-circle distance.
EARTH_RADIUS_M = 6371000.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """md5 of the key columns as text; a NULL becomes a fixed token so that
    (NULL, 'x') and ('x', NULL) do not collide."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres.  NULL in, NULL out (no clamping, so a
    missing predecessor can never turn into a distance)."""
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
         * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    return F.lit(EARTH_RADIUS_M) * 2 * F.asin(F.sqrt(a))


def speed_bucket(speed) -> Column:
    """Half-open bands <1, <10, <50, rest.  NULL and NaN fall through to FAST
    (comparisons with them are not true), negative speeds are STOPPED."""
    s = _col(speed)
    return (F.when(s < 1, "STOPPED")
            .when(s < 10, "SLOW")
            .when(s < 50, "NORMAL")
            .otherwise("FAST"))


def strip_ws(c) -> Column:
    """Strip all leading/trailing whitespace (Unicode aware, like str.strip)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


# Number syntax accepted by the strict parser -- the decimal
# forms Python's int() / float() accept (single '_' between digits allowed),
# and nothing Java adds on top (no 'd'/'f' suffix, no hex floats).
_DIGITS = r"[0-9](?:_?[0-9])*"
INT_PATTERN = rf"^[+-]?{_DIGITS}$"
FLOAT_PATTERN = (rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
                 rf"(?:[eE][+-]?{_DIGITS})?|(?i:nan|inf|infinity))$")


def strict_int(c) -> Column:
    """Text -> INT, NULL unless the whole text is a decimal integer that fits."""
    c = _col(c)
    return F.when(c.rlike(INT_PATTERN), F.regexp_replace(c, "_", "").try_cast("int"))


def strict_double(c) -> Column:
    """Text -> DOUBLE, NULL unless the whole text is a decimal float."""
    c = _col(c)
    lowered = F.lower(c)
    special = (F.when(lowered.rlike(r"^[+]?(inf|infinity)$"), F.lit(float("inf")))
               .when(lowered.rlike(r"^-(inf|infinity)$"), F.lit(float("-inf")))
               .when(lowered.rlike(r"^[+-]?nan$"), F.lit(float("nan"))))
    return F.when(c.rlike(FLOAT_PATTERN),
                  F.coalesce(special, F.regexp_replace(c, "_", "").try_cast("double")))
