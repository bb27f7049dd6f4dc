"""Location text and coordinate rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import LOCATION_COUNTRY


def location_parts(location: Column) -> Column:
    """'a, b, c' as struct(county, state, country): the last two comma parts."""
    parts = F.transform(F.split(location, ","), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    enough = F.size(parts) >= 3
    given = location.isNotNull() & (location != "")
    return F.struct(
        F.when(given & enough, F.try_element_at(parts, F.lit(-2))).alias("county"),
        F.when(given & enough, F.try_element_at(parts, F.lit(-1))).alias("state"),
        F.when(given, F.lit(LOCATION_COUNTRY)).alias("country"),
    )


def rounded_degrees(degrees: Column, places: int) -> Column:
    """Scale, round half to even, scale back, all in floating point.

    Decimal rounding would settle ties the binary value does not have. Adding
    zero turns -0.0 into 0.0.
    """
    scale = F.lit(float(10**places))
    return F.rint(degrees.cast("double") * scale) / scale + F.lit(0.0)
