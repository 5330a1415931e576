"""Coordinates and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output.
EARTH_RADIUS_KM = 6371.0
RANGE_LIMIT_M = 200
RANGE_IN = "Dentro del Rango"
RANGE_OUT = "Fuera del Rango"
RANGE_YES = "Si"

# Text that pandas.to_numeric accepts as a plain decimal number (surrounding
# blanks, sign, optional fraction, optional exponent).  Spark's own cast is
# more lenient (``1.0d``, ``NaN``), so the cast is guarded by this pattern.
_NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coord_text(c) -> Column:
    """Comma decimal to dot, first 8 characters; null stays null."""
    return F.substring(F.regexp_replace(_c(c), ",", "."), 1, 8)


def to_number(c) -> Column:
    """Text to double; text that is not a number becomes null."""
    c = _c(c)
    s = c.cast("string")
    return F.when(s.rlike(_NUMBER_RE), F.trim(s).try_cast("double"))


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres; argument order is (lon, lat)."""
    la1, lo1 = F.radians(_c(lat1)), F.radians(_c(lon1))
    la2, lo2 = F.radians(_c(lat2)), F.radians(_c(lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    # rounding can push ``a`` a hair above 1; clamp so sqrt(1 - a) stays real
    c = 2 * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))
    return F.lit(EARTH_RADIUS_KM) * c * 1000


def guarded_distance(lon1, lat1, lon2, lat2) -> Column:
    """C14: null if any coordinate is missing, 0 if any is 0, else C13."""
    cs = [_c(x) for x in (lon1, lat1, lon2, lat2)]
    any_null = cs[0].isNull() | cs[1].isNull() | cs[2].isNull() | cs[3].isNull()
    any_zero = (cs[0] == 0) | (cs[1] == 0) | (cs[2] == 0) | (cs[3] == 0)
    return (F.when(any_null, F.lit(None).cast("double"))
            .when(any_zero, F.lit(0.0))
            .otherwise(haversine_m(*cs)))


def range_class(d) -> Column:
    """<= 200 m inside, above outside, missing distance gives ''."""
    d = _c(d)
    return (F.when(d <= RANGE_LIMIT_M, F.lit(RANGE_IN))
            .when(d > RANGE_LIMIT_M, F.lit(RANGE_OUT))
            .otherwise(F.lit("")))


def range_class_si(d) -> Column:
    """Same classes with the labels of the first design."""
    d = _c(d)
    return (F.when(d <= RANGE_LIMIT_M, F.lit(RANGE_YES))
            .when(d > RANGE_LIMIT_M, F.lit(RANGE_OUT))
            .otherwise(F.lit("")))
