"""Codes, flags, casts and SQL-style helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_from_int(c) -> Column:
    """``'00' + str(n)`` (10 gives ``0010``, as in the reference)."""
    return F.concat(F.lit("00"), _c(c).cast("long").cast("string"))


def code_from_text(c) -> Column:
    """Text ``NaN`` gives ``''``; anything else gets ``00`` in front."""
    c = _c(c)
    return F.when(c == "NaN", F.lit("")).otherwise(F.concat(F.lit("00"), c))


def code_canonical(c, width: int = 3) -> Column:
    """Canonical three-digit code (agrees with C21 on 1-9)."""
    return F.lpad(_c(c).cast("long").cast("string"), width, "0")


def not_null_flag(c) -> Column:
    """C17: 1 when the value is present, else 0."""
    return _c(c).isNotNull().cast("int")


def equal_flag(a, b) -> Column:
    """1 when equal, 0 otherwise (null compares false)."""
    return F.coalesce(_c(a) == _c(b), F.lit(False)).cast("int")


def concat_strict(*cols, sep: str = "") -> Column:
    """SQL ``CONCAT(a, sep, b, ...)`` - null as soon as one part is null
    (unlike ``concat_ws``, which skips nulls)."""
    parts = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def int_text(c) -> Column:
    """Integer then text (``CAST(x AS CHAR)``)."""
    return _c(c).cast("long").cast("string")


def first_element(c) -> Column:
    """First element of an array cell (null for an empty array)."""
    return F.element_at(_c(c), 1)


def fill_blank(df, value="", numeric_fill=None, subset=None):
    """Fill missing values - ``value`` in text columns, and
    ``numeric_fill`` (if given) in numeric ones.  Unlike a whole-frame
    pandas ``fillna('')``, numbers never turn into text."""
    out = df.na.fill(value, subset=subset)
    if numeric_fill is not None:
        out = out.na.fill(numeric_fill, subset=subset)
    return out


def case_in_list(c, values, otherwise=0) -> Column:
    """``CASE WHEN c IN (...) THEN c ELSE otherwise END``."""
    c = _c(c)
    return F.when(c.isin(*values), c).otherwise(F.lit(otherwise))
