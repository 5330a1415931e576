"""Text cleaning (C19, C20, C33) and the Latin-1 sink filter.

All of it runs on the JVM. Unicode decomposition comes from ICU4J, which
Spark 4 ships on its class path, called through the SQL ``reflect`` function
(static ``Normalizer.decompose(text, compat)``), then ``regexp_replace``.
Without ICU4J the first use raises an error: there is no second form that
would give other results.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache
from itertools import groupby

from pyspark import SparkContext
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed pattern of the reference cleaner: keep ASCII letters, digits, blanks.
# Python's ``\s`` on text is Unicode whitespace plus U+001C..U+001F; Java's
# ``(?U)\s`` lacks the latter four, so they are listed.
_JVM_DROP = r"(?U)[^a-zA-Z0-9\s\x{1C}-\x{1F}]"
_ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=1)
def _require_icu() -> None:
    """Raise unless ICU4J's normalizer is on the JVM class path."""
    session = SparkSession.getActiveSession()
    jvm = session._jvm if session is not None else SparkContext._active_spark_context._jvm
    try:
        jvm.java.lang.Class.forName(_ICU_NORMALIZER)
    except Exception as e:
        raise RuntimeError(f"text cleaning needs ICU4J ({_ICU_NORMALIZER}) on Spark's class path") from e


@lru_cache(maxsize=1)
def combining_class_pattern() -> str:
    """A character class of all code points with a non-zero combining class
    (what ``unicodedata.combining`` marks), as ranges.

    Java tries the ranges of a class one after the other, for every character.
    So they stand in a tree: each inner class is one range that holds all below
    it, and (``&&``) those. A character outside all marks costs one comparison,
    any other a few.
    """
    marks = (cp for cp in range(sys.maxunicode + 1) if unicodedata.combining(chr(cp)))
    runs = [[cp for _, cp in run] for _, run in groupby(enumerate(marks), lambda x: x[1] - x[0])]

    def within(ranges: list[tuple[int, int]]) -> str:
        if len(ranges) <= 2:
            return f"[{''.join(_range(*r) for r in ranges)}]"
        half = len(ranges) // 2
        return f"[{_range(ranges[0][0], ranges[-1][1])}&&[{within(ranges[:half])}{within(ranges[half:])}]]"

    return within([(run[0], run[-1]) for run in runs])


def _range(first: int, last: int) -> str:
    return rf"\x{{{first:X}}}-\x{{{last:X}}}"


def decompose(c, compat: bool) -> Column:
    """NFKD (``compat``) or NFD of a text column on the JVM via ICU4J.

    An ASCII text (as many bytes as characters) is its own decomposition, so
    only the others pay for the reflective call.
    """
    _require_icu()
    x = _c(c)
    call = F.call_function("reflect", F.lit(_ICU_NORMALIZER), F.lit("decompose"), x,
                           F.lit(bool(compat)))
    return F.when(F.octet_length(x) == F.length(x), x).when(x.isNotNull(), call)


def clean_text(c) -> Column:
    """NFKD, then keep ``[a-zA-Z0-9\\s]``. Null stays null."""
    return F.regexp_replace(decompose(c, True), _JVM_DROP, "")


def strip_marks(c) -> Column:
    """C20: NFD without the characters of a non-zero combining class;
    spacing marks (class 0) and punctuation stay. Null stays null. An ASCII text
    has none of them and is not searched."""
    x = _c(c)
    plain = F.regexp_replace(decompose(x, False), combining_class_pattern(), "")
    return F.when(F.octet_length(x) == F.length(x), x).otherwise(plain)


def latin1_safe(c) -> Column:
    """Drop characters a Latin-1 file cannot hold (``errors='ignore'``)."""
    return F.regexp_replace(_c(c), r"[^\x{00}-\x{FF}]", "")
