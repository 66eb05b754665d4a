"""Date and number functions.

Date text is reduced to its calendar date *in its own offset* (no UTC
conversion), as the reference does: the date part is extracted as text
and parsed with ``try_to_date`` so bad input gives NULL under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from renown.functions.text import _c, let, py_strip

# Python datetime range in days since 1970-01-01 (0001-01-01 .. 9999-12-31).
_MIN_UNIX_DAY = -719162
_MAX_UNIX_DAY = 2932896


def to_date(col) -> Column:
    """Date text -> DATE; NULL if it is none of these forms.

    ISO (with or without time, offset and leading zeros; ``/`` or ``.``
    between the parts too), compact ISO, month/day/year (day first where
    the first number is no month), day and month name, month name and day,
    and the ``ctime`` form.  Years of two digits lie within 50 years of
    ``_PIVOT_YEAR``.
    """
    return let(col, _to_date)


_PIVOT_YEAR = 2026
_MONTH = r"([A-Za-z]{3})[A-Za-z]*\.?"
# Patterns with the numbers of their year, month and day groups.
_FORMS = (
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:$|[T ])", 1, 2, 3),
    (r"^(\d{4})(\d{2})(\d{2})(?:$|T|\d{4}$|\d{6}$)", 1, 2, 3),
    (r"^(0?[1-9]|1[0-2])/(\d{1,2})/(\d{4}|\d{2})(?:$|[ ,])", 3, 1, 2),
    (r"^(1[3-9]|2\d|3[01])/(\d{1,2})/(\d{4}|\d{2})(?:$|[ ,])", 3, 2, 1),
    (r"(?:^|[\s,])(\d{1,2})[ -]+" + _MONTH + r",?[ -]+(\d{4}|\d{2})(?:$|[\s,])", 3, 2, 1),
    (r"(?:^|[\s,])" + _MONTH + r"\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})\b", 3, 1, 2),
    (r"(?:^|[\s,])" + _MONTH + r"\s+(\d{1,2})\s+\d{1,2}:\d{2}(?::\d{2})?(?:\s+[A-Z+-][A-Z\d:]*)?\s+(\d{4})$", 3, 1, 2),
)


def _to_date(raw: Column) -> Column:
    s = py_strip(raw)

    def form(pattern, year, month, day):
        y, m, d = (F.regexp_extract(s, pattern, g) for g in (year, month, day))
        short = y.cast("int") + F.when(y.cast("int") >= (_PIVOT_YEAR + 50) % 100, 1900).otherwise(2000)
        full = F.when(F.length(y) == 2, short.cast("string")).otherwise(y)
        text = F.concat_ws(" ", full, F.initcap(m), d)
        return F.when(y != "", F.try_to_date(text, "yyyy MMM d" if _MONTH in pattern else "yyyy M d"))

    return F.coalesce(*[form(*f) for f in _FORMS])


def epoch_to_date(col) -> Column:
    """Epoch seconds (int or float) -> UTC calendar date; out of range -> NULL."""
    days = F.floor(_c(col).cast("double") / F.lit(86400.0))
    ok = days.between(_MIN_UNIX_DAY, _MAX_UNIX_DAY)
    return F.when(ok, F.date_from_unix_date(days.cast("int")))


def to_int(col) -> Column:
    """Integer or NULL; floats truncate, decimal strings give NULL."""
    return _c(col).try_cast("bigint")


def run_timestamp(instant=None) -> Column:
    """Stamp of an instant (default: now) as YYYYMMDDTHHMMSSZ in UTC."""
    instant = F.current_timestamp() if instant is None else _c(instant)
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), "yyyyMMdd'T'HHmmss'Z'")
