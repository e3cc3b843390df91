"""Dates and timestamps that arrive as ISO text or as day/month/year text.

Both shapes are recognised by a pattern, so the cast behind it rarely fails,
and day-first text is turned round for that cast, which is several times
cheaper than a format parser.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stocktake.functions.text import strip

# The ISO shape, its rarer spellings, and the two hand-typed shapes.
ISO_SHAPE = r"^\s*\d{4,}-\d{1,2}-\d{1,2}($|[T ]\d)"
LOOSE_ISO_SHAPE = r"^\s*(\d{4,})([-/])(\d{1,2})\2(\d{1,2})(?:$|[T ]\s*(?=\d))"
DAY_FIRST_DATE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$"
DAY_FIRST_MINUTE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2})\s*$"


def _read(text: Column, shape: str, iso: str | None = None) -> Column:
    """Text of the given shape as a timestamp, after rewriting it to ISO."""
    plain = F.regexp_replace(text, shape, iso) if iso else text
    return F.when(text.rlike(shape), plain.try_cast("timestamp_ntz"))


def _iso(text: Column) -> Column:
    return _read(text, ISO_SHAPE)


def _loose_iso(text: Column) -> Column:
    """Slashes between the parts, or several blanks before the time."""
    return _read(text, LOOSE_ISO_SHAPE, "$1-$3-$4 ")


def flexible_timestamp(text: Column) -> Column:
    """Zone-less timestamp from ISO text, else from day/month/year hour:minute."""
    typed = _read(text, DAY_FIRST_MINUTE, "$3-$2-$1 $4:$5:00")
    return F.coalesce(_iso(text), typed, _loose_iso(text))


def flexible_date(text: Column) -> Column:
    """Date from ISO text (time dropped), else from day/month/year."""
    typed = _read(strip(text), DAY_FIRST_DATE, "$3-$2-$1")
    return F.coalesce(_iso(text), typed, _loose_iso(text)).cast("date")
