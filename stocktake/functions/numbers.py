"""Numbers out of hand-written text; whatever cannot be read becomes NULL.

A failing ``try_cast`` costs an exception per row, so texts that cannot be
numbers are sorted out by a pattern before they reach a cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stocktake.functions.text import blank_to_null, strip

# A short whole number, and any decimal or scientific notation.
SHORT_WHOLE = r"^ *[+-]?[0-9]{1,9} *$"
ANY_NUMBER = r"^[ \t\n\r\f]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?[ \t\n\r\f]*$"


def safe_int(text: Column, any_blanks: bool = True) -> Column:
    """Integer; fractions round half away from zero, exponents are understood.

    Outer ASCII blanks are always ignored, other space separators only with
    ``any_blanks``.
    """
    bare = strip(text) if any_blanks else text
    rounded = F.round(bare.try_cast("decimal(38,27)"), 0).try_cast("int")
    return F.when(text.rlike(SHORT_WHOLE), text.try_cast("int")).when(bare.rlike(ANY_NUMBER), rounded)


def digits_key(text: Column) -> Column:
    """All digits of the text, in order, as a bigint; none or too many give NULL."""
    return blank_to_null(F.regexp_replace(text, "[^0-9]+", "")).try_cast("bigint")


def mixed_decimal(text: Column, precision: int = 14, scale: int = 2) -> Column:
    """``1.234,56`` and ``1234.56`` alike; a comma, if any, is the decimal sign."""
    point = strip(F.when(text.contains(","), F.translate(text, ",.", ".")).otherwise(text))
    return F.when(point.rlike(ANY_NUMBER), point.try_cast(f"decimal({precision},{scale})"))
