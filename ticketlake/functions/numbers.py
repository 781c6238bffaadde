"""Number parsing and number-to-text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import ColumnOrName, as_col


def as_number(c: ColumnOrName) -> Column:
    """Text to double; text that is not a number becomes NULL."""
    return as_col(c).try_cast("double")


def as_count(c: ColumnOrName) -> Column:
    """Text to whole number, truncating toward zero."""
    return as_number(c).try_cast("int")


def strip_commas(c: ColumnOrName) -> Column:
    """``1,080`` to 1080."""
    return as_number(F.regexp_replace(as_col(c), ",", ""))


def strip_apostrophe(c: ColumnOrName) -> Column:
    """``'12`` to 12; only the first apostrophe is removed."""
    return as_number(F.regexp_replace(as_col(c), "^([^']*)'", "$1"))


def magnitude(c: ColumnOrName, suffixes: str, whole: bool = True) -> Column:
    """``1.5W`` to 15000.

    ``suffixes`` lists the ten-thousand marks.  With ``whole=False`` only decimals may carry the
    mark, so ``2万`` is not a number.
    """
    c = as_col(c)
    body = r"(\d*\.\d*)" if not whole else r"^(\d*\.?\d*)"
    pattern = rf"{body}[{suffixes}]$"
    scaled = as_number(F.regexp_extract(c, pattern, 1)) * 10000
    return F.when(c.rlike(pattern), scaled).otherwise(as_number(c))


def num_text(c: ColumnOrName) -> Column:
    """Number to text without exponent and without a trailing ``.0``.

    The shortest text of a double is taken first, so no digits beyond its precision appear.
    """
    fixed = as_col(c).cast("string").try_cast("decimal(38,10)").cast("string")
    return F.regexp_replace(F.regexp_replace(fixed, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def rate_percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``100 * part / whole`` rounded to 3 digits; NULL without a positive denominator."""
    whole = as_col(whole).cast("double")
    return F.when(whole != 0, F.round(as_col(part).cast("double") / whole * 100, 3))


def rate_text(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """Conversion rate as report text: ``0.051%``, or empty when the reach is unknown."""
    rate = rate_percent(part, whole)
    return F.when(rate.isNull(), F.lit("")).otherwise(F.concat(num_text(rate), F.lit("%")))
