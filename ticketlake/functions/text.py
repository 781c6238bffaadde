"""Text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import ColumnOrName, as_col

# Any character that is not a control character, CJK included.
PRINTABLE = r"[^\p{Cntrl}]"


def capture(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """Regex capture that is NULL, not empty, when the pattern does not match."""
    c = as_col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def split_pair(c: ColumnOrName, sep: str = "-") -> tuple[Column, Column]:
    """The text before and after the first separator; NULLs when there is no separator."""
    pattern = f"^([^{sep}]*){sep}(.*)$"
    return capture(c, pattern, 1), capture(c, pattern, 2)


def any_prefix(c: ColumnOrName, prefixes: list[str]) -> Column:
    """True when the text starts with one of the prefixes; never NULL."""
    c = as_col(c)
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.coalesce(c.startswith(p), F.lit(False))
    return hit
