"""Null rules that change report answers.

The reports come from a data-frame language whose missing values behave differently from SQL
NULL.  Each helper states the rule it keeps.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_in(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is never NULL: a missing value is simply not a member."""
    return F.coalesce(as_col(c).isin(*values), F.lit(False))


def not_in(c: ColumnOrName, values: Iterable) -> Column:
    """Anti-membership that keeps missing values."""
    return ~is_in(c, values)


def if_else(cond: Column, yes: Column, no: Column) -> Column:
    """Two-way choice where an unknown condition gives an unknown answer."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def strict_sum(c: ColumnOrName) -> Column:
    """Sum that is NULL as soon as one input is NULL, and 0 over no rows."""
    c = as_col(c)
    return F.when(F.count_if(c.isNull()) > 0, F.lit(None)).otherwise(
        F.coalesce(F.sum(c), F.lit(0))
    )


def sum0(c: ColumnOrName) -> Column:
    """Sum that skips NULL and is 0 when nothing is left."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0))


def paste(*cols: ColumnOrName, sep: str = " ") -> Column:
    """Text join that spells a missing part ``NA`` so that the row still counts."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("NA")) for c in cols])


def null_safe_on(left: DataFrame, right: DataFrame, pairs: Iterable[tuple[str, str]]) -> Column:
    """Join condition in which a missing key matches a missing key."""
    cond = None
    for lk, rk in pairs:
        term = left[lk].eqNullSafe(right[rk])
        cond = term if cond is None else cond & term
    return cond


def na_last(*keys: str) -> list[Column]:
    """Sort keys with missing values last in both directions; ``-name`` sorts descending."""
    return [
        F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last()
        for k in keys
    ]
