"""Wide to long, long to wide, and report layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_long(
    df: DataFrame, ids: list[str], cols: dict[str, str] | list[str], name: str, value: str
) -> DataFrame:
    """Columns to rows, keeping NULL values; ``cols`` may map a column to its label."""
    cols = cols if isinstance(cols, dict) else {c: c for c in cols}
    pairs = F.array(
        *[F.struct(F.lit(lbl).alias(name), F.col(f"`{c}`").alias(value)) for c, lbl in cols.items()]
    )
    return df.select(*ids, F.inline(pairs))


def to_wide(
    df: DataFrame, ids: list[str], name: str, labels: list[str], values: dict[str, Column]
) -> DataFrame:
    """Rows to columns with a fixed label list.

    ``values`` maps an output prefix to an aggregate; columns are ``<label>`` for one value and
    ``<prefix>_<label>`` for several.
    """
    wide = df.groupBy(*ids).pivot(name, labels).agg(*[v.alias(k) for k, v in values.items()])
    if len(values) == 1:
        return wide
    return wide.withColumnsRenamed({f"{lbl}_{k}": f"{k}_{lbl}" for lbl in labels for k in values})


#: Columns that a pivot over found labels may make; further labels share one.
MAX_FOUND = 200
OTHERS = "others"


def labels_found(df: DataFrame, name: str, first: list[str] = (), most: int = MAX_FOUND) -> tuple[list[str], bool]:
    """Labels of a column, the given ones first, then the others by name, and whether there are too many.

    The pass over the labels is bounded: no more than ``most`` of them reach the driver.
    """
    rest = df.filter(F.col(name).isNotNull() & ~F.col(name).isin(list(first))).select(name).distinct()
    found = [r[0] for r in rest.orderBy(name).limit(most + 1).collect()]
    return [*first, *found[:most]], len(found) > most


def under_others(c: Column, labels: list[str], others: str = OTHERS) -> Column:
    """A label that has no column of its own goes to the shared one; an unknown one stays unknown."""
    return F.when(c.isNull() | c.isin(labels), c).otherwise(others)


def graded_wide(
    df: DataFrame, ids: list[str], grades: list[str], attrs: dict[str, str], grade: str = "grade"
) -> DataFrame:
    """``<grade>_<attribute>`` columns to one row per grade, in one projection and no shuffle."""
    cells = F.array(
        *[
            F.struct(
                F.lit(g).alias(grade),
                *[F.col(f"`{g}_{label}`").alias(out) for label, out in attrs.items()],
            )
            for g in grades
        ]
    )
    return df.select(*ids, F.inline(cells))


def token_pairs(tokens: Column, positions: list[tuple[int, int]]) -> Column:
    """(label, value) entries from pairs of 1-based token positions."""
    return F.array(
        *[
            F.struct(
                F.get(tokens, F.lit(a - 1)).alias("label"),
                F.get(tokens, F.lit(b - 1)).alias("value"),
            )
            for a, b in positions
        ]
    )


def pair_value(pairs: Column, label: str) -> Column:
    """Value of the first entry with a label, else NULL."""
    hits = F.filter(pairs, lambda e: e["label"] == label)
    return F.get(hits, F.lit(0))["value"]


def relocate(
    df: DataFrame, cols: list[str], before: str | None = None, after: str | None = None,
    last: bool = False,
) -> DataFrame:
    """Move columns to the front, to the end, or next to another column."""
    rest = [c for c in df.columns if c not in cols]
    if last:
        return df.select(*rest, *cols)
    at = rest.index(before) if before else rest.index(after) + 1 if after else 0
    return df.select(*rest[:at], *cols, *rest[at:])


def text_or(df: DataFrame, cols: dict[str, Column] | list[str], default: str) -> DataFrame:
    """Columns as text with a default for missing values."""
    cols = cols if isinstance(cols, dict) else {c: F.col(c).cast("string") for c in cols}
    return df.withColumns({c: F.coalesce(v, F.lit(default)) for c, v in cols.items()})
