"""Checked broadcast, patch overlay and strict lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only up to this many rows; beyond it the join stays a shuffle join.
MAX_BROADCAST_ROWS = 200_000


def small_side(dim: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast when the row count is proven small.

    ``rows`` is a known upper bound.  Without one, at most ``MAX_BROADCAST_ROWS + 1`` rows are
    counted to prove it.
    """
    if rows is None:
        rows = dim.limit(MAX_BROADCAST_ROWS + 1).count()
    return F.broadcast(dim) if rows <= MAX_BROADCAST_ROWS else dim


def patch_overlay(
    df: DataFrame, patches: DataFrame, key: str, value: str, rows: int | None = None, order: str | None = None
) -> DataFrame:
    """Overwrite ``value`` for the listed keys; of a key's patches the first wins, other rows are unchanged.

    ``order`` names the column that numbers the patches; without one they count as they are listed.
    """
    line = F.col(order) if order else F.monotonically_increasing_id()
    one = (
        patches.withColumn("_line", line)
        .filter(F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.min_by(value, "_line").alias("_patched"))
        .withColumnRenamed(key, "_patch_key")
    )
    joined = df.join(small_side(one, rows), F.col(key) == F.col("_patch_key"), "left")
    return joined.withColumn(value, F.coalesce("_patched", value)).drop("_patched", "_patch_key")


def require(c: Column, what: str) -> Column:
    """The value, or a failed job that names what was missing."""
    return F.coalesce(c, F.raise_error(F.lit(f"undefined {what}")).cast("double"))
