"""Seat inventory of all systems and its reconciliation against capacity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.dates import parse_ts, session_from
from ticketlake.functions.nulls import na_last, null_safe_on
from ticketlake.functions.numbers import as_number
from ticketlake.functions.text import capture
from ticketlake.operators import reshape
from ticketlake.operators.lookup import require, small_side
from ticketlake.operators.position import PART
from ticketlake.operators.rules import RuleSet
from ticketlake.sources import readers

from . import channels
from .channels import GRADE_ATTRS, GRADES

STATES = [
    "self_available", "self_locked", "self_sold", "venue_available", "venue_sold",
    "channel_available", "channel_sold",
]
# Cells of one session sheet.
SHEET_FIRST, SHEET_CELLS = 2, {"label": 1, "channel_sold": 3, "channel_available": 17}
SHEET_SESSION = r"(\d{4}-\d{2}-\d{2}).*?(\d{2})-(\d{2})"
# One start time with seconds in the source.
SESSION_FIXES = {"2024-03-29 20:00:14": "2024-03-29 20:00:00"}


def sheet_session(c: str | Column) -> Column:
    """Session of a sheet named ``2024-03-22 周五 20-00``."""
    return session_from(c, SHEET_SESSION)


def tier_order() -> list[Column]:
    """Sessions upwards, their tiers downwards."""
    return na_last("session_ts", "-tier")


def tier_col(c) -> Column:
    return as_number(c).cast("decimal(18,4)")


def self_inventory(raw: DataFrame, productions: list[str]) -> DataFrame:
    session = F.col("场次时间")
    for wrong, right in SESSION_FIXES.items():
        session = F.when(F.col("场次时间") == wrong, right).otherwise(session)
    return raw.filter(F.col("演出名称").isin(*productions)).select(
        parse_ts(session).alias("session_ts"),
        tier_col("票档").alias("tier"),
        as_number("剩余数").alias("self_available"),
        as_number("预留数").alias("self_locked"),
        as_number("售出数").alias("self_sold"),
    )


def platform_inventory(grid: DataFrame) -> DataFrame:
    """One sheet per session; the sheet's name is the session, and every row with a tier counts."""
    rows = readers.rows_between(grid, SHEET_FIRST)
    done = readers.pick(rows, SHEET_CELLS).select(
        sheet_session(readers.sheet_name()).alias("session_ts"),
        tier_col(capture("label", r"(\d*)")).alias("tier"),
        as_number("channel_available").alias("channel_available"),
        as_number("channel_sold").alias("channel_sold"),
    )
    return done.filter(F.col("tier").isNotNull())


def summary_inventory(grid: DataFrame) -> DataFrame:
    return channels.summary_rows(grid, complete=False).select(
        "session_ts",
        F.col("price").cast("decimal(18,4)").alias("tier"),
        F.col("sold").alias("venue_sold"),
    )


def section_inventory(grid: DataFrame) -> DataFrame:
    rows = channels.section_rows(grid, {"label": 1, "sold": 6, "left": 15})
    return rows.select(
        "session_ts",
        F.col("face_price").cast("decimal(18,4)").alias("tier"),
        as_number("left").alias("venue_available"),
        F.col("sold").alias("venue_sold"),
    )


def graded_inventory(raw: DataFrame) -> DataFrame:
    rows = reshape.graded_wide(raw, [PART, "演出时间"], GRADES, GRADE_ATTRS)
    return rows.select(
        parse_ts("演出时间").alias("session_ts"),
        tier_col("face_price").alias("tier"),
        as_number("tickets").alias("venue_sold"),
    )


def venue_grid_sales(
    grid: DataFrame, production: str, tiers: list[str], header_cell: str = "票价等级",
    sold_at: tuple[int, str] = (3, "正常票"), income_at: tuple[int, str] = (2, "合计应收金额（元）"),
) -> DataFrame:
    """Venue report whose columns are found through its header rows."""
    found = readers.find_columns(grid, header_cell, {"sold": sold_at, "income": income_at})
    cells = readers.pick_found(grid, found, ["sold", "income"]).withColumnRenamed("c1", "label")
    rows = channels.tier_rows(cells, tiers)
    return rows.select(
        F.lit(production).alias("production"),
        "session_ts",
        F.col("face_price").cast("decimal(18,4)").alias("face_price"),
        F.lit("剧场").alias("channel_type"),
        F.col("sold").alias("tickets"),
        as_number("income").cast("decimal(18,4)").alias("net_revenue"),
    )


def attach(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Left join on (session, tier) in which a missing key matches a missing key."""
    keys = ["session_ts", "tier"]
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *cols)
    on = null_safe_on(left, r, [(k, f"_r_{k}") for k in keys])
    return left.join(r, on, "left").drop(*[f"_r_{k}" for k in keys])


def combine(own: DataFrame, joined: list[DataFrame], separate: list[DataFrame]) -> DataFrame:
    """Own inventory with the systems joined to it, then the systems that stand alone."""
    out = own
    for part in joined:
        out = attach(out, part, [c for c in part.columns if c in STATES])
    for part in separate:
        out = out.unionByName(part, allowMissingColumns=True)
    missing = {s: F.lit(None).cast("double") for s in STATES if s not in out.columns}
    return out.withColumns(missing).na.fill(0, STATES)


def by_tier(rows: DataFrame, cancelled: DataFrame | None = None) -> DataFrame:
    """Seats per (session, tier) and state, without cancelled sessions, in the report's order."""
    sums = rows.groupBy("session_ts", "tier").agg(
        *[F.sum(s).cast("long").alias(s) for s in STATES]
    )
    if cancelled is not None:
        sums = sums.join(small_side(cancelled), "session_ts", "left_anti")
    return sums.orderBy(*tier_order())


def reconcile(tiers: DataFrame, capacity: RuleSet | DataFrame, strict: bool = False) -> DataFrame:
    """What the venue still holds: capacity minus all other states.

    A capacity table may be keyed by session and tier, or by one of them.  ``strict`` fails on a (session, tier) without capacity.
    """
    keys = [k for k in ("session_ts", "tier") if not isinstance(capacity, DataFrame) or k in capacity.columns]
    if isinstance(capacity, RuleSet):
        seated = capacity.apply(tiers, {k: k for k in keys})
    else:
        seated = tiers.join(capacity, keys, "left")
    others = [s for s in STATES if s != "venue_available"]
    taken = sum((F.col(s) for s in others[1:]), F.col(others[0]))
    seats = require(F.col("seats").cast("double"), "capacity").cast("long") if strict else F.col("seats")
    return seated.withColumn("venue_available", (seats - taken).cast("long")).orderBy(*tier_order())


def by_session(tiers: DataFrame) -> DataFrame:
    sums = tiers.groupBy("session_ts").agg(*[F.sum(s).alias(s) for s in STATES])
    return sums.orderBy(*na_last("session_ts"))


def only_sessions(df: DataFrame, sessions: list[str]) -> DataFrame:
    """Rows of the listed sessions."""
    listed = small_side(dims.session_table(df.sparkSession, sessions), len(sessions))
    return df.join(listed, "session_ts", "left_semi")


