"""The given star schema as a sales table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import DAY, table

# Market segment to channel type.
SEGMENTS = {
    "AUTOMOBILE": "自营",
    "BUILDING": "分销-系统",
    "FURNITURE": "分销-报单",
    "HOUSEHOLD": "票务网站",
    "MACHINERY": "大客户",
}
VENUES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
CHANNEL_GROUPS = ["自营", "分销", "票务网站"]
UNSPECIFIED = "4-NOT SPECIFIED"


def channel_type(c: str = "c_mktsegment") -> Column:
    out = F.when(F.lit(False), F.lit(None))
    for segment, channel in SEGMENTS.items():
        out = out.when(F.col(c) == segment, channel)
    return out


def net_revenue() -> Column:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    return (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")


def net_units() -> Column:
    """The same in whole ten-thousandths: sums of whole numbers are exact and fast."""
    price = F.round(F.col("l_extendedprice") * 100).cast("long")
    return price * (F.lit(100) - F.round(F.col("l_discount") * 100).cast("long"))


def from_units(c: Column) -> Column:
    return (c.cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(18,4)")


# Column: (tables it needs, expression).
COLUMNS = {
    "production": ("part", lambda: F.col("p_type")),
    "project": ("nation", lambda: F.col("n_name")),
    "venue": ("region", lambda: F.col("r_name")),
    "session_ts": ("", lambda: F.col("l_shipdate")),
    "order_ts": ("orders", lambda: F.col("o_orderdate")),
    "channel_type": ("customer", lambda: channel_type()),
    "channel_detail": ("orders", lambda: F.nullif("o_orderpriority", F.lit(UNSPECIFIED))),
    "face_price": ("part", lambda: F.col("p_retailprice").cast("decimal(18,4)")),
    "net_revenue": ("", net_revenue),
    "tickets": ("", lambda: F.col("l_quantity").cast("int")),
    "recipient_name": ("customer", lambda: F.col("c_name")),
    "recipient_phone": ("orders", lambda: F.col("o_custkey").cast("string")),
    "action_type": ("", lambda: F.nullif("l_returnflag", F.lit("R"))),
    "action_date": ("orders", lambda: F.date_format("o_orderdate", "yyyy-MM-dd")),
}


def sales(spark: SparkSession, sf: str, *cols: str, additive: bool = False) -> DataFrame:
    """Sales columns, joining only the tables that they need.

    Keys of customer, part, nation and region are complete, so a table that no column needs does
    not change the rows.  With ``additive`` the order lines are first summed per order and line
    attribute: a report that only adds up measures then joins and shuffles orders, not lines.
    """
    cols = cols or tuple(COLUMNS)
    need = {COLUMNS[c][0] for c in cols}
    lines = table(spark, sf, "lineitem")
    measures = {"tickets", "net_revenue"}
    if additive:
        keys = ["l_orderkey"]
        if "session_ts" in cols:
            keys.append("l_shipdate")
        if "action_type" in cols:
            keys.append("l_returnflag")
        if "part" in need:
            keys.append("l_partkey")
        lines = lines.groupBy(*keys).agg(
            F.sum(F.col("l_quantity").cast("int")).alias("tickets"),
            F.sum(net_units()).alias("net_revenue"),
        ).withColumn("net_revenue", from_units(F.col("net_revenue")))
    df = lines
    if need & {"orders", "customer", "nation", "region"}:
        df = df.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if need & {"customer", "nation", "region"}:
        df = df.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    if need & {"nation", "region"}:
        df = df.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    if "region" in need:
        df = df.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    if "part" in need:
        df = df.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    made = measures if additive else set()
    return df.select([F.col(c) if c in made else COLUMNS[c][1]().alias(c) for c in cols])


_SEGMENT_SQL = " ".join(f"when '{s}' then '{c}'" for s, c in SEGMENTS.items())

NET_SQL = (
    "cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"
    " as decimal(18,4))"
)

# The same table in SQL; every SQL text that starts with STD may read ``std``.
STD = f"""
with std as (
  select p_type as production, n_name as project, r_name as venue,
         l_shipdate as session_ts, o_orderdate as order_ts,
         case c_mktsegment {_SEGMENT_SQL} end as channel_type,
         nullif(o_orderpriority, '{UNSPECIFIED}') as channel_detail,
         cast(p_retailprice as decimal(18,4)) as face_price,
         {NET_SQL} as net_revenue,
         cast(l_quantity as integer) as tickets,
         c_name as recipient_name, cast(o_custkey as varchar) as recipient_phone,
         nullif(l_returnflag, 'R') as action_type,
         strftime(o_orderdate, {DAY}) as action_date
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  join part on l_partkey = p_partkey
)
"""
GROUP_SQL = (
    "case when channel_type in ('分销-系统', '分销-报单') then '分销' else channel_type end"
)
ACTION_SQL = "case when action_type in ('推文-开票', '推文-仅销售', '推文-含品宣') then '推文' else action_type end"
SUMS = "cast(sum(tickets) as bigint) as tickets, cast(sum(net_revenue) as double) as revenue"
