"""Daily sales reports over the canonical sales table.

Each report is a function of (sales, parameters).  Aggregates combine on the map side, so a channel
or day that holds most of the rows shrinks before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.dates import day_window, ntz, zh_weekday
from ticketlake.functions.nulls import if_else, is_in, na_last, not_in, null_safe_on, paste, strict_sum, sum0
from ticketlake.functions.numbers import num_text, rate_percent, rate_text
from ticketlake.operators import reshape
from ticketlake.operators.rules import RuleSet
from ticketlake.session import written

from .channels import BULK, PLATFORM, SELF, union_all

DISTRIBUTION = "分销"
NATURAL, ARTICLE = "自然销售", "推文"
NOT_DISTRIBUTORS = [SELF, "大麦", "剧场", PLATFORM, BULK]
# Report labels of the two measures.
TICKETS_LABEL, REVENUE_LABEL = "售票数", "收入"


def channel_group(c: str = "channel_type", types: list[str] = dims.DISTRIBUTOR_TYPES) -> Column:
    """Both distributor types as one group; other types unchanged."""
    return F.when(F.col(c).isin(*types), DISTRIBUTION).otherwise(F.col(c))


def action_group(c: str = "action_type", types: list[str] = dims.ARTICLE_TYPES) -> Column:
    """All article types as one; an unknown type stays unknown."""
    return F.when(F.col(c).isin(*types), ARTICLE).otherwise(F.col(c))


def totals(tickets=sum0, revenue=sum0) -> list[Column]:
    return [tickets("tickets").cast("long").alias("tickets"), revenue("net_revenue").alias("revenue")]


def daily_summary(sales: DataFrame, day: str) -> DataFrame:
    """Tickets and revenue of one day by channel group and project."""
    return (
        sales.filter(day_window("order_ts", day))
        .groupBy(channel_group().alias("channel_group"), "project")
        .agg(*totals())
    )


def daily_summary_all_days(sales: DataFrame) -> DataFrame:
    """The daily summary of every day at once."""
    return sales.groupBy(
        F.to_date("order_ts").alias("order_day"), channel_group().alias("channel_group"), "project"
    ).agg(*totals())


def session_summary(sales: DataFrame) -> DataFrame:
    """Tickets and revenue by project, session and price."""
    sums = sales.groupBy("project", "session_ts", "face_price").agg(*totals())
    return sums.orderBy(*na_last("session_ts", "face_price"))


def project_total(sales: DataFrame, exclude_bulk: bool = False) -> DataFrame:
    """Revenue by project; without bulk, rows of unknown channel type are left out as well."""
    if exclude_bulk:
        sales = sales.filter(F.col("channel_type") != BULK)
    return sales.groupBy("project").agg(sum0("net_revenue").alias("revenue"))


def direct_of_day(sales: DataFrame, day: str | None) -> DataFrame:
    rows = sales.filter(F.col("channel_type") == SELF)
    return rows.filter(day_window("order_ts", day)) if day else rows


def action_performance(sales: DataFrame, day: str | None) -> DataFrame:
    """Direct sales by marketing action; an order is a distinct (time, phone)."""
    grouped = action_group()
    return (
        direct_of_day(sales, day)
        .withColumn("action_type", F.coalesce(grouped, F.lit(NATURAL)))
        .groupBy("action_date", "channel_detail", "action_type")
        .agg(F.countDistinct(paste("order_ts", "recipient_phone")).alias("orders"), *totals())
        .orderBy(*na_last("action_type", "-revenue"))
    )


def order_grain(sales: DataFrame, day: str | None) -> DataFrame:
    """Direct sales by marketing action; an order is a distinct (time, name, phone) of the action."""
    keys = ["action_date", "channel_detail", "action_type"]
    return (
        direct_of_day(sales, day)
        .withColumn("action_type", action_group())
        .groupBy(*keys, "order_ts", "recipient_name", "recipient_phone")
        .agg(strict_sum("tickets").alias("tickets"), strict_sum("net_revenue").alias("net_revenue"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("orders"), *totals(strict_sum, strict_sum))
    )


def has_direct_sales(sales: DataFrame, day: str) -> bool:
    return not direct_of_day(sales, day).isEmpty()


def cumulative_by_venue(sales: DataFrame, before: str, venues: list[str]) -> DataFrame:
    """Revenue to date, one column per venue."""
    return (
        sales.filter(F.col("order_ts") < ntz(before))
        .groupBy()
        .pivot("venue", venues)
        .agg(strict_sum("net_revenue"))
    )


def block_rank(c: str) -> Column:
    """Report order: own and distributor channels, then other channels, then bulk."""
    return F.when(is_in(c, [SELF, DISTRIBUTION]), 1).when(not_in(c, [BULK]), 2).otherwise(3)


def daily_matrix(sales: DataFrame, day: str | None, venues: list[str], as_text: bool = True) -> DataFrame:
    """Tickets and revenue rows per channel group, one column per venue.

    A venue total over an unknown measure counts as 0; a venue without sales is ``0`` too.
    """
    rows = sales.filter(day_window("order_ts", day)) if day else sales
    sums = (
        rows.withColumn("channel_group", channel_group())
        .groupBy("channel_group", "venue")
        .agg(
            F.coalesce(strict_sum("tickets").cast("decimal(28,4)"), F.lit(0)).alias("tickets"),
            F.coalesce(strict_sum("net_revenue").cast("decimal(28,4)"), F.lit(0)).alias("revenue"),
        )
    )
    long = reshape.to_long(
        sums,
        ["channel_group", "venue"],
        {"tickets": TICKETS_LABEL, "revenue": REVENUE_LABEL},
        "measure",
        "value",
    )
    wide = reshape.to_wide(
        long, ["channel_group", "measure"], "venue", venues, {"value": F.sum("value")}
    )
    cells = {v: num_text(f"`{v}`") for v in venues} if as_text else {v: F.col(f"`{v}`") for v in venues}
    default = F.lit("0") if as_text else F.lit(0)
    return wide.select(
        block_rank("channel_group").alias("block"),
        paste("channel_group", "measure", sep="").alias("channel"),
        "channel_group",
        "measure",
        *[F.coalesce(c, default).alias(v) for v, c in cells.items()],
    )


def sort_matrix(matrix: DataFrame) -> DataFrame:
    """Report order of the daily matrix (a few rows per channel)."""
    return matrix.orderBy("block", *na_last("-channel_group", "measure"))


def matrix_numbers(matrix: DataFrame, venues: list[str]) -> DataFrame:
    """The matrix without its labels."""
    return matrix.select(*[F.col(f"`{v}`") for v in venues])


def distributor_breakdown(sales: DataFrame, day: str | None) -> DataFrame:
    """Sales of distributors by action; a channel of unknown type counts as a distributor."""
    rows = sales.filter(not_in("channel_type", NOT_DISTRIBUTORS))
    rows = rows.filter(day_window("order_ts", day)) if day else rows
    sums = rows.groupBy("action_date", "channel_detail").agg(*totals(strict_sum, strict_sum))
    return sums.orderBy(*na_last("-action_date", "-revenue"))


def platform_breakdown(sales: DataFrame, day: str | None) -> DataFrame:
    """Sales of ticketing platforms by action and project."""
    rows = sales.filter(F.col("channel_type") == PLATFORM)
    rows = rows.filter(day_window("order_ts", day)) if day else rows
    sums = rows.groupBy("action_date", "channel_detail", "project").agg(*totals(strict_sum, strict_sum))
    return sums.orderBy(*na_last("-action_date", "-revenue"))


def session_daily(
    sales: DataFrame, day: str | None, channels: list[str] = (), most: int = reshape.MAX_FOUND
) -> DataFrame:
    """Sales per session and weekday, one pair of columns per channel group; bulk counts as direct.

    Groups of ``channels`` have columns in any case and come first; the others are found in the data.  An
    unknown channel is the group ``NA``; groups beyond ``most`` found ones share the columns ``others``.  A
    session without sales of a group has empty text there, an unknown sum is unknown.
    """
    keys = ["session_ts", "project"]
    rows = sales.filter(day_window("order_ts", day)) if day else sales
    grouped = rows.withColumn("channel_group", channel_group())
    merged = if_else(F.col("channel_group") == BULK, F.lit(SELF), F.col("channel_group"))
    sums = (
        grouped.withColumn("channel_group", F.coalesce(merged, F.lit("NA")))
        .groupBy(*keys, "channel_group")
        .agg(*totals(strict_sum, strict_sum))
        .filter("tickets <> 0")
    )
    # Read for its labels and for the pivot.
    sums = written(sums, "session-sums")
    labels, more = reshape.labels_found(sums, "channel_group", list(channels), most)
    if more:
        shared = reshape.under_others(F.col("channel_group"), labels)
        sums = sums.groupBy(*keys, shared.alias("channel_group")).agg(
            strict_sum("tickets").alias("tickets"), strict_sum("revenue").alias("revenue")
        )
        labels = [*labels, reshape.OTHERS]
    texts = {"tickets": num_text("tickets"), "revenue": num_text("revenue"), "weekday": zh_weekday("session_ts")}
    wide = reshape.to_wide(
        sums.withColumns(texts),
        [*keys, "weekday"],
        "channel_group",
        labels,
        {"tickets": F.first("tickets"), "revenue": F.first("revenue"), "hit": F.first(F.lit(True))},
    )
    cells = {
        f"{m}_{c}": F.when(F.col(f"`hit_{c}`").isNull(), F.lit("")).otherwise(F.col(f"`{m}_{c}`"))
        for c in labels
        for m in ("tickets", "revenue")
    }
    return wide.withColumns(cells).drop(*[f"hit_{c}" for c in labels]).orderBy("session_ts")


def campaign_performance(sales: DataFrame, before: str, reach: RuleSet) -> DataFrame:
    """Every marketing action to date: tickets, revenue, reach, cost, return and conversion."""
    keys = ["channel_detail", "action_type", "action_date"]
    to_date = (
        sales.filter((F.col("order_ts") < ntz(before)) & (F.col("channel_type") == SELF))
        .withColumn("action_type", action_group())
        .groupBy(*keys)
        .agg(
            sum0("tickets").cast("long").alias("total_tickets"),
            sum0("net_revenue").cast("double").alias("total_revenue"),
        )
    )
    known = reach.apply(to_date, {"detail": "channel_detail", "action_date": "action_date"})
    return known.withColumns(
        {
            "total_rate": rate_percent("total_tickets", "reach"),
            "roi": F.when(F.col("cost") != 0, F.col("total_revenue") / F.col("cost")),
        }
    )


def direct_breakdown(sales: DataFrame, day: str, campaigns: DataFrame) -> DataFrame:
    """Direct sales of a day by action with conversion rates against the action's reach."""
    today = order_grain(sales, day)
    stats = campaigns.withColumnsRenamed({c: f"_s_{c}" for c in campaigns.columns})
    on = null_safe_on(
        today,
        stats,
        [(k, f"_s_{k}") for k in ("channel_detail", "action_type", "action_date")],
    )
    joined = today.join(stats, on, "left")
    reach = F.col("_s_reach")
    return joined.select(
        "channel_detail",
        "action_type",
        "action_date",
        "orders",
        "tickets",
        "revenue",
        F.coalesce(num_text(reach), F.lit("")).alias("reach"),
        rate_text("orders", reach).alias("order_rate"),
        rate_text("tickets", reach).alias("ticket_rate"),
        rate_text("_s_total_tickets", reach).alias("total_rate"),
    )


def direct_breakdown_report(breakdown: DataFrame) -> DataFrame:
    """Columns and order of the printed breakdown."""
    ordered = breakdown.orderBy(*na_last("action_type", "-action_date", "channel_detail", "-revenue"))
    return ordered.select(
        F.col("channel_detail").alias("来源细分"),
        F.col("orders").alias("订单数"),
        F.col("tickets").alias("售票数"),
        F.col("revenue").alias("收入"),
        F.col("reach").alias("阅读/发送人数"),
        F.col("order_rate").alias("订单转化率"),
        F.col("ticket_rate").alias("售票转化率"),
        F.col("total_rate").alias("累计转化率"),
        F.col("action_date").alias("动作日期"),
    )


def rollup_sessions(sales: DataFrame) -> DataFrame:
    """Project and project-session totals in one pass over the data."""
    per_session = sales.groupBy("project", "session_ts").agg(*totals())
    return per_session.rollup("project", "session_ts").agg(
        F.grouping_id().alias("level"),
        F.sum("tickets").alias("tickets"),
        F.sum("revenue").alias("revenue"),
    )


def all_sold(parts: list[DataFrame]) -> DataFrame:
    """Sales of all systems and venue reports as one table for :func:`sell_through`."""
    return union_all(parts)


def sell_through(requests: DataFrame, sold: DataFrame, capacity: RuleSet | None = None) -> DataFrame:
    """Tickets, revenue and seats for requested (production, session, tier) rows.

    ``sold`` is grouped once for all requests, before the join, so a best-selling tier reaches the
    join as one row.  A request without sales is 0, and without a capacity has 0 seats.
    """
    keys = ["production", "session_ts", "tier"]
    sums = (
        sold.withColumn("tier", F.col("face_price"))
        .groupBy(*keys)
        .agg(*totals(strict_sum, strict_sum))
        .withColumn("_hit", F.lit(True))
    )
    sums = sums.withColumnsRenamed({k: f"_{k}" for k in keys})
    # A request without a session or tier meets the sales without one.
    on = null_safe_on(requests, sums, [(k, f"_{k}") for k in keys])
    out = requests.join(sums, on, "left").drop(*[f"_{k}" for k in keys])
    # Only a request without any sale is 0; an unknown sum stays unknown.
    out = out.withColumns(
        {
            c: F.when(F.col("_hit").isNull(), F.lit(0)).otherwise(F.col(c))
            for c in ("tickets", "revenue")
        }
    ).drop("_hit")
    if capacity is None:
        return out
    seated = capacity.apply(out, {k: k for k in keys})
    return seated.withColumn("seats", F.coalesce("seats", F.lit(0)))
