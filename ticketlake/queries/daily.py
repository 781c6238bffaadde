"""Daily report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.dates import day_window, ntz
from ticketlake.functions.nulls import is_in, not_in, strict_sum, sum0
from ticketlake.operators.position import PART
from ticketlake.plans import daily, inventory
from ticketlake.plans.weekly import full_join_on_measures
from ticketlake.session import written
from ticketlake.sources import ingest

from .base import MONEY, TS, out, q, query, table, values_sql
from .star import (
    ACTION_SQL,
    CHANNEL_GROUPS,
    GROUP_SQL,
    STD,
    SUMS,
    VENUES,
    sales,
)

DAY_SEEN = "1998-10-03"
BEFORE = "1999-01-01"


@query(
    "daily_summary",
    f"""{STD} select {GROUP_SQL} as channel_group, project, {SUMS} from std
    where order_ts >= timestamp '{DAY_SEEN}' and order_ts < timestamp '{DAY_SEEN}' + interval 1 day
    group by 1, 2""",
)
def daily_summary(spark, sf):
    rows = sales(spark, sf, "order_ts", "channel_type", "project", "tickets", "net_revenue")
    return out(daily.daily_summary(rows, DAY_SEEN))


@query(
    "daily_summary_all_days",
    f"""{STD} select strftime(order_ts, '%Y-%m-%d') as order_day, {GROUP_SQL} as channel_group, project,
    {SUMS} from std group by 1, 2, 3""",
)
def daily_summary_all_days(spark, sf):
    rows = sales(
        spark, sf, "order_ts", "channel_type", "project", "tickets", "net_revenue", additive=True
    )
    return out(daily.daily_summary_all_days(rows))


@query(
    "session_summary",
    f"""{STD} select project, strftime(session_ts, {TS}) as session_ts,
    cast(face_price as double) as face_price, {SUMS} from std group by 1, 2, 3""",
)
def session_summary(spark, sf):
    rows = sales(spark, sf, "project", "session_ts", "face_price", "tickets", "net_revenue")
    return out(daily.session_summary(rows))


@query(
    "project_total",
    f"{STD} select project, cast(sum(net_revenue) as double) as revenue from std group by 1",
)
def project_total(spark, sf):
    return out(daily.project_total(sales(spark, sf, "project", "net_revenue", additive=True)))


@query(
    "project_total_no_bulk",
    f"""{STD} select project, cast(sum(net_revenue) as double) as revenue from std
    where channel_type <> '大客户' group by 1""",
)
def project_total_no_bulk(spark, sf):
    rows = sales(spark, sf, "project", "channel_type", "net_revenue", additive=True)
    return out(daily.project_total(rows, exclude_bulk=True))


@query(
    "action_performance",
    f"""{STD} select action_date, channel_detail, coalesce({ACTION_SQL}, '自然销售') as action_type,
    count(distinct strftime(order_ts, {TS}) || ' ' || coalesce(recipient_phone, 'NA')) as orders, {SUMS}
    from std where channel_type = '自营' group by 1, 2, 3""",
)
def action_performance(spark, sf):
    rows = sales(
        spark, sf, "order_ts", "channel_type", "channel_detail", "action_date", "action_type",
        "recipient_phone", "tickets", "net_revenue",
    )
    return out(daily.action_performance(rows, None))


@query(
    "order_grain_breakdown",
    f"""{STD}, o as (
      select action_date, channel_detail, {ACTION_SQL} as action_type, order_ts, recipient_name,
        recipient_phone, sum(tickets) as tickets, sum(net_revenue) as net_revenue
      from std where channel_type = '自营' group by 1, 2, 3, 4, 5, 6)
    select action_date, channel_detail, action_type, count(*) as orders, {SUMS} from o group by 1, 2, 3""",
)
def order_grain_breakdown(spark, sf):
    rows = sales(
        spark, sf, "order_ts", "channel_type", "channel_detail", "action_date", "action_type",
        "recipient_name", "recipient_phone", "tickets", "net_revenue",
    )
    return out(daily.order_grain(rows, None))


_VENUE_SUMS = ", ".join(
    f"cast(sum(case when venue = '{v}' then net_revenue end) as double) as \"{v}\"" for v in VENUES
)


@query(
    "cumulative_by_venue_pivot",
    f"{STD} select {_VENUE_SUMS} from std where order_ts < timestamp '{BEFORE}'",
)
def cumulative_by_venue_pivot(spark, sf):
    rows = sales(spark, sf, "order_ts", "venue", "net_revenue", additive=True)
    return out(daily.cumulative_by_venue(rows, BEFORE, VENUES))


_MATRIX = ", ".join(
    f"coalesce(sum(case when venue = '{v}' then value end), 0.0) as \"{v}\"" for v in VENUES
)


@query(
    "daily_matrix",
    f"""{STD}, s as (select {GROUP_SQL} as channel_group, venue, cast(sum(tickets) as double) as t,
        cast(sum(net_revenue) as double) as r from std group by 1, 2),
    l as (select channel_group, venue, '售票数' as measure, t as value from s
          union all select channel_group, venue, '收入', r from s)
    select case when channel_group in ('自营', '分销') then 1 when channel_group = '大客户' then 3 else 2 end
      as block, channel_group || measure as channel, channel_group, measure, {_MATRIX}
    from l group by channel_group, measure""",
)
def daily_matrix(spark, sf):
    rows = sales(spark, sf, "channel_type", "venue", "tickets", "net_revenue", additive=True)
    matrix = daily.daily_matrix(rows, None, VENUES, as_text=False)
    return out(daily.sort_matrix(matrix))


_TEXTS = ", ".join(
    f"coalesce(rtrim(rtrim(cast(cast(sum(case when venue = '{v}' then value end) as decimal(28,4)) as varchar), '0'), '.'),"
    f" '0') as \"{v}\""
    for v in VENUES
)


@query(
    "daily_matrix_text",
    f"""{STD}, s as (select {GROUP_SQL} as channel_group, venue, cast(sum(tickets) as {MONEY}) as t,
        cast(sum(net_revenue) as {MONEY}) as r from std where order_ts < timestamp '{BEFORE}' group by 1, 2),
    l as (select channel_group, venue, '售票数' as measure, t as value from s
          union all select channel_group, venue, '收入', r from s)
    select channel_group || measure as channel, {_TEXTS} from l group by channel_group, measure""",
)
def daily_matrix_text(spark, sf):
    rows = sales(
        spark, sf, "order_ts", "channel_type", "venue", "tickets", "net_revenue", additive=True
    ).filter(F.col("order_ts") < ntz(BEFORE))
    return daily.daily_matrix(rows, None, VENUES).drop("block", "channel_group", "measure")


_WEEKDAY = "(['周一','周二','周三','周四','周五','周六','周日'])[isodow(session_ts)]"
_PAIRS = ", ".join(
    f"coalesce(max(case when g = '{c}' then {m} end), '') as \"{n}_{c}\""
    for c in CHANNEL_GROUPS
    for n, m in (("tickets", "t"), ("revenue", "r"))
)


@query(
    "session_daily_pivot",
    f"""{STD}, s as (
      select session_ts, project, case when channel_type = '大客户' then '自营' else {GROUP_SQL} end as g,
        cast(sum(tickets) as varchar) as t,
        rtrim(rtrim(cast(sum(net_revenue) as varchar), '0'), '.') as r
      from std group by 1, 2, 3 having sum(tickets) <> 0)
    select strftime(session_ts, {TS}) as session_ts, project, {_WEEKDAY} as weekday, {_PAIRS}
    from s group by s.session_ts, project""",
)
def session_daily_pivot(spark, sf):
    """Two groups are listed, the third is found in the data."""
    rows = sales(spark, sf, "session_ts", "project", "channel_type", "tickets", "net_revenue")
    return out(daily.session_daily(rows, None, CHANNEL_GROUPS[:2]))


@query(
    "distributor_breakdown",
    f"""{STD} select action_date, channel_detail, {SUMS} from std
    where coalesce(channel_type in ('自营', '大麦', '剧场', '票务网站', '大客户'), false) = false
    group by 1, 2""",
)
def distributor_breakdown(spark, sf):
    rows = sales(
        spark, sf, "channel_type", "action_date", "channel_detail", "tickets", "net_revenue",
        additive=True,
    )
    return out(daily.distributor_breakdown(rows, None))


@query(
    "platform_breakdown",
    f"""{STD} select action_date, channel_detail, project, {SUMS} from std
    where channel_type = '票务网站' group by 1, 2, 3""",
)
def platform_breakdown(spark, sf):
    rows = sales(
        spark, sf, "channel_type", "action_date", "channel_detail", "project", "tickets",
        "net_revenue", additive=True,
    )
    return out(daily.platform_breakdown(rows, None))


@query(
    "null_safe_anti_filter",
    f"""{STD} select action_type, channel_detail, count(*) as rows, count(distinct order_ts) as days
    from std where (action_type is null or action_type not in ('A'))
      and (channel_detail is null or channel_detail not in ('1-URGENT', '5-LOW'))
    group by 1, 2""",
)
def null_safe_anti_filter(spark, sf):
    rows = sales(spark, sf, "action_type", "channel_detail", "order_ts")
    kept = rows.filter(not_in("action_type", ["A"]) & not_in("channel_detail", ["1-URGENT", "5-LOW"]))
    return out(
        kept.groupBy("action_type", "channel_detail").agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct("order_ts").alias("days")
        )
    )


@query(
    "strict_sum_vs_sum0",
    f"""{STD}, n as (select project, order_ts, nullif(tickets, 1) as t, nullif(tickets, tickets) as z from std)
    select project, strftime(order_ts, '%Y-%m') as month,
      cast(case when count(*) filter (t is null) > 0 then null else sum(t) end as bigint) as strict_tickets,
      cast(coalesce(sum(t), 0) as bigint) as tickets,
      cast(coalesce(sum(z), 0) as bigint) as nothing
    from n group by 1, 2""",
)
def strict_sum_vs_sum0(spark, sf):
    rows = sales(spark, sf, "project", "order_ts", "tickets").select(
        "project",
        F.date_format("order_ts", "yyyy-MM").alias("month"),
        F.nullif("tickets", F.lit(1)).alias("t"),
        F.nullif("tickets", F.col("tickets")).alias("z"),
    )
    return rows.groupBy("project", "month").agg(
        strict_sum("t").cast("long").alias("strict_tickets"),
        sum0("t").cast("long").alias("tickets"),
        sum0("z").cast("long").alias("nothing"),
    )


@query(
    "full_join_null_keys",
    f"""{STD}, a as (select channel_detail as k, count(*) as lines from std where action_type is not null
          group by 1),
      b as (select action_type as k, cast(sum(tickets) as bigint) as tickets from std group by 1)
    select coalesce(a.k, b.k) as label, lines, tickets from a full join b on a.k is not distinct from b.k""",
)
def full_join_null_keys(spark, sf):
    rows = sales(spark, sf, "channel_detail", "action_type", "tickets")
    a = (
        rows.filter(F.col("action_type").isNotNull())
        .groupBy(F.col("channel_detail").alias("label"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    b = rows.groupBy(F.col("action_type").alias("label")).agg(
        F.sum("tickets").cast("long").alias("tickets")
    )
    return full_join_on_measures(a, b, ["label"])


@query(
    "two_level_rollup",
    f"""{STD} select project, strftime(session_ts, {TS}) as session_ts,
      cast(grouping(project, session_ts) as bigint) as level, {SUMS}
    from std group by rollup (project, std.session_ts)""",
)
def two_level_rollup(spark, sf):
    rows = sales(spark, sf, "project", "session_ts", "tickets", "net_revenue")
    return out(daily.rollup_sessions(rows)).withColumn("level", F.col("level").cast("long"))


# --------------------------------------------------------------------------- campaign conversion
REACH = [
    ("1-URGENT", "1998-10-03", 5886, 206.01),
    ("2-HIGH", "1998-10-03", 1373, None),
    ("3-MEDIUM", "1998-10-03", 460, 16.1),
    ("5-LOW", "1998-10-03", 25357, 1774.99),
    ("2-HIGH", "1997-05-28", 6022, 210.77),
    ("5-LOW", "1999-01-16", 33189, 947.52),
]
_REACH_SQL = values_sql(REACH, "v", "detail, action_date, reach, cost")


@query(
    "campaign_performance",
    f"""{STD} select s.channel_detail, s.action_type, s.action_date, total_tickets, total_revenue,
      cast(reach as double) as reach, cast(cost as double) as cost,
      round(cast(total_tickets as double) / reach * 100, 3) as total_rate,
      round(total_revenue / cost, 6) as roi
    from (select channel_detail, {ACTION_SQL} as action_type, action_date,
            cast(sum(tickets) as bigint) as total_tickets, cast(sum(net_revenue) as double) as total_revenue
          from std where channel_type = '自营' and order_ts < timestamp '{BEFORE}' group by 1, 2, 3) s
    left join {_REACH_SQL} on s.channel_detail = v.detail and s.action_date = v.action_date""",
)
def campaign_performance(spark, sf):
    rows = sales(
        spark, sf, "order_ts", "channel_type", "channel_detail", "action_type", "action_date",
        "tickets", "net_revenue", additive=True,
    )
    done = daily.campaign_performance(rows, BEFORE, dims.campaign_reach(spark, REACH))
    return out(done.withColumn("roi", F.round("roi", 6)))


def _rate_sql(part: str) -> str:
    return f"case when reach is null then null else round(cast({part} as double) / reach * 100, 3) end"


@query(
    "conversion_rate",
    f"""{STD}, o as (
      select action_date, channel_detail, {ACTION_SQL} as action_type, order_ts, recipient_name, recipient_phone,
        sum(tickets) as tickets, sum(net_revenue) as net_revenue
      from std where channel_type = '自营' and order_ts >= timestamp '{DAY_SEEN}'
        and order_ts < timestamp '{DAY_SEEN}' + interval 1 day group by 1, 2, 3, 4, 5, 6),
    d as (select action_date, channel_detail, action_type, count(*) as orders, {SUMS} from o group by 1, 2, 3),
    c as (select action_date, channel_detail, {ACTION_SQL} as action_type, sum(tickets) as total_tickets
      from std where channel_type = '自营' and order_ts < timestamp '{BEFORE}' group by 1, 2, 3)
    select d.channel_detail, d.action_type, d.action_date, orders, tickets, revenue,
      coalesce(cast(reach as varchar), '') as reach, {_rate_sql('orders')} as order_rate,
      {_rate_sql('tickets')} as ticket_rate, {_rate_sql('total_tickets')} as total_rate
    from d
    join c on d.channel_detail is not distinct from c.channel_detail
      and d.action_type is not distinct from c.action_type and d.action_date = c.action_date
    left join {_REACH_SQL} on c.channel_detail = v.detail and c.action_date = v.action_date""",
)
def conversion_rate(spark, sf):
    cols = (
        "order_ts", "channel_type", "channel_detail", "action_type", "action_date", "tickets",
        "net_revenue",
    )
    reach = dims.campaign_reach(spark, REACH)
    campaigns = daily.campaign_performance(sales(spark, sf, *cols, additive=True), BEFORE, reach)
    rows = sales(spark, sf, *cols, "recipient_name", "recipient_phone")
    report = daily.direct_breakdown(rows, DAY_SEEN, campaigns)
    # Rates as numbers: text of a rounded double may differ between engines in the last digit.
    rates = {c: F.regexp_replace(c, "%", "").try_cast("double") for c in ("order_rate", "ticket_rate", "total_rate")}
    return out(report.withColumns(rates))


# ------------------------------------------------------------------------------- sell-through
# Requested (production, session day, tier) rows, and seats for some of them.
_REQ = [
    ("ECONOMY", "1998-10-03 00:00:00", 900.1),
    ("PROMO", "1996-05-05 00:00:00", 950.5),
    ("SMALL", "1997-07-07 00:00:00", 999.0),
]


@query(
    "tuple_sell_through",
    f"""{STD}, given as (select production, case when tickets <> 49 then session_ts end as session_ts, face_price,
            tickets, net_revenue from std),
    req as (select distinct production, session_ts, face_price as tier from given where tickets in (49, 50)
          union all select a, cast(b as timestamp), cast(c as {MONEY}) from {values_sql(_REQ, "v", "a, b, c")}),
    agg as (select production, session_ts, face_price as tier, sum(tickets) as t, sum(net_revenue) as r
            from given group by 1, 2, 3)
    select req.production, strftime(req.session_ts, {TS}) as session_ts, cast(req.tier as double) as tier,
      cast(coalesce(t, 0) as bigint) as tickets, cast(coalesce(r, 0) as double) as revenue
    from req left join agg on req.production is not distinct from agg.production
      and req.session_ts is not distinct from agg.session_ts and req.tier is not distinct from agg.tier""",
)
def tuple_sell_through(spark, sf):
    rows = sales(spark, sf, "production", "session_ts", "face_price", "tickets", "net_revenue")
    # Some sales and requests lack the session; they meet each other.
    rows = rows.withColumn("session_ts", F.when(F.col("tickets") != 49, F.col("session_ts")))
    asked = (
        rows.filter("tickets in (49, 50)")
        .select("production", "session_ts", F.col("face_price").alias("tier"))
        .distinct()
    )
    extra = spark.createDataFrame(_REQ, "production string, s string, t double").select(
        "production",
        F.col("s").cast("timestamp_ntz").alias("session_ts"),
        F.col("t").cast(MONEY).alias("tier"),
    )
    return out(daily.sell_through(asked.unionByName(extra), rows))


# ---------------------------------------------------------------------------------- inventory
# Seat states of a (ship month, size) "tier" come from line items by status and return flag.
_STATE_OF = {
    ("O", "A"): "self_available",
    ("O", "N"): "self_locked",
    ("O", "R"): "self_sold",
    ("F", "A"): "venue_sold",
    ("F", "N"): "channel_available",
    ("F", "R"): "channel_sold",
}
_CANCELLED = "1997-03-01 00:00:00"
_CAPACITY = 100_000


def _inventory(spark, sf):
    keys = ["session_ts", "tier"]
    sums = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("session_ts"),
            F.col("p_size").cast("decimal(18,4)").alias("tier"),
            "l_linestatus",
            "l_returnflag",
        )
        .agg(F.sum("l_quantity").alias("seats"))
    )
    # Three systems read these few sums: one pass over the line items serves them all.
    sums = written(sums, "seat-states")

    def system(status: str, *states: str):
        flag = {s: k[1] for k, s in _STATE_OF.items()}
        seats = [F.sum(F.when(F.col("l_returnflag") == flag[s], F.col("seats"))).alias(s) for s in states]
        return sums.filter(F.col("l_linestatus") == status).groupBy(*keys).agg(*seats)

    own = system("O", "self_available", "self_locked", "self_sold")
    venue = system("F", "venue_sold")
    channel = system("F", "channel_available", "channel_sold")
    tiers = inventory.by_tier(
        inventory.combine(own, [venue, channel], []), dims.session_table(spark, [_CANCELLED])
    )
    size = F.col("p_size")
    capacity = (
        table(spark, sf, "part")
        .select(size.cast("decimal(18,4)").alias("tier"), (F.lit(_CAPACITY) + size).cast("long").alias("seats"))
        .distinct()
    )
    return inventory.reconcile(tiers, capacity)


def _state_sql(state: str) -> str:
    status, flag = next(k for k, s in _STATE_OF.items() if s == state)
    return (
        f"cast(coalesce(sum(l_quantity) filter (l_linestatus = '{status}' and l_returnflag = '{flag}'), 0)"
        f" as bigint) as {state}"
    )


_INV = f"""with g as (select date_trunc('month', l_shipdate) as session_ts, p_size as tier,
    {', '.join(_state_sql(s) for s in _STATE_OF.values())}
  from lineitem join part on l_partkey = p_partkey
  where date_trunc('month', l_shipdate) <> timestamp '{_CANCELLED}'
  group by 1, 2 having count(*) filter (l_linestatus = 'O') > 0),
inv as (select *, cast({_CAPACITY} + tier - self_available - self_locked - self_sold - venue_sold
  - channel_available - channel_sold as bigint) as venue_available,
  cast({_CAPACITY} + tier as bigint) as seats from g)"""
_STATE_COLS = ", ".join(inventory.STATES)


@query(
    "inventory_reconcile_tier",
    f"""{_INV} select strftime(session_ts, {TS}) as session_ts, cast(tier as double) as tier, {_STATE_COLS}, seats
    from inv""",
)
def inventory_reconcile_tier(spark, sf):
    return out(_inventory(spark, sf))


@query(
    "inventory_reconcile_session",
    f"""{_INV} select strftime(session_ts, {TS}) as session_ts,
      {', '.join(f'cast(sum({s}) as bigint) as {s}' for s in inventory.STATES)}
    from inv group by inv.session_ts""",
)
def inventory_reconcile_session(spark, sf):
    return out(inventory.by_session(_inventory(spark, sf)))


_UPCOMING = ["1998-10-01 00:00:00", "1998-11-01 00:00:00", "1999-02-01 00:00:00"]


@query(
    "inventory_upcoming_sessions",
    f"""{_INV} select strftime(session_ts, {TS}) as session_ts, cast(tier as double) as tier, venue_available
    from inv where strftime(session_ts, {TS}) in ({', '.join(q(s) for s in _UPCOMING)})""",
)
def inventory_upcoming_sessions(spark, sf):
    rows = inventory.only_sessions(_inventory(spark, sf), _UPCOMING)
    return out(rows.select("session_ts", "tier", "venue_available"))


@query(
    "anti_join_manifest",
    """select l_shipdate::date::varchar as src_file, count(*) as rows from lineitem
    where l_shipdate not in (select o_orderdate from orders where o_orderpriority = '1-URGENT') group by 1""",
)
def anti_join_manifest(spark, sf):
    files = table(spark, sf, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias(PART))
    manifest = (
        table(spark, sf, "orders")
        .filter("o_orderpriority = '1-URGENT'")
        .select(F.date_format("o_orderdate", "yyyy-MM-dd").alias(PART))
    )
    return ingest.new_files(files, manifest).groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "day_filter_counts",
    f"""{STD} select channel_type, count(*) as rows from std where order_ts >= timestamp '{DAY_SEEN}'
    and order_ts < timestamp '{DAY_SEEN}' + interval 1 day
    and coalesce(channel_type in ('自营', '大客户'), false) group by 1""",
)
def day_filter_counts(spark, sf):
    rows = sales(spark, sf, "order_ts", "channel_type")
    kept = rows.filter(day_window("order_ts", DAY_SEEN) & is_in("channel_type", ["自营", "大客户"]))
    return kept.groupBy("channel_type").agg(F.count(F.lit(1)).alias("rows"))
