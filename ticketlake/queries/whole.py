"""Whole pipelines: all order layers, all tour sources, all inventory systems, and reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.operators.position import ORDER, PART
from ticketlake.plans import channels as ch
from ticketlake.plans import daily, inventory
from ticketlake.plans import sales as sales_plan
from ticketlake.session import written

from . import channels as q_channels
from .base import MONEY, REGISTRY, TS, out, pick, q, query, table, values_sql
from .channels import cell_grid, day_text, digest, text
from .scalars import venue_sales


# ---- the SQL of a layer, row by row, from the SQL of its own query
def _items(select: str) -> dict[str, str]:
    """Output name to expression of a select list."""
    found, depth, start = [], 0, 0
    for i, c in enumerate(select + ","):
        depth += (c in "([") - (c in ")]")
        if c == "," and depth == 0:
            found.append(select[start:i].strip())
            start = i + 1
    return {item.rsplit(" as ", 1)[-1].strip() if " as " in item else item: item.rsplit(" as ", 1)[0].strip() for item in found}


def _summed(expression: str) -> str:
    """What the first sum of an expression adds up."""
    start = expression.index("sum(") + 4
    depth = 1
    for i in range(start, len(expression)):
        depth += (expression[i] == "(") - (expression[i] == ")")
        if not depth:
            return expression[start:i]
    raise ValueError(expression)


def _rows_sql(name: str, **given: str) -> str:
    """The rows behind a query's sums: (given columns, session_ts as text, face_price, tickets, net_revenue)."""
    sql = REGISTRY[name].sql
    cut = sql.rindex("\n    select ")
    ctes, last = sql[:cut], sql[cut + len("\n    select ") :]
    split = last.index("\n    from ") if "\n    from " in last else last.index(" from x")
    items, source = _items(last[:split]), last[split : last.rindex(" group by")]
    columns = {**{k: v for k, v in items.items() if k in ("channel_type", "channel_detail", "session_ts", "order_ts", "face_price")}, **given}
    columns["tickets"], columns["net_revenue"] = _summed(items["tickets"]), f"cast({_summed(items['revenue'])} as {MONEY})"
    return f"({ctes} select {', '.join(f'{v} as {k}' for k, v in columns.items())}{source})"


# ---- all layers of orders
_REPORTED = q(ch.DIST_REPORTED)
_LAYERS = [
    (q_channels.channel_block_report, [{}], {}),
    (q_channels.channel_preamble_report, [{}], {}),
    (q_channels.channel_platform_orders, [{}], {}),
    (q_channels.channel_merged_cell_orders, [{}], {}),
    (q_channels.channel_pickup_orders, [{}], {}),
    (q_channels.channel_spec_orders, [{}], {}),
    *[
        (q_channels.channel_dotted_orders, [{"detail": f"247-{city}"}], {"channel_type": _REPORTED, "channel_detail": q(f"247-{city}")})
        for city in ("北京", "上海", "深圳")
    ],
    (q_channels.channel_worded_orders, [{}], {}),
    *[(q_channels.channel_show_orders, [{}], {}) for _ in range(3)],
    (q_channels.channel_standard_orders, [{}], {}),
]
_LAYER_SQL = " union all ".join(
    f"select channel_type, channel_detail, session_ts, tickets, net_revenue from {_rows_sql(fn.__name__, **given)}"
    for fn, _, given in _LAYERS
)


@query(
    "etl_all_layers",
    f"""with u as ({_LAYER_SQL})
    select 'MA' as production, channel_type, channel_detail, session_ts, count(*) as lines,
      cast(sum(tickets) as bigint) as tickets, cast(coalesce(sum(net_revenue), 0) as double) as revenue
    from u where session_ts is not null and tickets > 0 group by 2, 3, 4""",
)
def etl_all_layers(spark, sf):
    """Every order layer in one wide table: three cities of one source, three of another, and all standard channels."""
    parts = [fn(spark, sf, rows=True, **args) for fn, (args,), _ in _LAYERS]
    return digest(ch.load_wide(parts, "MA"), "production", "channel_type", "channel_detail", "session_ts")


# ---- all sources of the tour
_VENUES = [("Brand#1", "北京站"), ("Brand#2", "上海站"), ("1-URGENT", "猫眼站"), ("剧院", "巡演站")]
_TOUR_SQL = f"""with {q_channels._DIRECT_SRC}, u as (
    select p_brand as venue, channel_type, cast(order_ts as date) as day, 1 as tickets, cast(settled as {MONEY}) as net_revenue,
      session_ts is not null as seen from attributed where production = 'NTN'
    union all
    select o_orderpriority, '票务网站', cast(o_orderdate as date), cast(o_custkey % 6 as integer), cast(o_totalprice as {MONEY}), true
    from orders join customer on o_custkey = c_custkey where c_nationkey % 4 <> 3
    {''.join(f" union all select '剧院', '剧场', cast(cast(order_ts as timestamp) as date), tickets, net_revenue, session_ts is not null from {_rows_sql(name)}"
             for name in ("channel_graded_report", "channel_section_report", "channel_summary_report"))}),
  master as (select case venue {' '.join(f'when {q(v)} then {q(p)}' for v, p in _VENUES)} end as project, * from u where seen)"""


def _tour(spark, sf) -> DataFrame:
    """Own orders, the platform's three cities, and the reports of three venues."""
    productions = dims.text_map(spark, "production", q_channels._PROJECTS, sales_plan.UNKNOWN)
    direct = sales_plan.tour_direct_sales(
        q_channels._tagged_since(spark, sf), productions, dims.referral(spark, q_channels._DIRECT_RULES), q_channels._SINCE
    )
    platform = q_channels.channel_tour_platform_orders(spark, sf, rows=True)
    reports = [
        fn(spark, sf, rows=True)
        for fn in (q_channels.channel_graded_report, q_channels.channel_section_report, q_channels.channel_summary_report)
    ]
    return sales_plan.tour_master([direct, platform, *reports], dims.text_map(spark, "venue_project", _VENUES))


@query(
    "tour_all_sources",
    f"""{_TOUR_SQL} select project, venue, channel_type, count(*) as lines, cast(sum(tickets) as bigint) as tickets,
      cast(coalesce(sum(net_revenue), 0) as double) as revenue from master group by 1, 2, 3""",
)
def tour_all_sources(spark, sf):
    """The tour's master table from all seven sources."""
    return digest(_tour(spark, sf), "project", "venue", "channel_type")


@query(
    "tour_daily_report",
    f"""{_TOUR_SQL} select strftime(day, '%Y-%m-%d') as order_day,
      case when channel_type in ('分销-系统', '分销-报单') then '分销' else channel_type end as channel_group, project,
      cast(sum(tickets) as bigint) as tickets, cast(coalesce(sum(net_revenue), 0) as double) as revenue from master group by 1, 2, 3""",
)
def tour_daily_report(spark, sf):
    """The daily report over the master table of all sources."""
    return out(daily.daily_summary_all_days(_tour(spark, sf)))


# ---- all inventory systems
_TOUR_SEATS = [(s, t, n) for sessions, seats in dims.TOUR_GROUPS for s in sessions for t, n in seats]
_SESSIONS = sorted({s for s, _, _ in _TOUR_SEATS})
_TIERS = [880, 680, 480, 280]
_CANCELLED = "2024-02-24 15:00:00"
_AT = [*_SESSIONS, _CANCELLED]
_SEATS_SQL = values_sql(_TOUR_SEATS, "cap", "session_ts, tier, seats")


def _at_sql(key: str = "l_orderkey") -> str:
    return f"([{', '.join(q(s) for s in _AT)}])[cast({key} % {len(_AT)} as integer) + 1]"


def _own(spark, sf) -> DataFrame:
    """The own system: one row per session and tier."""
    rows = table(spark, sf, "lineitem").groupBy(
        pick(_AT, F.col("l_orderkey")).alias("场次时间"), pick([str(t) for t in _TIERS], F.col("l_partkey")).alias("票档")
    )
    sums = rows.agg(
        text(F.count(F.lit(1))).alias("剩余数"), text(F.sum("l_linenumber")).alias("预留数"),
        text(F.sum("l_quantity").cast("long")).alias("售出数"),
    )
    # The source has one start time with seconds.
    wrong = {right: wrong for wrong, right in inventory.SESSION_FIXES.items()}
    at = F.col("场次时间")
    for right, seen in wrong.items():
        at = F.when(at == right, seen).otherwise(at)
    return inventory.self_inventory(sums.withColumns({"场次时间": at, "演出名称": F.lit("NTN")}), ["NTN"])


def _summed_orders(spark, sf, *more) -> DataFrame:
    return table(spark, sf, "orders").groupBy(
        pick(_AT, F.col("o_orderkey")).alias("at"), (F.col("o_custkey") % 4).alias("g"), *more
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_orderkey") % 5).alias("m"))


def _sheets(spark, sf) -> DataFrame:
    """The platform's sheets, one per session."""
    rows = _summed_orders(spark, sf).withColumns(
        {
            PART: F.concat(F.lit("in/"), F.substring("at", 1, 10), F.lit(" 周五 "), F.replace(F.substring("at", 12, 5), F.lit(":"), F.lit("-")), F.lit("/s.csv")),
            ORDER: F.col("g") + 2,
        }
    )
    label = F.concat(pick([str(t) for t in _TIERS], F.col("g")), F.lit("元"))
    return inventory.platform_inventory(cell_grid(rows, 17, {1: label, 3: F.col("n"), 17: F.col("m")}))


def _summary(spark, sf) -> DataFrame:
    """The first venue's summary report: a session a row, two tiers."""
    events = table(spark, sf, "events").select(pick(_AT, F.col("event_id")).alias("at"), "user_id")
    rows = events.groupBy("at").agg(F.sum(F.col("user_id") % 3).alias("n"), F.sum(F.col("user_id") % 2).alias("m"))
    place = F.array_position(F.array(*[F.lit(s) for s in _AT]), F.col("at"))
    body = rows.select(
        (place + 1).alias(ORDER), F.date_format(F.col("at").cast("timestamp_ntz"), "yyyy年MM月dd日 HH:mm:ss").alias("session"), "n", "m"
    )
    head = body.groupBy().agg(F.count(F.lit(1)).alias("k")).filter("k > 0").select(F.lit(1).cast("bigint").alias(ORDER))
    both = body.unionByName(head, allowMissingColumns=True).withColumn(PART, F.lit("x/s.csv"))
    at_head = F.col(ORDER) == 1
    cells = {i: F.when(at_head, f"h{i}").otherwise("v") for i in (1, 3, 4, 6, 8)}
    cells |= {2: F.when(at_head, "场次").otherwise(F.col("session")), 5: F.when(at_head, "h5").otherwise(text("n")), 7: F.when(at_head, "h7").otherwise(text("m"))}
    return inventory.summary_inventory(cell_grid(both, 10, cells))


def _section(spark, sf) -> DataFrame:
    """The second venue's report: a section a session, a row a tier."""
    sums = _summed_orders(spark, sf)
    body = sums.select("at", (F.col("g") + 1).alias("k"), pick(ch.SECTION_TIERS, F.col("g")).alias("label"), "n", "m")
    heads = sums.select("at").distinct().select("at", F.lit(0).cast("bigint").alias("k"), F.concat(F.lit("场次时间："), F.col("at")).alias("label"))
    place = F.array_position(F.array(*[F.lit(s) for s in _AT]), F.col("at"))
    rows = body.unionByName(heads, allowMissingColumns=True).withColumns({PART: F.lit("x/g.xlsx"), ORDER: place * 10 + F.col("k")})
    return inventory.section_inventory(cell_grid(rows, 15, {1: F.col("label"), 6: F.col("n"), 15: F.col("m")}))


def _graded(spark, sf) -> DataFrame:
    """The third venue's report: a session a row, four graded tiers."""
    cells = []
    for i, grade in enumerate(ch.GRADES):
        sold = F.sum(F.when(F.col("g") == i, F.col("n")))
        cells += [
            F.lit(str(_TIERS[i])).alias(f"{grade}_票价"), text(F.coalesce(sold, F.lit(0))).alias(f"{grade}_已售数量"),
            F.lit("1").alias(f"{grade}_已售金额"),
        ]
    raw = _summed_orders(spark, sf).groupBy("at").agg(*cells)
    return inventory.graded_inventory(raw.withColumnRenamed("at", "演出时间").withColumn(PART, F.lit("x/b.xlsx")))


# The rows of the three venues, as their queries give them.
_SECTION_PRICES = [float(x[: x.index("元")]) for x in ch.SECTION_TIERS]
_O_SUMS = f"""o as (select {_at_sql('o_orderkey')} as sess, o_custkey % 4 as g, count(*) as n, sum(o_orderkey % 5) as m
    from orders group by 1, 2),
  e as (select {_at_sql('event_id')} as sess, sum(user_id % 3) as n, sum(user_id % 2) as m from events group by 1)"""
_SUMMARY_SQL = "(select sess, 680.0 as tier, n as sold from e union all select sess, 880.0, m from e)"
_SECTION_SQL = f"(select sess, ([{', '.join(map(str, _SECTION_PRICES))}])[cast(g as integer) + 1] as tier, m as available, n as sold from o)"
_GRADED_SQL = f"""(select a.sess, t.tier, coalesce(o.n, 0) as sold from (select distinct sess from o) a
    cross join {values_sql(list(enumerate(_TIERS)), 't', 'g, tier')} left join o on o.sess = a.sess and o.g = t.g)"""


@query(
    "inventory_venue_reports",
    f"""with {_O_SUMS}
    select 'summary' as report, sess as session_ts, cast(tier as double) as tier, cast(null as bigint) as venue_available, cast(sold as bigint) as venue_sold from {_SUMMARY_SQL}
    union all select 'section', sess, tier, cast(available as bigint), cast(sold as bigint) from {_SECTION_SQL}
    union all select 'graded', sess, tier, null, cast(sold as bigint) from {_GRADED_SQL}""",
)
def inventory_venue_reports(spark, sf):
    """The inventories that three venues report, each in its own form."""
    parts = []
    for name, rows in (("summary", _summary(spark, sf)), ("section", _section(spark, sf)), ("graded", _graded(spark, sf))):
        found = rows if "venue_available" in rows.columns else rows.withColumn("venue_available", F.lit(None).cast("double"))
        parts.append(
            found.select(
                F.lit(name).alias("report"), "session_ts", "tier", F.col("venue_available").cast("long"), F.col("venue_sold").cast("long")
            )
        )
    return out(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query(
    "inventory_all_systems",
    f"""with {_O_SUMS},
    own as (select {_at_sql()} as sess, ([{', '.join(map(str, _TIERS))}])[cast(l_partkey % 4 as integer) + 1] as tier,
      count(*) as a, sum(l_linenumber) as l, sum(l_quantity) as s from lineitem group by 1, 2),
    sheets as (select sess, ([{', '.join(map(str, _TIERS))}])[cast(g as integer) + 1] as tier, m as available, n as sold from o),
    joined as (
      select own.sess, own.tier, a, l, s, coalesce(v.sold, 0) as vs, coalesce(p.available, 0) as ca, coalesce(p.sold, 0) as cs
      from own left join {_SUMMARY_SQL} v on own.sess = v.sess and own.tier = v.tier
        left join sheets p on own.sess = p.sess and own.tier = p.tier
      union all select sess, tier, 0, 0, 0, sold, 0, 0 from {_SECTION_SQL}
      union all select sess, tier, 0, 0, 0, sold, 0, 0 from {_GRADED_SQL}),
    sums as (select sess, tier, cast(sum(a) as bigint) as self_available, cast(sum(l) as bigint) as self_locked,
        cast(sum(s) as bigint) as self_sold, cast(sum(vs) as bigint) as venue_sold, cast(sum(ca) as bigint) as channel_available,
        cast(sum(cs) as bigint) as channel_sold from joined where sess <> '{_CANCELLED}' group by 1, 2)
    select sums.sess as session_ts, cast(sums.tier as double) as tier, self_available, self_locked, self_sold,
      cast(seats - self_available - self_locked - self_sold - venue_sold - channel_available - channel_sold as bigint) as venue_available,
      venue_sold, channel_available, channel_sold, cast(seats as bigint) as seats
    from sums left join {_SEATS_SQL} on sums.sess = cap.session_ts and sums.tier = cap.tier""",
)
def inventory_all_systems(spark, sf):
    """Own system, platform and three venues against the 60 seat counts of the tour."""
    combined = inventory.combine(
        _own(spark, sf), [_summary(spark, sf), _sheets(spark, sf)], [_section(spark, sf), _graded(spark, sf)]
    )
    tiers = inventory.by_tier(combined, dims.session_table(spark, [_CANCELLED]))
    return out(inventory.reconcile(tiers, dims.tour_capacity(spark)))


# ---- sell-through over sales and venue reports
@query(
    "sell_through_all",
    f"""with {q_channels._DIRECT_SRC}, sold as (
      select production, session_ts, cast(price as decimal(18,4)) as tier, 1 as tickets, cast(cast(settled as decimal(12,2)) * cast(rate as decimal(2,1)) as {MONEY}) as revenue
      from rated where production <> 'test'
      union all select 'MA', l_shipdate + interval 1170 minute, 280 + 200 * (l_partkey % 4), sum(l_quantity), sum(cast(l_extendedprice as decimal(18,2)))
      from lineitem group by l_shipdate, l_partkey % 4),
    asked as (select distinct 'MA' as production, l_shipdate + interval 1170 minute as session_ts,
        cast(t.tier as decimal(18,4)) as tier from lineitem, (select unnest([280, 680, 880, 1280]) as tier) t)
    select a.production, strftime(a.session_ts, {TS}) as session_ts, cast(a.tier as double) as tier,
      case when count(s.production) = 0 then 0 else cast(sum(s.tickets) as bigint) end as tickets,
      case when count(s.production) = 0 then 0 when count(s.revenue) < count(s.production) then null else cast(sum(s.revenue) as double) end as revenue
    from asked a left join sold s on a.production = s.production and a.session_ts = s.session_ts and a.tier = s.tier group by a.production, a.session_ts, a.tier""",
)
def sell_through_all(spark, sf):
    """Sell-through over the sales united with what the venues report."""
    productions = dims.text_map(spark, "production", q_channels._PROJECTS, sales_plan.UNKNOWN)
    direct = sales_plan.direct_sales(
        q_channels._tagged_since(spark, sf), productions, dims.referral(spark, q_channels._DIRECT_RULES), q_channels._SINCE
    )
    columns = ["production", "session_ts", "face_price", "tickets", "net_revenue"]
    venue = written(venue_sales(spark, sf), "venue-sales")
    sold = daily.all_sold([direct.select(*columns), venue.select(*columns)])
    days = venue.select("production", "session_ts").distinct()
    asked = days.withColumn("tier", F.explode(F.array(*[F.lit(t).cast("decimal(18,4)") for t in (280, 680, 880, 1280)])))
    return out(daily.sell_through(asked, sold))
