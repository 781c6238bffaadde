"""Label lookups, attribution and revenue rules."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.nulls import paste
from ticketlake.operators.lookup import patch_overlay
from ticketlake.operators.rules import RuleSet
from ticketlake.plans import sales as sales_plan

from .base import TS, in_sql, out, pick, pick_sql, q, query, table, values_sql
from .star import NET_SQL, STD, net_revenue, sales

ALL_PRICE_LABELS = [x for labels in dims.PRICE_LABELS.values() for x in labels]
ALL_PACK_LABELS = [x for labels in dims.PACKAGE_LABELS.values() for x in labels]
SEEN_LABELS = [*ALL_PRICE_LABELS, "2000元", "双人套票（980*2）", "280*2"]
PRICE_ROWS = [(x, p) for p, labels in dims.PRICE_LABELS.items() for x in labels]
PACK_ROWS = [(x, n) for n, labels in dims.PACKAGE_LABELS.items() for x in labels]
PRICE_SQL = values_sql(PRICE_ROWS, "p", "label, price")
PACK_SQL = values_sql(PACK_ROWS, "k", "label, packs")


@query(
    "exact_lookup",
    f"""with l as (select nullif({pick_sql(SEEN_LABELS, 'l_partkey')}, '380元') as label, l_quantity from lineitem)
    select l.label, cast(price as double) as price, cast(packs as integer) as packs, count(*) as lines,
      cast(sum(l_quantity) as bigint) as quantity
    from l left join {PRICE_SQL} on l.label = p.label left join {PACK_SQL} on l.label = k.label group by 1, 2, 3""",
)
def exact_lookup(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.nullif(pick(SEEN_LABELS, F.col("l_partkey")), F.lit("380元")).alias("label"), "l_quantity"
    )
    found = dims.price_label(spark).apply(lines, {"label": "label"})
    found = dims.package_label(spark).apply(found, {"label": "label"})
    return found.groupBy("label", "price", "packs").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("long").alias("quantity")
    )


@query(
    "unknown_audit",
    f"""select 'price_label' as ruleset, {pick_sql(SEEN_LABELS, 'l_partkey')} as label, count(*) as rows
    from lineitem where {pick_sql(SEEN_LABELS, 'l_partkey')} not in {in_sql(ALL_PRICE_LABELS)} group by 2""",
)
def unknown_audit(spark, sf):
    lines = table(spark, sf, "lineitem").select(pick(SEEN_LABELS, F.col("l_partkey")).alias("label"))
    return dims.price_label(spark).audit(lines, {"label": "label"})


_AUDITED_SQL = f"""
with l as (select {pick_sql(SEEN_LABELS, 'l_partkey')} as label, l_quantity from lineitem)
select 'price_label' as ruleset, l.label, count(*) as rows, cast(sum(l_quantity) as bigint) as quantity,
  (select count(*) from l join {PRICE_SQL} on l.label = p.label) as priced
from l where l.label not in {in_sql(ALL_PRICE_LABELS)} group by l.label"""


@query("audited_lookup", _AUDITED_SQL)
def audited_lookup(spark, sf):
    """Lookup and audit in one pass over the facts: the audit is what the pass has counted."""
    lines = table(spark, sf, "lineitem").select(pick(SEEN_LABELS, F.col("l_partkey")).alias("label"), "l_quantity")
    rows, audit = dims.price_label(spark).audited(lines, {"label": "label"})
    sums = rows.groupBy("label").agg(
        F.sum("l_quantity").cast("long").alias("quantity"), F.count("price").alias("known")
    )
    total = F.sum("known").over(W.partitionBy()).alias("priced")  # one row per label
    return audit.join(sums.select("label", "quantity", total), "label")


_COMPOSITE = [
    ("1-URGENT", "F", "急", "完"),
    ("1-URGENT", "O", "急", "开"),
    ("2-HIGH", "F", "高", "完"),
    ("5-LOW", "P", "低", "部分"),
    ("1-URGENT", "F", "急件", None),
]


@query(
    "composite_lookup",
    f"""with r as (select *, row_number() over () as n from {values_sql(_COMPOSITE, 'v', 'priority, status, a, b')}),
    w as (select priority, status, arg_max(a, n) filter (a is not null) as a, arg_max(b, n) filter (b is not null) as b
      from r group by 1, 2)
    select o_orderpriority, coalesce(a, '') as a, coalesce(b, '') as b, count(*) as orders
    from orders left join w on o_orderpriority = priority and o_orderstatus = status group by 1, 2, 3""",
)
def composite_lookup(spark, sf):
    rules = RuleSet.of(
        spark, "state", _COMPOSITE, {"priority": "string", "status": "string"},
        {"a": ("string", ""), "b": ("string", "")},
    )
    found = rules.apply(
        table(spark, sf, "orders"), {"priority": "o_orderpriority", "status": "o_orderstatus"}
    )
    return found.groupBy("o_orderpriority", "a", "b").agg(F.count(F.lit(1)).alias("orders"))


# Referral rules over event types: exact, windowed with gaps, overlapping, and one without a date.
REFERRAL = [
    ("view", None, None, "自然销售", None, "自然销售"),
    ("click", None, "2024-01-05 10:00:00", "短信", "2024-01-01", "短信"),
    ("click", "2024-01-05 10:00:00", "2024-01-12 15:00:00", "短信", "2024-01-05", "短信"),
    ("click", "2024-01-14", None, "短信", "2024-01-14", "短信"),
    ("signup", "2024-01-02", "2024-01-20", "推文-开票预告", "2024-01-02", "推文-仅销售"),
    ("signup", "2024-01-10", "2024-01-25", "服务号推文-早鸟", "2024-01-10", "推文-开票"),
    ("signup", "2024-01-12", "2024-01-13", "微博-排练照", None, "微博"),
    ("purchase", None, None, "企微群", "2024-01-03", "企微群"),
    ("purchase", None, None, "大客户-a", None, "大客户"),
]
_REFERRAL_SQL = values_sql(
    [(i, *r) for i, r in enumerate(REFERRAL)], "r", "n, code, lo, hi, detail, action_date, action_type"
)


@query(
    "interval_lookup_last_wins",
    f"""with m as (
      select event_id, ts,
        coalesce(arg_max(detail, n) filter (detail is not null), '其他') as detail,
        coalesce(arg_max(action_date, n) filter (action_date is not null), '') as action_date,
        coalesce(arg_max(action_type, n) filter (action_type is not null), '其他') as action_type
      from events left join {_REFERRAL_SQL} on event_type = code
        and (lo is null or ts >= cast(lo as timestamp)) and (hi is null or ts < cast(hi as timestamp))
      group by 1, 2)
    select strftime(ts, '%Y-%m-%d') as day, detail as channel_detail, action_date, action_type,
      count(*) as events from m group by 1, 2, 3, 4""",
)
def interval_lookup_last_wins(spark, sf):
    events = table(spark, sf, "events").select("event_type", "ts")
    found = sales_plan.attribute(events, dims.referral(spark, REFERRAL), "event_type", "ts")
    return found.groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), "channel_detail", "action_date", "action_type"
    ).agg(F.count(F.lit(1)).alias("events"))


@query(
    "interval_unknown_audit",
    f"""select 'referral' as ruleset, event_type as label, count(*) as rows from events
    where not exists (select 1 from {_REFERRAL_SQL} where event_type = code
      and (lo is null or ts >= cast(lo as timestamp)) and (hi is null or ts < cast(hi as timestamp)))
    group by 2""",
)
def interval_unknown_audit(spark, sf):
    events = table(spark, sf, "events").select("event_type", "ts")
    return dims.referral(spark, REFERRAL).audit(events, {"code": "event_type"}, "ts")


_SESSIONS_SEEN = [x for x, _ in dims.SESSION_LABELS] + ["11.18 19:30", "foo", "12.2 19:30"]
_EXTRA = [("11.18 19:30", "2099-01-01 00:00:00"), ("foo", "2024-02-02 20:00:00")]


@query(
    "first_key_wins_lookup",
    f"""with r as (select *, row_number() over () as n from
        {values_sql([*dims.SESSION_LABELS, *_EXTRA], 'v', 'label, session')}),
    w as (select label, arg_min(session, n) as session from r group by 1)
    select x.label, session as session_ts, count(*) as orders
    from (select {pick_sql(_SESSIONS_SEEN, 'o_orderkey')} as label from orders) x left join w on x.label = w.label
    group by 1, 2""",
)
def first_key_wins_lookup(spark, sf):
    orders = table(spark, sf, "orders").select(pick(_SESSIONS_SEEN, F.col("o_orderkey")).alias("label"))
    found = dims.session_label(spark, _EXTRA).apply(
        orders, {"label": "label"}, into={"session": "session_ts"}
    )
    return out(found.groupBy("label", "session_ts").agg(F.count(F.lit(1)).alias("orders")))


DETAILS = [
    "推文-开票", "服务号推文-早鸟", "微博-定妆照", "企微群-早鸟", "小七点对点-上海", "培训-企微朋友圈-早鸟",
    "朋友圈-早鸟", "订阅号-MA", "服务号展示-MOR", "自然销售", "小七自动回复", "公众号展示-北京",
]
ACCOUNT_CASE = (
    "case when starts_with(detail, '微博') then '微博' "
    "when starts_with(detail, '企微群') or starts_with(detail, '小七点对点') or starts_with(detail, '培训-企微朋友圈') "
    "or starts_with(detail, '小七自动回复') or starts_with(detail, '企微朋友圈') or starts_with(detail, '培训企微群') "
    "or starts_with(detail, '培训点对点') then '企微' "
    "when starts_with(detail, '服务号推文') or detail in ('服务号-MOR', '服务号-MA', '服务号展示-MA', '服务号展示-MOR') then '服务号' "
    "when starts_with(detail, '推文') or detail in ('订阅号-MOR', '订阅号-MA', '公众号展示-上海', '公众号展示-北京', "
    "'公众号展示-深圳', '订阅号展示-MA', '订阅号展示-MOR') then '订阅号' else '无' end"
)


@query(
    "prefix_attribution",
    f"""with d as (select {pick_sql(DETAILS, 'l_partkey')} as detail, {NET_SQL} as net_revenue from lineitem)
    select detail, {ACCOUNT_CASE} as account, count(*) as lines, cast(sum(net_revenue) as double) as revenue
    from d group by 1, 2""",
)
def prefix_attribution(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        pick(DETAILS, F.col("l_partkey")).alias("detail"), net_revenue().alias("net_revenue")
    )
    sums = lines.groupBy("detail").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("net_revenue").alias("revenue")
    )
    return out(sums.withColumn("account", sales_plan.owning_account("detail")))


# --------------------------------------------------------------------------- revenue multipliers
_DIRECT_NAMES = ["分销-a", "c", "ikids", "大客户-施耐德", "菁kids", "自然销售", "一起旅课"]
_DIRECT_TYPES = ["自营", "大客户", "分销-系统"]
_PRODUCTIONS = ["MA", "MOR", "NTN"]
_DIRECT_SQL = (
    "case when name in ('分销-a', 'c', 'b', 'd', 'e') and production = 'MA' and price >= 780 then 0.9 "
    "when name in ('分销-a', 'c', 'b', 'd', 'e') and production = 'MA' and price < 780 then 1.0 "
    "when name in ('分销-a', 'c', 'b', 'd', 'e') and production = 'MOR' then 0.9 "
    "when name = 'ikids' and production = 'MOR' then 1.0 "
    "when name in ('带上屁孩去旅行', '北京剧中人', '一起旅课', '菁kids', '培训-嘉宝-EDM') then 1.0 "
    "when name = '大客户-施耐德' then 0.5 when type in ('自营', '大客户') then 1.0 end"
)


def _priced(names: list[str]):
    return f"""select {pick_sql(names, 'l_partkey')} as name, {pick_sql(_DIRECT_TYPES, 'l_suppkey')} as type,
      {pick_sql(_PRODUCTIONS, 'l_orderkey')} as production, p_retailprice - 180 as price
    from lineitem join part on l_partkey = p_partkey"""


def _priced_rows(spark, sf, names):
    return (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            pick(names, F.col("l_partkey")).alias("channel_detail"),
            pick(_DIRECT_TYPES, F.col("l_suppkey")).alias("channel_type"),
            pick(_PRODUCTIONS, F.col("l_orderkey")).alias("production"),
            (F.col("p_retailprice") - 180).alias("face_price"),
        )
    )


@query(
    "revenue_rule_range",
    f"""with x as ({_priced(_DIRECT_NAMES)})
    select name as channel_detail, type as channel_type, production, cast({_DIRECT_SQL} as double) as rate,
      count(*) as lines from x group by 1, 2, 3, 4""",
)
def revenue_rule_range(spark, sf):
    rows = sales_plan.direct_rate(_priced_rows(spark, sf, _DIRECT_NAMES), F.col("production"))
    return rows.groupBy("channel_detail", "channel_type", "production", "rate").agg(
        F.count(F.lit(1)).alias("lines")
    )


_DIST_NAMES = ["三叶草-深圳", "一起旅课", "大客户-a", "自然销售", "分销系统-未知", "培训-嘉宝-EDM", "zz"]
_DIST_REBATE = in_sql(dims.DISTRIBUTOR_REBATE_NAMES)
_DIST_SQL = (
    "case when name in ('一起旅课', '培训-嘉宝-EDM') then 1.0 "
    f"when name in {_DIST_REBATE} and production = 'MA' and price >= 780 then 0.9 "
    f"when name in {_DIST_REBATE} and production = 'MA' and price < 780 then 1.0 "
    f"when name in {_DIST_REBATE} and production = 'MOR' then 0.9 "
    "when name in ('大客户-a', '大客户-b', '大客户-c', '大客户-d', '自然销售', '分销系统-未知') then 1.0 end"
)


@query(
    "distributor_rule_range",
    f"""with x as ({_priced(_DIST_NAMES)})
    select name as channel_detail,
      case when name in {_DIST_REBATE} then '分销-系统' when starts_with(name, '大客户-') then '大客户'
        when name in ('自然销售', '分销系统-未知') then '自营' else '' end as channel_type,
      production, cast({_DIST_SQL} as double) as rate, count(*) as lines from x group by 1, 2, 3, 4""",
)
def distributor_rule_range(spark, sf):
    rows = _priced_rows(spark, sf, _DIST_NAMES).drop("channel_type")
    rated = sales_plan.distributor_rate(rows, F.col("production"))
    return rated.groupBy("channel_detail", "channel_type", "production", "rate").agg(
        F.count(F.lit(1)).alias("lines")
    )


_TICKETS_SEEN = [x for _, _, labels in dims.TICKET_TYPES for x in labels] + ["原价380元", "原价1280元", "foo"]
_TICKET_ROWS = [(x, p, n) for p, n, labels in dims.TICKET_TYPES for x in labels]


@query(
    "ticket_type_price",
    f"""with x as (select {pick_sql(_TICKETS_SEEN, 'l_partkey')} as label from lineitem)
    select x.label,
      cast(coalesce(t.price, try_cast(nullif(regexp_extract(x.label, '^原价([0-9]+)元$', 1), '') as double), 0) as double)
        as face_price,
      cast(coalesce(t.n, case when regexp_matches(x.label, '^原价[0-9]+元$') then 1 end, 0) as double) as tickets,
      count(*) as lines
    from x left join {values_sql(_TICKET_ROWS, 't', 'label, price, n')} on x.label = t.label group by 1, 2, 3""",
)
def ticket_type_price(spark, sf):
    rows = table(spark, sf, "lineitem").select(pick(_TICKETS_SEEN, F.col("l_partkey")).alias("label"))
    priced = sales_plan.ticket_price(rows, "label")
    return priced.groupBy("label", "face_price", "tickets").agg(F.count(F.lit(1)).alias("lines"))


_ALIASES = [
    ("订阅号", "red widget", "推文-红"),
    ("服务号", "red widget", "服务号推文-红"),
    ("订阅号", "blue bolt", "推文-蓝"),
    ("订阅号", "blue bolt", "推文-蓝2"),
]


@query(
    "article_alias",
    f"""with p as (select p_name as title, {pick_sql(['订阅号', '服务号'], 'p_partkey')} as account from part)
    select account, title, case when account = '订阅号' and title = 'red widget' then '推文-红'
      when account = '服务号' and title = 'red widget' then '服务号推文-红'
      when account = '订阅号' and title = 'blue bolt' then '推文-蓝2' else title end as short, count(*) as parts
    from p group by 1, 2""",
)
def article_alias(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_name").alias("title"), pick(["订阅号", "服务号"], F.col("p_partkey")).alias("account")
    )
    named = sales_plan.article_name(rows, dims.article_alias(spark, _ALIASES), "title", "account", "short")
    return named.groupBy("account", "title", "short").agg(F.count(F.lit(1)).alias("parts"))


@query(
    "project_venue",
    f"""with cal as (select * from {values_sql(dims.CALENDAR, 'c', 'production, session, project, venue')}),
    x as (select {pick_sql(['MA', 'MOR'], 'event_id')} as production,
      strftime(timestamp '2023-11-01' + to_days(cast(event_id % 92 as integer)), '%Y-%m-%d') ||
        {pick_sql([' 14:30:00', ' 19:30:00', ' 14:00:00'], 'user_id')} as session from events)
    select x.production, x.session as session_ts, coalesce(project, '') as project, coalesce(venue, '') as venue,
      count(*) as rows
    from x left join cal on x.production = cal.production and x.session = cal.session group by 1, 2, 3, 4""",
)
def project_venue(spark, sf):
    day = F.date_add(F.lit("2023-11-01").cast("date"), (F.col("event_id") % 92).cast("int"))
    clock = pick([" 14:30:00", " 19:30:00", " 14:00:00"], F.col("user_id"))
    rows = table(spark, sf, "events").select(
        pick(["MA", "MOR"], F.col("event_id")).alias("production"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), clock).cast("timestamp_ntz").alias("session_ts"),
    )
    found = sales_plan.project_venue(rows)
    return out(
        found.groupBy("production", "session_ts", "project", "venue").agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "seat_capacity",
    f"""with cap as (select * from {values_sql(
        [(p, f'{d} {start}:00', t, n) for p, d, start, t, n in (
            ('MA', '2023-11-17', '19:30', 1080, 355), ('MA', '2023-11-21', '19:30', 1180, 143),
            ('MA', '2024-01-27', '14:30', 180, 126), ('MOR', '2023-12-17', '19:30', 980, 90),
            ('MOR', '2023-12-17', '14:30', 1180, 90), ('MOR', '2023-11-26', '20:00', 880, 210))],
        'c', 'production, session, tier, seats')}),
    x as (select *, row_number() over (order by production, session, tier) - 1 as i from cap)
    select production, session as session_ts, cast(tier as double) as tier, cast(seats as bigint) as seats,
      count(*) as rows
    from events join x on event_id % 6 = i group by 1, 2, 3, 4""",
)
def seat_capacity(spark, sf):
    # Six known places in the seat plan, spread over the events.
    spots = [
        "MA|2023-11-17 19:30:00|1080", "MA|2023-11-21 19:30:00|1180", "MA|2024-01-27 14:30:00|180",
        "MOR|2023-11-26 20:00:00|880", "MOR|2023-12-17 14:30:00|1180", "MOR|2023-12-17 19:30:00|980",
    ]
    part = F.split(pick(spots, F.col("event_id")), r"\|")
    rows = table(spark, sf, "events").select(
        part[0].alias("production"),
        part[1].cast("timestamp_ntz").alias("session_ts"),
        part[2].cast("decimal(18,4)").alias("tier"),
    )
    keys = ["production", "session_ts", "tier"]
    seated = dims.seat_capacity(spark).apply(rows, {k: k for k in keys})
    return out(seated.groupBy(*keys, "seats").agg(F.count(F.lit(1)).alias("rows")))


_PATCHED = "o_orderpriority = '1-URGENT' and o_orderstatus = 'P'"


@query(
    "patch_overlay",
    f"""select case when {_PATCHED} then 'patched-' || (o_custkey % 7) else o_orderpriority end as code,
      count(*) as orders from orders group by 1""",
)
def patch_overlay_query(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("code")
    )
    patches = (
        table(spark, sf, "orders")
        .filter(_PATCHED)
        .select("o_orderkey", F.concat(F.lit("patched-"), F.col("o_custkey") % 7).alias("code"))
    )
    # A repeated patch line must not repeat the order, and the first one listed wins.
    twice = patches.withColumn("line", F.lit(1)).unionByName(
        patches.select("o_orderkey", F.lit("a later patch").alias("code"), F.lit(2).alias("line"))
    )
    return patch_overlay(orders, twice, "o_orderkey", "code", order="line").groupBy("code").agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    "half_price_tag",
    """with x as (select case when l_linenumber = 1 then null when l_linenumber <= 3 then 0.5 * l_extendedprice
        else l_discount * l_extendedprice end as d, l_extendedprice as p, l_shipdate as t,
        case when l_returnflag = 'N' then '-' else l_returnflag end as c from lineitem)
    select case when not coalesce(t >= timestamp '1998-01-01' and c = '-', true) then c
        when d is null then case when t >= timestamp '1998-01-01' and c = '-' then null else c end
        when abs(d - 0.5 * p) < 1e-9 and t >= timestamp '1998-01-01' and c = '-' then 'ikids' else c end as code,
      strftime(t, '%Y') as year, count(*) as lines from x group by 1, 2""",
)
def half_price_tag(spark, sf):
    n = F.col("l_linenumber")
    lines = table(spark, sf, "lineitem").select(
        F.when(n == 1, F.lit(None))
        .when(n <= 3, 0.5 * F.col("l_extendedprice"))
        .otherwise(F.col("l_discount") * F.col("l_extendedprice"))
        .alias("discount"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("at"),
        F.when(F.col("l_returnflag") == "N", "-").otherwise(F.col("l_returnflag")).alias("code"),
    )
    tagged = sales_plan.half_price_tag(lines, "code", "discount", "price", "at", "1998-01-01")
    return tagged.groupBy("code", F.date_format("at", "yyyy").alias("year")).agg(
        F.count(F.lit(1)).alias("lines")
    )


@query(
    "distinct_pairs",
    """select o_orderpriority as code, count(*) as pairs from
    (select distinct o_custkey, o_orderpriority from orders where o_orderpriority <> '4-NOT SPECIFIED') group by 1""",
)
def distinct_pairs(spark, sf):
    pairs = (
        table(spark, sf, "orders")
        .select("o_custkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("code"))
        .filter(F.col("code").isNotNull())
        .distinct()
    )
    return pairs.groupBy("code").agg(F.count(F.lit(1)).alias("pairs"))


@query(
    "paste_na_distinct",
    f"""{STD} select project, count(distinct strftime(order_ts, {TS}) || ' ' ||
      coalesce(nullif(recipient_phone, '7'), 'NA') || ' ' || coalesce(channel_detail, 'NA')) as orders
    from std group by 1""",
)
def paste_na_distinct(spark, sf):
    rows = sales(spark, sf, "project", "order_ts", "recipient_phone", "channel_detail")
    key = paste("order_ts", F.nullif("recipient_phone", F.lit("7")), "channel_detail")
    return rows.groupBy("project").agg(F.countDistinct(key).alias("orders"))


_BULK_SLOTS = ["2023-12-02 午场", "2023-11-03 晚场", "2023-01-03 晚场", "2023-12-16 午场", "foo", "2023-11-25 午场"]
_BULK_GENERAL = {
    "2023-12-02 午场": "2023-12-02 14:00:00", "2023-11-03 晚场": "2023-11-03 19:30:00",
    "2023-01-03 晚场": "2024-01-03 19:30:00", "2023-12-16 午场": "2023-12-16 14:30:00",
    "2023-11-25 午场": "2023-11-25 15:00:00",
}
_BULK_MA = {"2023-12-02 午场": "2023-12-02 14:30:00", "2023-11-25 午场": "2023-11-25 14:30:00"}


def _slot_case() -> str:
    own = " ".join(f"when production = 'MA' and slot = {q(k)} then {q(v)}" for k, v in _BULK_MA.items())
    general = " ".join(f"when slot = {q(k)} then {q(v)}" for k, v in _BULK_GENERAL.items())
    return f"case {own} {general} end"


@query(
    "bulk_slot_session",
    f"""with x as (select {pick_sql(_BULK_SLOTS, 'o_orderkey')} as slot, {pick_sql(['MA', 'MOR'], 'o_custkey')} as production
      from orders)
    select production, slot, {_slot_case()} as session_ts, count(*) as orders from x group by 1, 2, 3""",
)
def bulk_slot_session(spark, sf):
    from ticketlake.plans.channels import bulk_session

    rows = table(spark, sf, "orders").select(
        pick(_BULK_SLOTS, F.col("o_orderkey")).alias("slot"),
        pick(["MA", "MOR"], F.col("o_custkey")).alias("production"),
    )
    found = bulk_session(rows, "slot", "production")
    return out(
        found.groupBy("production", "slot", "session_ts").agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "poly_session_label",
    f"""with x as (select {pick_sql([x for x, _ in dims.POLY_SESSIONS] + ['foo'], 'o_orderkey')} as label from orders)
    select x.label, session as session_ts, count(*) as orders
    from x left join {values_sql(dims.POLY_SESSIONS, 's', 'label, session')} on x.label = s.label group by 1, 2""",
)
def poly_session_label(spark, sf):
    labels = [x for x, _ in dims.POLY_SESSIONS] + ["foo"]
    rows = table(spark, sf, "orders").select(pick(labels, F.col("o_orderkey")).alias("label"))
    found = dims.labelled_sessions(spark, "poly_session", dims.POLY_SESSIONS).apply(
        rows, {"label": "label"}, into={"session": "session_ts"}
    )
    return out(found.groupBy("label", "session_ts").agg(F.count(F.lit(1)).alias("orders")))
