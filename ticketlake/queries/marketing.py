"""Followers, content, weekly report and streaming twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.nulls import strict_sum
from ticketlake.operators import position
from ticketlake.operators.position import ORDER, PART
from ticketlake.operators.rules import RuleSet
from ticketlake.plans import channels as ch
from ticketlake.plans import weekly
from ticketlake.plans.daily import channel_group, totals
from ticketlake.schema import CONTENT_SCHEMA, FOLLOWERS_SCHEMA, SALES_SCHEMA, conform
from ticketlake.session import shared_dir, written
from ticketlake.streaming import flows

from .base import TS, out, pick, pick_sql, q, query, stream_of, table, values_sql
from .rules import _REFERRAL_SQL, ACCOUNT_CASE, DETAILS, REFERRAL
from .star import CHANNEL_GROUPS, NET_SQL, net_revenue

START, END = "2024-01-15", "2024-01-22"
# Accounts of the events table: one per event type.
KINDS = [
    ("微信", "view", weekly.ARTICLES),
    ("微信", "click", weekly.VIDEOS),
    ("微信", "signup", weekly.SERVICE),
    ("微博", "error", weekly.POSTS),
    ("微博", "purchase", weekly.POSTS),
    ("b站", "nobody", weekly.ARTICLES),
    ("b站", "somebody", weekly.VIDEOS),
]
_PLATFORM_SQL = "case when event_type in ('error', 'purchase') then '微博' else '微信' end"


def _platform() -> Column:
    return F.when(F.col("event_type").isin("error", "purchase"), "微博").otherwise("微信")


def content(spark, sf) -> DataFrame:
    """Events as content items."""
    return conform(
        table(spark, sf, "events").select(
            _platform().alias("platform"),
            F.col("event_type").alias("account"),
            F.col("ts").alias("published_at"),
            F.floor("value").alias("views"),
            F.nullif(F.col("user_id") % 50, F.lit(7)).alias("interactions"),
            (F.col("event_id") % 11).alias("shares"),
        ),
        CONTENT_SCHEMA,
    )


def followers(spark, sf) -> DataFrame:
    """One follower row per account and day, counted from the events."""
    days = (
        table(spark, sf, "events")
        .groupBy(_platform().alias("platform"), F.col("event_type").alias("account"), F.to_date("ts").alias("day"))
        .agg(
            F.max("event_id").alias("total"),
            F.count(F.lit(1)).alias("new"),
            F.count_if(F.col("user_id") % 3 == 0).alias("cancelled"),
        )
    )
    return conform(days, FOLLOWERS_SCHEMA)


@query(
    "weekly_content_metrics",
    f"""select {_PLATFORM_SQL} as platform, event_type as account, strftime(date_trunc('week', ts), '%Y-%m-%d') as week,
      count(*) as items, sum(floor(value)) as views,
      case when count(*) filter (user_id % 50 = 7) > 0 then null else cast(sum(user_id % 50) as double) end as interactions,
      cast(sum(event_id % 11) as double) as shares
    from events group by 1, 2, 3""",
)
def weekly_content_metrics(spark, sf):
    return out(weekly.content_all_weeks(content(spark, sf)))


@query(
    "partial_final_reaggregate",
    f"""select {_PLATFORM_SQL} as platform, event_type as account, cast(count(*) as bigint) as items, sum(floor(value)) as views,
      cast(sum(event_id % 11) as double) as shares
    from events where ts >= timestamp '{START}' and ts < timestamp '{END}' group by 1, 2""",
)
def partial_final_reaggregate(spark, sf):
    items = content(spark, sf)
    even = items.filter("shares % 2 = 0")
    odd = items.filter("shares % 2 = 1")
    parts = weekly.content_week(even, START, END).unionByName(weekly.content_week(odd, START, END))
    return out(weekly.merge_content(parts).drop("interactions"))


@query(
    "follower_snapshot_change",
    f"""with d as (select {_PLATFORM_SQL} as platform, event_type as account, date_trunc('day', ts) as day, max(event_id) as total,
        count(*) as new, count(*) filter (user_id % 3 = 0) as cancelled from events group by 1, 2, 3)
    select platform, account,
      cast(max(case when day = timestamp '{END}' - interval 1 day then total end) as double) as followers,
      cast(max(case when day = timestamp '{START}' - interval 1 day then total end) as double) as before,
      cast(sum(case when day >= timestamp '{START}' then new - cancelled end) as double) as net
    from d where day >= timestamp '{START}' - interval 1 day and day < timestamp '{END}' group by 1, 2""",
)
def follower_snapshot_change(spark, sf):
    week = weekly.followers_week(followers(spark, sf), START, END)
    return week.select("platform", "account", "followers", "before", "net")


_LABELS = ["view", "click", "signup", "error", "purchase"]
_SOCIAL = [("view", "微信", "view"), ("click", "微信", "click"), ("error", "微博", "error")]


def _monday_wide(spark, sf) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.date_trunc("week", "ts").alias("统计时间"))
        .agg(*[F.count_if(F.col("event_type") == x).alias(x) for x in _LABELS])
    )


@query(
    "last_two_snapshots",
    f"""with w as (select date_trunc('week', ts) as week, event_type as label, count(*) as n from events
        group by 1, 2),
    r as (select *, dense_rank() over (order by week desc) as k from w)
    select coalesce(p, '') as platform, coalesce(a, '') as account, cast(max(case when k = 1 then n end) as bigint) as followers,
      cast(max(case when k = 1 then n end) - max(case when k = 2 then n end) as bigint) as change
    from r left join {values_sql(_SOCIAL, 'v', 'l, p, a')} on label = l where k <= 2 group by label, p, a""",
)
def last_two_snapshots(spark, sf):
    return weekly.monday_followers(_monday_wide(spark, sf), "统计时间", weekly.social_account(spark, _SOCIAL))


@query(
    "top_k_snapshots",
    """select strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_id, value from events order by events.ts desc, event_id limit 20""",
)
def top_k_snapshots(spark, sf):
    events = table(spark, sf, "events")
    return out(events.orderBy(F.col("ts").desc_nulls_last(), "event_id").limit(20).select("ts", "event_id", "value"))


@query(
    "revenue_by_account",
    f"""with d as (select {pick_sql(DETAILS, 'l_partkey')} as detail, l_quantity, {NET_SQL} as net_revenue from lineitem
        where l_shipdate >= timestamp '1997-01-06' and l_shipdate < timestamp '1997-03-03'),
      a as (select {ACCOUNT_CASE} as account, l_quantity, net_revenue from d)
    select account, cast(sum(l_quantity) as bigint) as tickets, cast(sum(net_revenue) as double) as revenue
    from a where account <> '无' group by 1""",
)
def revenue_by_account(spark, sf):
    sales = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("order_ts"),
        pick(DETAILS, F.col("l_partkey")).alias("channel_detail"),
        F.col("l_quantity").cast("int").alias("tickets"),
        net_revenue().alias("net_revenue"),
    )
    return out(weekly.revenue_by_account(sales, "1997-01-06", "1997-03-03"))


_OWNERS = [("订阅号", "微信", "view"), ("服务号", "微信", "click"), ("微博", "微博", "error"), ("企微", "企微", "客服")]


@query(
    "weekly_cross_platform_report",
    f"""with kinds as (select * from {values_sql(KINDS, 'k', 'platform, account, kind')}),
    d as (select event_type as account, date_trunc('day', ts) as day, max(event_id) as total,
        count(*) as new, count(*) filter (user_id % 3 = 0) as cancelled from events group by 1, 2),
    f as (select account,
        cast(max(case when day = timestamp '{END}' - interval 1 day then total end) as double) as followers,
        cast(max(case when day = timestamp '{START}' - interval 1 day then total end) as double) as before,
        cast(sum(case when day >= timestamp '{START}' then new - cancelled end) as double) as net
      from d where day >= timestamp '{START}' - interval 1 day and day < timestamp '{END}' group by 1),
    c as (select event_type as account, count(*) as items, cast(sum(floor(value)) as bigint) as views,
        case when count(*) filter (user_id % 50 = 7) > 0 then null else sum(user_id % 50) end as interactions,
        sum(event_id % 11) as shares from events where ts >= timestamp '{START}' and ts < timestamp '{END}' group by 1),
    w as (select date_trunc('week', ts) as week, event_type as label, count(*) as n from events group by 1, 2),
    r as (select *, dense_rank() over (order by week desc) as k from w),
    m as (select label as account, max(case when k = 1 then n end) as total,
        max(case when k = 1 then n end) - max(case when k = 2 then n end) as change
      from r where k <= 2 and label in ('view', 'click', 'error') group by 1),
    s as (select k.platform, k.account, kind,
        case when kind = 'posts' then m.total else followers end as followers,
        case when kind = 'posts' then m.change when kind = 'service' then followers - before else net end as change,
        items, views, interactions, shares
      from kinds k left join f on k.account = f.account left join c on k.account = c.account
      left join m on k.account = m.account
      where kind = 'posts' or (kind = 'articles' and (followers is not null or net is not null or items is not null))
        or (kind = 'videos' and followers is not null) or (kind = 'service' and followers is not null and before is not null)),
    sd as (select {pick_sql(DETAILS, 'event_id')} as detail, cast(event_id % 4 as integer) as tickets,
        cast(value as decimal(18,2)) as net_revenue from events where ts >= timestamp '{START}' and ts < timestamp '{END}'),
    rv as (select {ACCOUNT_CASE} as grp, sum(tickets) as tickets, sum(net_revenue) as revenue from sd group by 1),
    ro as (select p as platform, a as account, tickets, revenue from rv join {values_sql(_OWNERS, 'o', 'g, p, a')} on grp = g)
    select coalesce(s.platform, ro.platform) as platform, coalesce(s.account, ro.account) as account,
      cast(followers as double) as followers, cast(change as double) as change,
      case when s.account is null then '-' else case when items is null then
         case when kind = 'service' then '-' else '0' end else case when kind = 'service' then cast(items as varchar) else cast(items as varchar) end end end as items,
      case when s.account is null then '-' when views is null then '0' else cast(views as varchar) end as views,
      case when s.account is null then '-' when kind = 'articles' and items is not null then '-'
        when interactions is null then case when items is null then '0' else '-' end else cast(interactions as varchar) end as interactions,
      case when s.account is null then '-' when shares is null then '0' else cast(shares as varchar) end as shares,
      coalesce(cast(tickets as varchar), '-') as tickets,
      coalesce(rtrim(rtrim(cast(revenue as varchar), '0'), '.'), '-') as revenue
    from s full join ro on s.platform = ro.platform and s.account = ro.account""",
)
def weekly_cross_platform_report(spark, sf):
    accounts = spark.createDataFrame(KINDS, "platform string, account string, kind string").coalesce(1)
    mondays = weekly.monday_followers(
        _monday_wide(spark, sf), "统计时间", weekly.social_account(spark, _SOCIAL)
    )
    mondays = mondays.filter("platform <> ''").withColumns(
        {c: F.col(c).cast("double") for c in ("followers", "change")}
    )
    summary = weekly.account_summary(
        accounts, followers(spark, sf), content(spark, sf), mondays, START, END
    )
    sales = table(spark, sf, "events").select(
        F.col("ts").alias("order_ts"),
        pick(DETAILS, F.col("event_id")).alias("channel_detail"),
        (F.col("event_id") % 4).cast("int").alias("tickets"),
        F.col("value").cast("decimal(18,4)").alias("net_revenue"),
    )
    owners = weekly.social_account(spark, _OWNERS)
    revenue = weekly.revenue_by_account(sales, START, END, owners)
    return out(weekly.cross_platform_report(summary, revenue))


# --------------------------------------------------------------------------- content sources
def _serial() -> Column:
    return (F.datediff(F.to_date("ts"), F.lit("2023-01-01").cast("date")) + F.lit(44927)).cast("string")


def _num(c) -> Column:
    return F.floor(c).cast("string")


def _text_events(spark, sf) -> DataFrame:
    """Event figures as the text cells of a platform export."""
    n = F.col("event_id") % 97
    return table(spark, sf, "events").select(
        "event_type",
        _serial().alias("投稿时间"),
        F.date_format("ts", "yyyy/M/d").alias("发布时间"),
        F.date_format("ts", "yyyyMMdd").alias("发表时间"),
        F.when(n % 5 == 0, F.concat((n / 2).cast("decimal(6,1)").cast("string"), F.lit("W")))
        .when(n % 5 == 1, F.concat(n.cast("string"), F.lit("w")))
        .otherwise(n.cast("string"))
        .alias("阅读数"),
        F.when(n % 7 != 0, n.cast("string")).alias("播放量"),
        *[
            ((F.col("event_id") + i) % 13).cast("string").alias(c)
            for i, c in enumerate(
                ["评论数", "点赞数", "转发数", "弹幕数", "收藏数", "硬币数", "分享数", "收藏", "推荐", "喜欢",
                 "评论量", "分享量", "总阅读次数", "总分享次数"]
            )
        ],
    )


def _f(name: str) -> str:
    names = ["评论数", "点赞数", "转发数", "弹幕数", "收藏数", "硬币数", "分享数", "收藏", "推荐", "喜欢", "评论量",
             "分享量", "总阅读次数", "总分享次数"]
    return f"((event_id + {names.index(name)}) % 13)"


_N = "(event_id % 97)"
_READS = f"case when {_N} % 5 = 0 then cast({_N} as double) / 2 * 10000 when {_N} % 5 = 1 then {_N} * 10000.0 else cast({_N} as double) end"
_PLAYS = f"case when {_N} % 7 <> 0 then cast({_N} as double) end"


def _sum_sql(names: list[str]) -> str:
    return " + ".join(_f(n) for n in names)


def _source_sql(platform: str, views: str, parts: list[str] | None, shares: str, where: str = "true") -> str:
    inter = f"cast(sum({_sum_sql(parts)}) as double)" if parts else "cast(null as double)"
    return (
        f"select {q(platform)} as platform, event_type as account, strftime(ts, '%Y-%m-%d') as day, count(*) as items, "
        f"case when count(*) filter (({views}) is null) > 0 then null else sum({views}) end as views, "
        f"{inter} as interactions, cast(sum({_f(shares)}) as double) as shares from events where {where} group by 2, 3"
    )


@query(
    "platform_content_sources",
    " union all ".join(
        [
            _source_sql("文章", f"cast({_f('总阅读次数')} as double)", None, "总分享次数"),
            _source_sql("视频号", _PLAYS, ["推荐", "喜欢", "评论量"], "分享量"),
            _source_sql("微博", _READS, ["评论数", "点赞数"], "转发数"),
            _source_sql("b站", _PLAYS, ["点赞数", "弹幕数", "评论数", "收藏数", "硬币数"], "分享数"),
            _source_sql("抖音", _PLAYS, ["点赞数", "评论数", "收藏"], "转发数", f"{_N} % 7 <> 0"),
        ]
    ),
)
def platform_content_sources(spark, sf):
    """Every platform's export to content rows, with the interactions that it counts."""
    raw = _text_events(spark, sf)
    # The account is the event type: one export per platform holds all its accounts.
    tagged = [
        make(raw, platform, F.col("event_type"))
        for make, platform in (
            (weekly.articles, "文章"),
            (weekly.videos, "视频号"),
            (weekly.weibo_posts, "微博"),
            (weekly.bilibili_posts, "b站"),
            (weekly.douyin_posts, "抖音"),
        )
    ]
    items = ch.union_all(tagged)
    return out(
        items.groupBy("platform", "account", F.to_date("published_at").alias("day")).agg(
            F.count(F.lit(1)).alias("items"),
            strict_sum("views").alias("views"),
            F.when(F.col("platform") == "文章", F.lit(None)).otherwise(strict_sum("interactions")).alias("interactions"),
            strict_sum("shares").alias("shares"),
        )
    )


@query(
    "follower_sources",
    """with d as (select event_type as account, date_trunc('day', ts) as day, count(*) as n, max(user_id) as m from events group by 1, 2)
    select '订阅号' as platform, strftime(day, '%Y-%m-%d') as day, cast(sum(n) as double) as total, cast(sum(m) as double) as new,
      cast(sum(n % 7) as double) as cancelled from d group by 2
    union all select '视频号', strftime(day, '%Y-%m-%d'), cast(sum(n) as double), cast(sum(m) as double), cast(sum(n % 7) as double) from d group by 2
    union all select '企微', strftime(day, '%Y-%m-%d'), cast(sum(n) as double), cast(sum(m) as double), null from d group by 2""",
)
def follower_sources(spark, sf):
    days = (
        table(spark, sf, "events")
        .groupBy("event_type", F.date_trunc("day", "ts").alias("ts"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("user_id").alias("m"))
    )
    n, m, c = (x.cast("string") for x in (F.col("n"), F.col("m"), F.col("n") % 7))
    subscription = days.select(
        _serial().alias("时间"), n.alias("累积关注人数"), m.alias("新关注人数"), c.alias("取消关注人数")
    )
    video = days.select(
        F.date_format("ts", "yyyy/MM/dd").alias("时间"), n.alias("关注者总数"), m.alias("新增关注"), c.alias("取消关注")
    )
    service = days.select(
        F.date_format("ts", "yyyy-MM-dd").alias("日期"), n.alias("客户总数"),
        F.concat(F.lit("'"), m).alias("净增客户数"),
    )
    rows = ch.union_all(
        [
            weekly.article_followers(subscription, "订阅号", "a"),
            weekly.video_followers(video, "视频号", "a"),
            weekly.service_followers(service, "企微", "a"),
        ]
    )
    return out(
        rows.groupBy("platform", F.to_date("day").alias("day")).agg(
            F.sum("total").alias("total"), F.sum("new").alias("new"), F.sum("cancelled").alias("cancelled")
        )
    )


# -------------------------------------------------------------------------- dashboard text lines
def _tags(tokens: dict[int, Column], count: int) -> Column:
    """A line of tags whose n-th text token (1-based) is given."""
    parts = []
    for i in range(1, count + 1):
        parts.append(tokens.get(i, F.lit("")))
        if i < count:
            parts.append(F.lit("<i>"))
    return F.concat(*parts)


def _dashboard_lines(spark, sf, where: str = "true", graphic: bool = False) -> DataFrame:
    """One saved dashboard per event type: per event a marker line, a spacer and a figure line."""
    events = table(spark, sf, "events").filter(where).select(
        F.col("event_type").alias(PART), F.col("event_id").alias(ORDER), "ts", "value"
    )
    dense = position.densify(events)
    n = (F.floor("value") % 40).cast("string")
    head = _tags(
        {3: F.concat(F.lit("t"), F.col(ORDER).cast("string")), 5: F.concat(F.lit("发布于 "), F.date_format("ts", "yyyy-MM-dd"))}, 6
    )
    labels = ["观看量", "弹幕数", "点赞量", "收藏数", "评论数", "分享数", "x", "y"]
    views = F.when(F.floor("value") % 3 == 0, F.concat(F.lit("1.5"), F.lit("万"))).otherwise(n)
    if graphic:
        labels, views = ["观看量", "点赞量", "评论数", "收藏数", "分享数"], n
    figures: dict[int, Column] = {}
    for (a, b), label in zip(weekly.GRAPHIC_PAIRS if graphic else weekly.VIDEO_PAIRS, labels):
        figures[a] = F.lit(label)
        figures[b] = views if label == "观看量" else n
    marker = F.concat(F.lit("info-text"), head)
    # The first marker of a file is its heading.
    three = F.array(marker, F.lit("<br>"), _tags(figures, 69))
    lines = dense.select(PART, ORDER, F.posexplode(three).alias("k", "line")).select(
        PART, (F.col(ORDER) * 3 + F.col("k") + 1).alias(ORDER), "line"
    )
    heads = dense.select(PART).distinct().select(
        PART, F.lit(0).cast("long").alias(ORDER), F.lit("<b>info-text</b>").alias("line")
    )
    return lines.unionByName(heads)


@query(
    "dashboard_posts",
    """with x as (select event_type as account, ts, cast(floor(value) as bigint) as v from events)
    select account, strftime(ts, '%Y-%m-%d') as day, count(*) as items,
      cast(sum(case when v % 3 = 0 then 15000 else v % 40 end) as double) as views, cast(sum(4 * (v % 40)) as double) as interactions,
      cast(sum(v % 40) as double) as shares from x group by 1, 2""",
)
def dashboard_posts(spark, sf):
    """Dashboard text scraped by marker line and token position."""
    lines = written(_dashboard_lines(spark, sf), "dashboard")
    items = weekly.dashboard_items(
        lines, weekly.VIDEO_PAIRS, ["观看量", "分享数", *dims.ENGAGEMENT["小红书视频"]]
    )
    rows = items.withColumn("i", weekly.engagement("小红书视频"))
    return out(
        rows.groupBy(F.col(PART).alias("account"), F.to_date("发布时间").alias("day")).agg(
            F.count(F.lit(1)).alias("items"),
            strict_sum(weekly.magnitude("观看量", "万", whole=False)).alias("views"),
            strict_sum("i").alias("interactions"),
            strict_sum(weekly.as_number("分享数")).alias("shares"),
        )
    )


@query(
    "dashboard_all_posts",
    """with x as (select event_type as account, date_trunc('week', ts) as week, event_id % 2 = 0 as graphic,
      cast(floor(value) as bigint) as v from events)
    select '小红书' as platform, account, strftime(week, '%Y-%m-%d') as week, count(*) as items,
      cast(sum(case when not graphic and v % 3 = 0 then 15000 else v % 40 end) as double) as views,
      cast(sum(case when graphic then 3 else 4 end * (v % 40)) as double) as interactions, cast(sum(v % 40) as double) as shares
    from x group by 2, x.week""",
)
def dashboard_all_posts(spark, sf):
    """Graphic and video dashboards of every account, each summed by week, then merged."""
    account = F.col(PART)
    graphic = written(_dashboard_lines(spark, sf, "event_id % 2 = 0", graphic=True), "graphic-dashboard")
    video = written(_dashboard_lines(spark, sf, "event_id % 2 <> 0"), "video-dashboard")
    parts = [
        weekly.content_all_weeks(weekly.dashboard_posts(graphic, "小红书", account)),
        weekly.content_all_weeks(weekly.dashboard_posts(video, "小红书", account, video=True)),
    ]
    merged = weekly.merge_content(parts[0].unionByName(parts[1]), "week")
    return out(merged.withColumn("items", F.col("items").cast("long")))


@query(
    "html_token_pairs",
    """with t as (select page_id, regexp_split_to_array(html, '<[^>]*>') as tok from pages)
    select page_id, cast(len(tok) as integer) as tokens, tok[9] as label, tok[11] as value from t""",
)
def html_token_pairs(spark, sf):
    tokens = F.split("html", "<[^>]*>", -1)
    return table(spark, sf, "pages").select(
        "page_id",
        F.size(tokens).alias("tokens"),
        F.get(tokens, F.lit(8)).alias("label"),
        F.get(tokens, F.lit(10)).alias("value"),
    )


# ------------------------------------------------------------------------------------- streaming
@query(
    "stream_daily_revenue",
    f"""select strftime(l_shipdate, '%Y-%m-%d') as order_day,
      case when l_returnflag in ('A', 'N') then '分销' else '自营' end as channel_group,
      cast(sum(l_quantity) as bigint) as tickets, cast(sum({NET_SQL}) as double) as revenue from lineitem group by 1, 2""",
)
def stream_daily_revenue(spark, sf):
    """All days at once on a stream; the table of totals is complete after each run."""
    kind = F.when(F.col("l_returnflag") == "A", "分销-系统").when(F.col("l_returnflag") == "N", "分销-报单")
    sales = stream_of(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("order_ts"),
        kind.otherwise(CHANNEL_GROUPS[0]).alias("channel_type"),
        F.col("l_quantity").cast("int").alias("tickets"),
        net_revenue().alias("net_revenue"),
    )
    done = flows.finished(spark, flows.daily_revenue(sales), "daily-revenue", complete=True)
    return out(done.drop("items"))


@query(
    "stream_weekly_metrics",
    """select strftime(date_trunc('week', ts), '%Y-%m-%d') as week, event_type, count(*) as items,
      cast(sum(cast(value as decimal(18,2))) as double) as amount from events group by 1, 2""",
)
def stream_weekly_metrics(spark, sf):
    items = stream_of(spark, sf, "events").select(
        "ts", "event_type", F.col("value").cast("decimal(18,2)").alias("amount")
    )
    done = flows.finished(
        spark, flows.weekly_metrics(items, "ts", ["event_type"]), "weekly-metrics", complete=True
    )
    return out(done)


@query(
    "stream_attribution",
    f"""with m as (select event_id, coalesce(arg_max(detail, n) filter (detail is not null), '其他') as detail,
        coalesce(arg_max(action_type, n) filter (action_type is not null), '其他') as action_type
      from events left join {_REFERRAL_SQL} on event_type = code
        and (lo is null or ts >= cast(lo as timestamp)) and (hi is null or ts < cast(hi as timestamp)) group by 1)
    select detail as channel_detail, action_type, count(*) as events from m group by 1, 2""",
)
def stream_attribution(spark, sf):
    events = stream_of(spark, sf, "events").select("event_id", "event_type", "ts")
    rules = dims.referral(spark, REFERRAL)
    done = flows.finished(spark, flows.attributed(events, rules, "event_type", "ts"), "attributed")
    return done.groupBy("channel_detail", "action_type").agg(F.count(F.lit(1)).alias("events"))


@query(
    "stream_ingest_files",
    f"""select strftime(o_orderdate, {TS}) as order_ts, count(*) as lines, cast(sum(o_custkey % 6) as bigint) as tickets,
      cast(sum(cast(o_totalprice as decimal(18,2))) as double) as revenue from orders group by orders.o_orderdate""",
)
def stream_ingest_files(spark, sf):
    """CSV files to the sales table in two runs; a file that was read is not read again."""
    folder, store, checkpoint = (shared_dir(spark, n) for n in ("orders-in", "orders-out", "orders-checkpoint"))
    orders = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("下单时间"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("现金支付"),
        (F.col("o_custkey") % 6).cast("string").alias("票张数"),
        "o_orderstatus",
    )
    names = ["下单时间", "现金支付", "票张数"]

    def to_sales(raw: DataFrame) -> DataFrame:
        from ticketlake.functions.dates import parse_ts
        from ticketlake.functions.numbers import as_count, as_number

        return raw.select(
            parse_ts("下单时间").alias("order_ts"),
            as_number("现金支付").alias("net_revenue"),
            as_count("票张数").alias("tickets"),
        )

    for part in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        orders.filter(part).select(names).write.mode("append").option("header", True).csv(folder)
        flows.ingest(spark, folder, names, to_sales, store, checkpoint)
    done = spark.read.schema(SALES_SCHEMA).parquet(store)
    return out(
        done.groupBy("order_ts").agg(F.count(F.lit(1)).alias("lines"), *totals())
    )


# A line arrives with the half year of its shipping; some come a half year or a year later.
_ARRIVAL = """(year(l_shipdate) - 1992) * 2 + cast(month(l_shipdate) > 6 as integer)
      + case when l_orderkey % 41 = 0 then 2 when l_orderkey % 23 = 0 then 1 else 0 end"""
_RUNS = 4
_LATE_DAYS = 60


@query(
    "stream_final_days",
    f"""with x as (select l_shipdate, l_quantity, {NET_SQL} as revenue,
        case when l_returnflag in ('A', 'N') then '分销' else '自营' end as channel_group,
        ({_ARRIVAL} - (select min({_ARRIVAL}) from lineitem))
          * {_RUNS} // (select max({_ARRIVAL}) - min({_ARRIVAL}) + 1 from lineitem) as run from lineitem),
    marks as (select r.run, (select max(l_shipdate) from x where x.run < r.run) - interval {_LATE_DAYS} day as mark
      from (select unnest(range({_RUNS})) as run) r),
    final as (select max(l_shipdate) - interval {_LATE_DAYS} day as mark from x),
    kept as (select x.*, m.mark is not null and date_trunc('day', l_shipdate) + interval 1 day <= m.mark as late
      from x join marks m using (run))
    select strftime(l_shipdate, '%Y-%m-%d') as order_day, channel_group,
      cast(sum(l_quantity) filter (not late) as bigint) as tickets, cast(sum(revenue) filter (not late) as double) as revenue,
      count(*) filter (not late) as items, count(*) filter (late) as late
    from kept where date_trunc('day', l_shipdate) + interval 1 day <= (select mark from final)
    group by 1, 2 having count(*) filter (not late) > 0""",
)
def stream_final_days(spark, sf):
    """Lines arrive in several runs, some of them late: a day is written once, when the watermark has passed it."""
    folder, store, checkpoint = (shared_dir(spark, n) for n in ("lines-in", "days-out", "days-checkpoint"))
    arrival = F.expr(_ARRIVAL)
    kind = F.when(F.col("l_returnflag") == "A", "分销-系统").when(F.col("l_returnflag") == "N", "分销-报单")
    lines = table(spark, sf, "lineitem").select(
        arrival.alias("arrival"),
        F.col("l_shipdate").alias("order_ts"),
        kind.otherwise(CHANNEL_GROUPS[0]).alias("channel_type"),
        F.col("l_quantity").cast("int").alias("tickets"),
        net_revenue().alias("net_revenue"),
    )
    low, high = lines.agg(F.min("arrival"), F.max("arrival")).first()
    low, high = low or 0, high or 0
    schema = lines.drop("arrival").schema
    run = F.floor((F.col("arrival") - low) * _RUNS / (high - low + 1))
    for k in range(_RUNS):
        lines.filter(run == k).drop("arrival").write.mode("append").parquet(folder)
        days = flows.daily_revenue(flows.parquet_files(spark, folder, schema, per_batch=100_000), f"{_LATE_DAYS} days")
        flows.finalised(days, store, checkpoint)
    final = spark.read.schema(days.schema).parquet(store)
    keys = ["order_day", "channel_group"]
    came = spark.read.schema(schema).parquet(folder).groupBy(
        F.to_date("order_ts").alias("order_day"), channel_group().alias("channel_group")
    ).agg(F.count(F.lit(1)).alias("items"))
    return out(flows.late_rows(came, final, keys))


_CHANGED = [
    ("view", "2024-01-10", None, "自然销售-新", "2024-01-10", "自然销售"),
    ("error", None, None, "微博-排练照", None, "微博"),
    *REFERRAL[1:],
]
_CHANGED_SQL = values_sql(
    [(i, *r) for i, r in enumerate(_CHANGED)], "r", "n, code, lo, hi, detail, action_date, action_type"
)


def _attributed_sql(rules: str, where: str) -> str:
    return f"""select event_id, coalesce(arg_max(detail, n) filter (detail is not null), '其他') as detail,
        coalesce(arg_max(action_type, n) filter (action_type is not null), '其他') as action_type
      from events left join {rules} on event_type = code
        and (lo is null or ts >= cast(lo as timestamp)) and (hi is null or ts < cast(hi as timestamp))
      where {where} group by 1"""


@query(
    "stream_changing_rules",
    f"""with m as (select *, 1 as version from ({_attributed_sql(_REFERRAL_SQL, 'event_id % 3 < 2')})
      union all select *, 2 as version from ({_attributed_sql(_CHANGED_SQL, 'event_id % 3 = 2')}))
    select detail as channel_detail, action_type, cast(version as bigint) as version, count(*) as events
    from m group by 1, 2, 3""",
)
def stream_changing_rules(spark, sf):
    """The rules change between two micro-batches; every row carries the version it was attributed with."""
    names = ("events-in", "rules", "attributed", "attributed-checkpoint")
    folder, rules, store, checkpoint = (shared_dir(spark, n) for n in names)
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    parts = (("event_id % 3 < 2", REFERRAL), ("event_id % 3 = 2", _CHANGED))
    for part, given in parts:
        base = dims.referral(spark, given)
        flows.publish_rules(spark, rules, base.table)
        events.filter(part).write.mode("append").parquet(folder)
        flows.attribute_by_version(
            flows.parquet_files(spark, folder, events.schema),
            rules,
            lambda stored, base=base: RuleSet(base.name, stored, base.keys, base.outputs, True),
            base.table.schema,
            "event_type",
            "ts",
            store,
            checkpoint,
        )
    return flows.versioned_rows(spark, store).groupBy("channel_detail", "action_type", "version").agg(
        F.count(F.lit(1)).alias("events")
    )
