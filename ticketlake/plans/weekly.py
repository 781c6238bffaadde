"""Weekly marketing report: followers, content and revenue per social account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.dates import (
    between,
    excel_serial,
    ntz,
    parse_published,
    parse_ts,
)
from ticketlake.functions.nulls import null_safe_on, strict_sum
from ticketlake.functions.numbers import as_number, magnitude, num_text, strip_apostrophe
from ticketlake.operators import position, reshape
from ticketlake.operators.position import ORDER, PART
from ticketlake.operators.rules import RuleSet
from ticketlake.schema import CONTENT_SCHEMA, FOLLOWERS_SCHEMA, conform

from .sales import owning_account

# How an account's figures come together.
ARTICLES, VIDEOS, POSTS, SERVICE, FOLLOWERS_ONLY = "articles", "videos", "posts", "service", "followers"
UNKNOWN_TEXT = "-"


Account = str | Column


def tagged(platform: str, account: Account) -> list[Column]:
    """Platform and account of an export; a column names the account of each row."""
    name = account if isinstance(account, Column) else F.lit(account)
    return [F.lit(platform).alias("platform"), name.alias("account")]


# -------------------------------------------------------------------------------------- sources
def article_followers(raw: DataFrame, platform: str, account: Account) -> DataFrame:
    """Follower days of an article account; the day is a spreadsheet serial."""
    rows = raw.select(
        *tagged(platform, account),
        excel_serial("时间").alias("day"),
        as_number("累积关注人数").alias("total"),
        as_number("新关注人数").alias("new"),
        as_number("取消关注人数").alias("cancelled"),
    )
    return conform(rows, FOLLOWERS_SCHEMA)


def video_followers(raw: DataFrame, platform: str, account: Account) -> DataFrame:
    rows = raw.select(
        *tagged(platform, account),
        parse_ts("时间").alias("day"),
        as_number("关注者总数").alias("total"),
        as_number("新增关注").alias("new"),
        as_number("取消关注").alias("cancelled"),
    )
    return conform(rows, FOLLOWERS_SCHEMA)


def service_followers(raw: DataFrame, platform: str, account: Account) -> DataFrame:
    rows = raw.select(
        *tagged(platform, account),
        parse_ts("日期").alias("day"),
        as_number("客户总数").alias("total"),
        strip_apostrophe("净增客户数").alias("new"),
    )
    return conform(rows, FOLLOWERS_SCHEMA)


def articles(raw: DataFrame, platform: str, account: Account) -> DataFrame:
    """Articles have no interaction count."""
    rows = raw.select(
        *tagged(platform, account),
        parse_ts("发表时间").alias("published_at"),
        as_number("总阅读次数").alias("views"),
        as_number("总分享次数").alias("shares"),
    )
    return conform(rows, CONTENT_SCHEMA)


def engagement(kind: str) -> Column:
    """Interactions of one item: the sum of the columns that its platform counts."""
    cols = [as_number(c) for c in dims.ENGAGEMENT[kind]]
    return sum(cols[1:], cols[0])


def content(
    raw: DataFrame,
    platform: str,
    account: Account,
    kind: str,
    published_at: Column,
    views: Column,
    shares: Column,
) -> DataFrame:
    """Items of any platform; ``kind`` selects its interaction columns."""
    rows = raw.select(
        *tagged(platform, account),
        published_at.alias("published_at"),
        views.alias("views"),
        engagement(kind).alias("interactions"),
        shares.alias("shares"),
    )
    return conform(rows, CONTENT_SCHEMA)


def videos(raw: DataFrame, platform: str, account: Account) -> DataFrame:
    return content(
        raw, platform, account, "视频号", parse_ts("发布时间"),
        as_number("播放量"), as_number("分享量"),
    )


def weibo_posts(raw: DataFrame, platform: str, account: Account) -> DataFrame:
    return content(
        raw, platform, account, "微博", excel_serial("投稿时间"),
        magnitude("阅读数", "Ww"), as_number("转发数"),
    )


def bilibili_posts(raw: DataFrame, platform: str, account: Account) -> DataFrame:
    return content(
        raw, platform, account, "b站", excel_serial("投稿时间"),
        as_number("播放量"), as_number("分享数"),
    )


def douyin_posts(raw: DataFrame, platform: str, account: Account) -> DataFrame:
    return content(
        raw.filter(F.col("播放量").isNotNull()), platform, account, "抖音",
        excel_serial("投稿时间"), as_number("播放量"), as_number("转发数"),
    )


# Token positions in the saved creator dashboard.
MARKER, TAG = "info-text", r"<[^>\p{Cntrl}]*>"
TITLE_TOKEN, DATE_TOKEN, STATS_BELOW = 3, 5, 2
GRAPHIC_PAIRS = [(8, 10), (17, 19), (25, 27), (35, 37), (44, 46)]
VIDEO_PAIRS = [(8, 10), (16, 18), (24, 26), (32, 34), (42, 44), (50, 52), (58, 60), (66, 68)]


def dashboard_items(
    lines: DataFrame,
    pairs: list[tuple[int, int]],
    labels: list[str],
    chunk_rows: int = position.CHUNK_ROWS,
) -> DataFrame:
    """Items of a saved dashboard: a marker line with title and date, figures two lines below.

    The first marker line of a file is its heading.
    """
    below = position.shift(lines, {"line": "_stats"}, STATS_BELOW, chunk_rows=chunk_rows)
    items = position.drop_first(below.filter(F.col("line").contains(MARKER)))
    split = items.select(
        PART, ORDER, F.split("line", TAG).alias("_head"), F.split("_stats", TAG).alias("_stats")
    )
    found = split.select(
        PART,
        ORDER,
        F.get("_head", F.lit(TITLE_TOKEN - 1)).alias("标题"),
        F.get("_head", F.lit(DATE_TOKEN - 1)).alias("_date"),
        reshape.token_pairs(F.col("_stats"), pairs).alias("_pairs"),
    )
    return found.select(
        PART, ORDER, "标题", parse_published("_date").alias("发布时间"),
        *[reshape.pair_value(F.col("_pairs"), lbl).alias(lbl) for lbl in labels],
    )


def dashboard_posts(
    lines: DataFrame, platform: str, account: Account, video: bool = False,
    chunk_rows: int = position.CHUNK_ROWS, whole: bool = False,
) -> DataFrame:
    """Dashboard items as content rows; only video views may carry a ten-thousand mark."""
    kind = "小红书视频" if video else "小红书"
    labels = ["观看量", "分享数", *dims.ENGAGEMENT[kind]]
    raw = dashboard_items(lines, VIDEO_PAIRS if video else GRAPHIC_PAIRS, labels, chunk_rows)
    views = magnitude("观看量", "万", whole=whole) if video else as_number("观看量")
    return content(raw, platform, account, kind, F.col("发布时间"), views, as_number("分享数"))


def monday_followers(wide: DataFrame, day: str, accounts: RuleSet) -> DataFrame:
    """Newest follower count and its change since the snapshot before, one row per account."""
    cols = [c for c in wide.columns if c != day]
    newest = wide.orderBy(F.col(day).desc_nulls_last()).limit(2)
    long = reshape.to_long(newest, [day], cols, "label", "total")
    both = long.groupBy("label").agg(
        F.max_by("total", day).alias("followers"), F.min_by("total", day).alias("_before")
    )
    named = accounts.apply(both, {"label": "label"})
    return named.select(
        "platform", "account", "followers", (F.col("followers") - F.col("_before")).alias("change")
    )


def social_account(spark, rows: list[tuple[str, str, str]]) -> RuleSet:
    """Label to (platform, account); unknown labels give empty text."""
    return RuleSet.of(
        spark, "social_account", rows, {"label": "string"},
        {"platform": ("string", ""), "account": ("string", "")},
    )


# ------------------------------------------------------------------------------------ one week
def content_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("items"),
        strict_sum("views").alias("views"),
        strict_sum("interactions").alias("interactions"),
        strict_sum("shares").alias("shares"),
    ]


def content_week(items: DataFrame, start: str, end: str) -> DataFrame:
    """Item count and sums per account for ``[start, end)``."""
    return (
        items.filter(between("published_at", start, end))
        .groupBy("platform", "account")
        .agg(*content_totals())
    )


def content_all_weeks(items: DataFrame) -> DataFrame:
    """The same for every Monday-based week at once."""
    week = F.date_trunc("week", "published_at").cast("date").alias("week")
    return items.groupBy("platform", "account", week).agg(*content_totals())


def merge_content(parts: DataFrame, *more: str) -> DataFrame:
    """Sum partial content totals of the same account (and of further keys, such as the week)."""
    return parts.groupBy("platform", "account", *more).agg(
        *[strict_sum(c).alias(c) for c in ("items", "views", "interactions", "shares")]
    )


def followers_week(days: DataFrame, start: str, end: str) -> DataFrame:
    """Per account: count on the last day, count on the day before, and net change of the week."""
    day = F.col("day")
    one = F.expr("INTERVAL 1 DAY")
    last, before = ntz(end) - one, ntz(start) - one
    is_last = (day >= last) & (day < ntz(end))
    is_before = (day >= before) & (day < ntz(start))
    inside = (day >= ntz(start)) & (day < ntz(end))

    def week_sum(c: str) -> Column:
        return F.when(F.count_if(inside & F.col(c).isNull()) == 0, F.sum(F.when(inside, F.col(c))))

    return (
        days.filter((day >= before) & (day < ntz(end)))
        .groupBy("platform", "account")
        .agg(
            F.max(F.when(is_last, F.col("total"))).alias("followers"),
            F.max(F.when(is_before, F.col("total"))).alias("before"),
            (F.count_if(is_last) > 0).alias("has_last"),
            (F.count_if(is_before) > 0).alias("has_before"),
            (F.count_if(inside) > 0).alias("has_week"),
            (week_sum("new") - week_sum("cancelled")).alias("net"),
        )
    )


def account_summary(
    accounts: DataFrame, days: DataFrame, items: DataFrame, mondays: DataFrame, start: str, end: str
) -> DataFrame:
    """One row per account of ``accounts(platform, account, kind)``.

    * articles: kept when anything is known; figures of a week without articles are 0;
    * videos: kept only with a follower count on the last day;
    * service: kept only with both day counts, the change is their difference;
    * posts: always kept, followers from the Monday snapshots;
    * followers: Monday snapshot only, no content figures.
    """
    keys = ["platform", "account"]
    rows = (
        accounts.join(followers_week(days, start, end), keys, "left")
        .join(content_week(items, start, end), keys, "left")
        .join(mondays.withColumnsRenamed({"followers": "m_total", "change": "m_change"}), keys, "left")
    )
    kind = F.col("kind")
    monday = kind.isin(POSTS, FOLLOWERS_ONLY)
    has_content = kind.isin(ARTICLES, VIDEOS, POSTS)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    kept = (
        F.when(kind == ARTICLES, yes("has_last") | yes("has_week") | F.col("items").isNotNull())
        .when(kind == VIDEOS, yes("has_last"))
        .when(kind == SERVICE, yes("has_last") & yes("has_before"))
        .when(kind == FOLLOWERS_ONLY, F.col("m_total").isNotNull())
        .otherwise(True)
    )
    change = (
        F.when(monday, F.col("m_change"))
        .when(kind == SERVICE, F.col("followers") - F.col("before"))
        .when((kind == VIDEOS) & ~yes("has_week"), 0.0)
        .otherwise(F.col("net"))
    )
    empty_week = has_content & F.col("items").isNull()

    def figure(c: str) -> Column:
        value = F.when(empty_week, F.lit(0.0)).otherwise(F.col(c).cast("double"))
        # An article week without a known sum is reported as 0.
        return F.when((kind == ARTICLES) & value.isNull(), F.lit(0.0)).otherwise(value)

    reactions = F.when((kind == ARTICLES) & F.col("items").isNotNull(), UNKNOWN_TEXT).otherwise(
        F.when(empty_week, "0").otherwise(num_text("interactions"))
    )
    return rows.filter(kept).select(
        *keys,
        F.when(monday, F.col("m_total")).otherwise(F.col("followers")).alias("followers"),
        change.alias("change"),
        figure("items").alias("items"),
        figure("views").alias("views"),
        reactions.alias("interactions"),
        figure("shares").alias("shares"),
    )


def revenue_by_account(
    sales: DataFrame, start: str, end: str, owners: RuleSet | None = None
) -> DataFrame:
    """Tickets and revenue of the accounts that own a channel detail.

    ``owners`` maps an account group to (platform, account); without it the group is the account.
    """
    # Sums per detail first: the prefixes are then tested once per detail, not once per row.
    details = (
        sales.filter(between("order_ts", start, end))
        .groupBy("channel_detail")
        .agg(strict_sum("tickets").alias("tickets"), strict_sum("net_revenue").alias("revenue"))
    )
    sums = (
        details.withColumn("label", owning_account("channel_detail"))
        .filter(F.col("label") != dims.NO_ACCOUNT)
        .groupBy("label")
        .agg(strict_sum("tickets").alias("tickets"), strict_sum("revenue").alias("revenue"))
    )
    if owners is None:
        return sums.withColumnsRenamed({"label": "account"})
    return owners.apply(sums, {"label": "label"}).select("platform", "account", "tickets", "revenue")


def cross_platform_report(summary: DataFrame, revenue: DataFrame) -> DataFrame:
    """All accounts with content and revenue; what is missing reads ``-``."""
    keys = ["platform", "account"]
    right = revenue.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = null_safe_on(summary, right, [(k, f"_r_{k}") for k in keys])
    joined = summary.join(right, on, "full").withColumns(
        {k: F.coalesce(k, f"_r_{k}") for k in keys}
    )
    figures = {
        "tickets": num_text("tickets"),
        "revenue": num_text("revenue"),
        "items": num_text("items"),
        "views": num_text("views"),
        "interactions": F.col("interactions"),
        "shares": num_text("shares"),
    }
    return reshape.text_or(joined, figures, UNKNOWN_TEXT).select(
        *keys, "followers", "change", "items", "views", "interactions", "shares", "tickets", "revenue"
    )


def full_join_on_measures(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full join on keys that may be missing; key columns are merged."""
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in right.columns})
    joined = left.join(r, null_safe_on(left, r, [(k, f"_r_{k}") for k in keys]), "full")
    extra = [c for c in right.columns if c not in keys]
    return joined.select(
        *[F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys],
        *[c for c in left.columns if c not in keys],
        *[F.col(f"_r_{c}").alias(c) for c in extra],
    )
