"""Direct and distributor orders to sales: attribution, revenue share, project and venue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.dates import between, ntz, parse_ts
from ticketlake.functions.nulls import if_else, is_in, not_in
from ticketlake.functions.numbers import as_number
from ticketlake.functions.text import any_prefix, capture
from ticketlake.operators.lookup import patch_overlay
from ticketlake.operators.rules import RuleSet
from ticketlake.schema import conform

from .channels import BULK, DIST_SYSTEM, SELF, union_all

# Markers of test orders and of sources outside the report.
TEST_TEXT, TEST_PLACE, TEST_PRODUCTION, UNKNOWN = "测试", "test", "test", "未知"
OFFLINE_DESK = "线下票台"
NO_CODE, HALF_PRICE_CODE = "-", "ikids"
HALF_PRICE_FROM = "2023-12-03 00:00:00"
FULL_PRICE_TICKET = "^原价([0-9]+)元$"


# -------------------------------------------------------------------------------- mapping rules
def production_of(df: DataFrame, productions: RuleSet, project: str = "项目") -> DataFrame:
    return productions.apply(df, {"label": project}, into={"value": "production"})


def attribute(df: DataFrame, rules: RuleSet, code: str, at: str, prefix: str = "") -> DataFrame:
    """Referral code and order time to channel detail, action date and action type, in one join."""
    return rules.apply(
        df,
        {"code": code},
        at,
        into={
            "detail": f"{prefix}channel_detail",
            "action_date": f"{prefix}action_date",
            "action_type": f"{prefix}action_type",
        },
    )


def direct_channel_type(action_type: str = "action_type") -> Column:
    """An unknown action type is a direct sale."""
    c = F.col(action_type)
    return F.when(c == "大客户", BULK).when(c == "分销", DIST_SYSTEM).otherwise(SELF)


def direct_rate(
    df: DataFrame, production: Column, price: str = "face_price", out: str = "rate"
) -> DataFrame:
    """Revenue share of direct sales; NULL where no rule applies."""
    rules = dims.direct_rates(df.sparkSession)
    df = rules["type"].apply(df, {"channel_type": "channel_type"}, into={"rate": "_by_type"})
    df = rules["name"].apply(df, {"channel": "channel_detail"}, into={"rate": "_by_name"})
    df = rules["price"].apply(
        df,
        {"channel": "channel_detail", "production": production},
        F.col(price).cast("double"),
        into={"rate": "_by_price"},
    )
    return df.withColumn(out, F.coalesce("_by_price", "_by_name", "_by_type")).drop(
        "_by_price", "_by_name", "_by_type"
    )


def distributor_rate(
    df: DataFrame, production: Column, price: str = "face_price", out: str = "rate"
) -> DataFrame:
    """Channel type and revenue share of distributor sales."""
    rules = dims.distributor_rates(df.sparkSession)
    df = rules["type"].apply(df, {"label": "channel_detail"}, into={"value": "channel_type"})
    df = rules["full"].apply(df, {"channel": "channel_detail"}, into={"rate": "_full"})
    df = rules["price"].apply(
        df,
        {"channel": "channel_detail", "production": production},
        F.col(price).cast("double"),
        into={"rate": "_by_price"},
    )
    df = rules["override"].apply(df, {"channel": "channel_detail"}, into={"rate": "_override"})
    return df.withColumn(out, F.coalesce("_override", "_by_price", "_full")).drop(
        "_full", "_by_price", "_override"
    )


def ticket_price(df: DataFrame, label: str) -> DataFrame:
    """Ticket type to ``face_price`` and ``tickets``; unknown types are 0 and 0."""
    df = dims.ticket_type(df.sparkSession).apply(
        df, {"label": label}, into={"price": "_price", "packs": "_packs"}
    )
    full = as_number(capture(label, FULL_PRICE_TICKET))
    return df.withColumns(
        {
            "face_price": F.coalesce("_price", full, F.lit(0.0)),
            "tickets": F.coalesce("_packs", F.when(full.isNotNull(), 1.0), F.lit(0.0)),
        }
    ).drop("_price", "_packs")


def project_venue(df: DataFrame) -> DataFrame:
    """Production and session to project and venue; empty when the session is not in the calendar."""
    test_at, test_project, test_venue = dims.TEST_SESSION
    df = dims.session_calendar(df.sparkSession).apply(
        df.drop("project", "venue"), {"production": "production", "session_ts": "session_ts"}
    )
    is_test = F.coalesce(F.col("session_ts") == ntz(test_at), F.lit(False))
    return df.withColumns(
        {
            "project": F.when(is_test, test_project).otherwise(F.coalesce("project", F.lit(""))),
            "venue": F.when(is_test, test_venue).otherwise(F.coalesce("venue", F.lit(""))),
        }
    )


def article_name(df: DataFrame, aliases: RuleSet, title: str, account: str, out: str) -> DataFrame:
    """Short article name; a title without one keeps its text."""
    df = aliases.apply(df, {"account": account, "title": title}, into={"alias": "_alias"})
    return df.withColumn(out, F.coalesce("_alias", title)).drop("_alias")


def owning_account(detail: str, names: dict[str, str] | None = None) -> Column:
    """Account group that owns a channel detail, by prefix or by name."""
    out = F.when(F.lit(False), F.lit(None))
    for account, prefixes, exact in dims.ACCOUNT_PREFIXES:
        out = out.when(
            any_prefix(detail, prefixes) | is_in(detail, exact), (names or {}).get(account, account)
        )
    return out.otherwise(dims.NO_ACCOUNT)


# -------------------------------------------------------------------------------- order sources
def clean_direct_orders(
    raw: DataFrame, patches: DataFrame, scope_out: str, patch_rows: int | None = None
) -> DataFrame:
    """Typed direct orders: patched codes, half-price tag, offline and out-of-scope rows dropped."""
    typed = raw.withColumns(
        {
            "下单时间": parse_ts("下单时间"),
            "票价": as_number("票价"),
            "优惠金额": as_number("优惠金额"),
            "结算金额": as_number("结算金额"),
        }
    )
    patched = patch_overlay(typed, patches, "订单号", "分销码", patch_rows)
    return half_price_tag(patched).filter(
        (F.col("来源") != OFFLINE_DESK) & ~F.col("项目").contains(scope_out)
    )


def half_price_tag(
    df: DataFrame, code: str = "分销码", discount: str = "优惠金额", price: str = "票价",
    at: str = "下单时间", since: str = HALF_PRICE_FROM, tag: str = HALF_PRICE_CODE,
) -> DataFrame:
    """Tag half-price orders without a code; an order of unknown discount loses its code."""
    half = F.abs(F.col(discount) - 0.5 * F.col(price)) < 1e-9
    cond = half & (F.col(at) >= ntz(since)) & (F.col(code) == NO_CODE)
    return df.withColumn(code, if_else(cond, F.lit(tag), F.col(code)))


def _direct_rows(
    orders: DataFrame, productions: RuleSet, referral: RuleSet, since: str
) -> DataFrame:
    """Known direct orders with attribution, before revenue shares.

    A missing project or address drops the order, like the test marker does.
    """
    rows = orders.filter(
        (F.col("项目") != TEST_TEXT) & (F.col("地址信息") != TEST_TEXT) & between("下单时间", since)
    )
    rows = attribute(production_of(rows, productions), referral, "分销码", "下单时间")
    return rows.withColumns(
        {
            "session_ts": parse_ts("开始时间"),
            "order_ts": F.col("下单时间"),
            "channel_type": direct_channel_type(),
            "face_price": F.col("票价").cast("double"),
            "net_revenue": F.col("结算金额").cast("double"),
            "tickets": F.lit(1),
            "recipient_name": F.col("收货人姓名"),
            "recipient_phone": F.col("收货人手机"),
            "address": F.col("地址信息"),
        }
    )


def direct_sales(
    orders: DataFrame,
    productions: RuleSet,
    referral: RuleSet,
    since: str,
    rate_production: str | None = "MA",
) -> DataFrame:
    """Direct sales with revenue shares.

    The reports price every order with the rules of one production; ``rate_production=None`` uses
    the order's own production instead.
    """
    rows = _direct_rows(orders, productions, referral, since).filter(
        F.col("production") != TEST_PRODUCTION
    )
    priced_as = F.lit(rate_production) if rate_production else F.col("production")
    rows = direct_rate(rows, priced_as)
    return conform(rows.withColumn("net_revenue", F.col("net_revenue") * F.col("rate")))


def tour_direct_sales(
    orders: DataFrame, productions: RuleSet, referral: RuleSet, since: str, production: str = "NTN"
) -> DataFrame:
    """Direct sales of one production at full settlement."""
    rows = _direct_rows(orders, productions, referral, since).filter(
        F.col("production") == production
    )
    return conform(rows.withColumn("venue", F.col("场馆")))


def patch_by_project(
    df: DataFrame, patches: list[tuple[str, list[str] | None, str]], code: str = "分销码"
) -> DataFrame:
    """Overwrite the code of listed projects, for all codes or only for the listed ones."""
    for project, only, new in patches:
        cond = is_in("项目", [project])
        if only is not None:
            cond = cond & is_in(code, only)
        df = df.withColumn(code, F.when(cond, F.lit(new)).otherwise(F.col(code)))
    return df


def distributor_sales(
    raw: DataFrame,
    productions: RuleSet,
    accounts: RuleSet,
    exclude_projects: list[str],
    patches: list[tuple[str, list[str] | None, str]] = (),
    rate_production: str | None = "MA",
) -> DataFrame:
    """Distributor-system orders: code patches, account, ticket type and revenue share."""
    rows = raw.filter(not_in("项目", exclude_projects) & (F.col("场地") != TEST_PLACE))
    rows = production_of(patch_by_project(rows, patches), productions)
    rows = accounts.apply(rows, {"label": "分销码"}, into={"value": "channel_detail"})
    rows = ticket_price(rows, "票种")
    priced_as = F.lit(rate_production) if rate_production else F.col("production")
    rows = distributor_rate(rows, priced_as)
    return conform(
        rows.withColumns(
            {
                "session_ts": parse_ts("开始时间"),
                "order_ts": parse_ts("下单时间"),
                "net_revenue": as_number("结算金额") * F.col("rate"),
                "recipient_name": F.col("收货人姓名"),
                "recipient_phone": F.col("收货人手机"),
                "address": F.col("地址信息"),
            }
        )
    )


def market_sales(direct: DataFrame, distributor: DataFrame) -> DataFrame:
    """Both systems with project and venue from the session calendar."""
    both = direct.unionByName(distributor)
    filled = both.withColumn("action_date", F.coalesce("action_date", F.lit("")))
    return conform(project_venue(filled))


def tour_master(parts: list[DataFrame], venue_project: RuleSet) -> DataFrame:
    """All sources of the tour with the project of the venue; rows without a session are dropped."""
    rows = union_all([conform(p) for p in parts]).filter(F.col("session_ts").isNotNull())
    return conform(
        venue_project.apply(rows.drop("project", "production"), {"label": "venue"}, into={"value": "project"})
    )


