"""Report functions on small tables with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.plans import channels as ch
from ticketlake.plans import daily, inventory, weekly
from ticketlake.schema import CONTENT_SCHEMA, FOLLOWERS_SCHEMA, SALES_SCHEMA, conform
from ticketlake.streaming import flows

DAY = "2024-01-30"
NAMES = "channel_type,channel_detail,venue,project,order_ts,session_ts,recipient_name,recipient_phone,tickets,net_revenue,action_date,action_type"
DATA = [
    ("自营", "推文-a", "v1", "p1", "2024-01-30 10:00:00", "2024-02-01 20:00:00", "n1", "1", 1, 100.0, "2024-01-30", "推文-开票"),
    ("自营", "推文-a", "v1", "p1", "2024-01-30 10:00:00", "2024-02-01 20:00:00", "n2", "1", 1, 100.0, "2024-01-30", "推文-仅销售"),
    ("自营", "推文-a", "v2", "p2", "2024-01-30 11:00:00", "2024-02-01 20:00:00", "n1", None, 1, None, "2024-01-30", "推文-开票"),
    ("自营", "推文-a", "v2", "p2", "2024-01-30 11:00:00", "2024-02-01 20:00:00", "n1", None, 1, 50.0, "2024-01-30", None),
    ("分销-系统", "d", "v1", "p1", "2024-01-30 23:59:59", "2024-02-02 20:00:00", "n", "2", 2, 10.0, "", None),
    ("分销-报单", "d", "v1", "p1", "2024-01-31 00:00:00", "2024-02-02 20:00:00", "n", "2", 2, 10.0, "", None),
    ("大客户", "k", "v1", "p1", "2024-01-30 12:00:00", "2024-02-02 20:00:00", "n", "2", 5, 70.0, "", "大客户"),
    ("票务网站", "猫眼", "v2", "p2", "2024-01-30 12:00:00", "2024-02-02 20:00:00", "n", "2", 3, 30.0, None, None),
    (None, "x", "v2", "p2", "2024-01-30 12:00:00", "2024-02-02 20:00:00", "n", "2", 4, 40.0, None, None),
]


@pytest.fixture(scope="module")
def sales(spark):
    return conform(spark.createDataFrame(DATA, NAMES.split(",")))


def got(df, *cols):
    return {tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in df.select(*cols).collect()}


def test_daily_summary(sales):
    assert got(daily.daily_summary(sales, DAY), "channel_group", "project", "tickets", "revenue") == {
        ("自营", "p1", 2, 200.0), ("自营", "p2", 2, 50.0), ("分销", "p1", 2, 10.0), ("大客户", "p1", 5, 70.0),
        ("票务网站", "p2", 3, 30.0), (None, "p2", 4, 40.0),
    }


def test_week_is_the_sum_of_its_days(sales):
    days = daily.daily_summary_all_days(sales)
    assert days.agg(F.sum("tickets")).first()[0] == sales.agg(F.sum("tickets")).first()[0]


def test_project_total(sales):
    assert got(daily.project_total(sales), "project", "revenue") == {("p1", 290.0), ("p2", 120.0)}
    assert got(daily.project_total(sales, True), "project", "revenue") == {("p1", 220.0), ("p2", 80.0)}


def test_order_identity(sales):
    by_phone = got(daily.action_performance(sales, DAY), "action_type", "orders", "tickets", "revenue")
    assert by_phone == {("推文", 2, 3, 200.0), ("自然销售", 1, 1, 50.0)}
    by_name = got(daily.order_grain(sales, DAY), "action_type", "orders", "tickets", "revenue")
    assert by_name == {("推文", 3, 3, None), (None, 1, 1, 50.0)}


def test_cumulative_by_venue(sales):
    r = daily.cumulative_by_venue(sales, "2024-01-31", ["v1", "v2", "v9"]).first()
    assert (float(r["v1"]), r["v2"], r["v9"]) == (280.0, None, None)


def test_daily_matrix(sales):
    matrix = daily.sort_matrix(daily.daily_matrix(sales, DAY, ["v1", "v9"]))
    rows = [tuple(r) for r in matrix.select("channel", "v1", "v9").collect()]
    assert rows == [
        ("自营售票数", "2", "0"), ("自营收入", "200", "0"), ("分销售票数", "2", "0"), ("分销收入", "10", "0"),
        ("票务网站售票数", "0", "0"), ("票务网站收入", "0", "0"), ("NA售票数", "0", "0"), ("NA收入", "0", "0"),
        ("大客户售票数", "5", "0"), ("大客户收入", "70", "0"),
    ]
    assert daily.matrix_numbers(matrix, ["v1", "v9"]).columns == ["v1", "v9"]


def test_breakdowns(sales):
    dist = got(daily.distributor_breakdown(sales, DAY), "channel_detail", "tickets")
    assert dist == {("d", 2), ("x", 4)}
    assert got(daily.platform_breakdown(sales, DAY), "channel_detail", "project", "tickets") == {("猫眼", "p2", 3)}
    assert daily.has_direct_sales(sales, DAY) and not daily.has_direct_sales(sales, "2020-01-01")


def test_session_daily(sales):
    # Two groups are listed, the others are found: 票务网站 and the unknown one.
    wide = daily.session_daily(sales, DAY, ["自营", "分销"])
    assert got(wide, "project", "tickets_票务网站", "tickets_NA") == {("p1", "", ""), ("p2", "", ""), ("p2", "3", "4")}
    assert got(wide, "project", "weekday", "tickets_自营", "revenue_自营", "tickets_分销") == {
        ("p1", "周四", "2", "200", ""), ("p2", "周四", "2", None, ""), ("p1", "周五", "5", "70", "2"), ("p2", "周五", "", "", ""),
    }
    assert [c for c in wide.columns if c.startswith("tickets_")] == ["tickets_自营", "tickets_分销", "tickets_NA", "tickets_票务网站"]
    listed = daily.session_daily(sales, DAY, ["自营", "none"])
    assert got(listed, "tickets_none") == {("",)}


def test_session_daily_shares_a_column(sales):
    wide = daily.session_daily(sales, DAY, ["自营"], most=0)
    assert [c for c in wide.columns if c.startswith("tickets_")] == ["tickets_自营", "tickets_others"]
    assert got(wide, "project", "weekday", "tickets_others") == {("p1", "周四", ""), ("p2", "周四", ""), ("p1", "周五", "2"), ("p2", "周五", "7")}


def test_direct_breakdown(spark, sales):
    reach = dims.campaign_reach(spark, [("推文-a", "2024-01-30", 5886, 100.0)])
    campaigns = daily.campaign_performance(sales, "2024-01-31", reach)
    report = daily.direct_breakdown_report(daily.direct_breakdown(sales, DAY, campaigns))
    rows = [tuple(r)[:1] + tuple(r)[4:8] for r in report.collect()]
    assert rows == [("推文-a", "5886", "0.051%", "0.051%", "0.051%"), ("推文-a", "5886", "0.017%", "0.017%", "0.017%")]


def stock(spark, rows, cols):
    df = spark.createDataFrame(rows, ["s", "t", *cols])
    return df.select(F.col("s").cast("timestamp_ntz").alias("session_ts"), F.col("t").cast("decimal(18,4)").alias("tier"), *cols)


def test_reconcile(spark):
    s = "2024-03-22 20:00:00"
    own = stock(spark, [(s, 880, 10, 5, 100), ("2024-02-24 15:00:00", 880, 1, 1, 1)], ["self_available", "self_locked", "self_sold"])
    venue = stock(spark, [(s, 880, 50)], ["venue_sold"])
    platform = stock(spark, [(s, 880, 20, 30)], ["channel_available", "channel_sold"])
    alone = stock(spark, [("2024-04-05 19:30:00", 480, 7)], ["venue_sold"])
    rows = inventory.combine(own, [venue, platform], [alone])
    tiers = inventory.by_tier(rows, dims.session_table(spark, dims.CANCELLED_SESSIONS))
    done = inventory.reconcile(tiers, dims.tour_capacity(spark))
    assert got(done, "tier", "venue_available", "seats") == {(880.0, 63, 278), (480.0, 137, 144)}
    full = done.select(sum(F.col(c) for c in inventory.STATES).alias("n"), "seats")
    assert full.filter("n <> seats").count() == 0
    assert inventory.by_session(done).count() == 2
    assert inventory.only_sessions(done, [s]).count() == 1
    bad = stock(spark, [(s, 1, 1)], ["self_sold"])
    with pytest.raises(Exception, match="undefined capacity"):
        inventory.reconcile(inventory.by_tier(inventory.combine(bad, [], [])), dims.tour_capacity(spark), strict=True).collect()


def test_sell_through(spark, sales):
    sold = sales.withColumns({"production": F.lit("MA"), "face_price": F.lit(680).cast("decimal(18,4)")})
    asked = stock(spark, [("2024-02-01 20:00:00", 680), ("2024-02-03 20:00:00", 680)], []).withColumn("production", F.lit("MA"))
    assert got(daily.sell_through(asked, sold), "session_ts", "tickets", "revenue") == {
        (dt.datetime(2024, 2, 1, 20), 4, None), (dt.datetime(2024, 2, 3, 20), 0, 0.0),
    }


def test_account_summary_kinds(spark):
    kinds = [("微信", "a", "articles"), ("微信", "v", "videos"), ("微信", "v0", "videos"), ("微信", "s", "service"),
             ("微博", "w", "posts"), ("小红书", "f", "followers")]
    accounts = spark.createDataFrame(kinds, "platform string, account string, kind string")
    days = [("微信", "a", "2023-12-18", 9, 5, 1), ("微信", "a", "2023-12-24", 10, 2, 1), ("微信", "v", "2023-12-24", 3, 1, 0),
            ("微信", "v0", "2023-12-20", 3, 1, 0), ("微信", "s", "2023-12-17", 100, None, None), ("微信", "s", "2023-12-24", 120, None, None)]
    followers = conform(spark.createDataFrame(days, "platform string, account string, day string, total int, new int, cancelled int"), FOLLOWERS_SCHEMA)
    posts = [("微信", "a", "2023-12-18", 7, None, 1), ("微信", "v", "2023-12-19", 5, 6, 2), ("微信", "v", "2023-12-25", 5, 6, 2)]
    items = conform(spark.createDataFrame(posts, "platform string, account string, published_at string, views int, interactions int, shares int"), CONTENT_SCHEMA)
    mondays = spark.createDataFrame([("微博", "w", 50.0, 5.0), ("小红书", "f", 8.0, 1.0)], "platform string, account string, followers double, change double")
    done = weekly.account_summary(accounts, followers, items, mondays, "2023-12-18", "2023-12-25")
    assert got(done, "account", "followers", "change", "items", "views", "interactions", "shares") == {
        ("a", 10.0, 5.0, 1.0, 7.0, "-", 1.0), ("v", 3.0, 1.0, 1.0, 5.0, "6", 2.0), ("s", 120.0, 20.0, None, None, None, None),
        ("w", 50.0, 5.0, 0.0, 0.0, "0", 0.0), ("f", 8.0, 1.0, None, None, None, None),
    }
    revenue = spark.createDataFrame([("微博", "w", 3, 10.5), ("抖音", "d", 1, 1.0)], "platform string, account string, tickets int, revenue double")
    report = weekly.cross_platform_report(done, revenue)
    assert got(report.filter("account in ('w', 'd', 's')"), "account", "items", "interactions", "tickets", "revenue") == {
        ("w", "0", "0", "3", "10.5"), ("d", "-", "-", "1", "1"), ("s", "-", "-", "-", "-"),
    }


def test_monday_followers(spark):
    wide = spark.createDataFrame([("2023-12-11", 1, 5), ("2023-12-25", 9, 7), ("2023-12-18", 4, 6)], ["day", "微博", "b站"])
    accounts = weekly.social_account(spark, [("微博", "微博", "w"), ("b站", "b站", "b")])
    done = weekly.monday_followers(wide.withColumn("day", F.col("day").cast("date")), "day", accounts)
    assert got(done, "account", "followers", "change") == {("w", 9, 5), ("b", 7, 1)}


def test_stream_equals_batch(spark, sales, tmp_path):
    folder = str(tmp_path / "in")
    sales.repartition(3).write.parquet(folder)
    stream = flows.parquet_files(spark, folder, SALES_SCHEMA, per_batch=1)
    done = flows.finished(spark, flows.daily_revenue(stream), "t", complete=True)
    want = sales.groupBy(F.to_date("order_ts").alias("order_day"), daily.channel_group().alias("channel_group")).agg(*daily.totals())
    assert got(done, *want.columns) == got(want, *want.columns)


def test_append_stream_emits_final_days_only(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for part in (["2024-01-01 10:00:00", "2024-01-01 11:00:00"], ["2024-01-09 10:00:00"]):
        rows = [("自营", t, 1, 1.0) for t in part]
        conform(spark.createDataFrame(rows, ["channel_type", "order_ts", "tickets", "net_revenue"])).coalesce(1).write.mode("append").parquet(folder)
        flows.run_available(flows.daily_revenue(flows.parquet_files(spark, folder, SALES_SCHEMA)), out, check)
    assert got(spark.read.parquet(out), "order_day", "tickets") == {(dt.date(2024, 1, 1), 2)}


def test_sell_through_meets_missing_keys(spark):
    columns = "production string, session_ts timestamp_ntz, face_price decimal(18,4), tickets int, net_revenue decimal(18,4)"
    sold = spark.createDataFrame([("MA", None, None, 3, None)], columns).withColumn("net_revenue", F.lit(30).cast("decimal(18,4)"))
    asked = spark.createDataFrame([("MA", None, None), ("MOR", None, None)], "production string, session_ts timestamp_ntz, tier decimal(18,4)")
    found = {r["production"]: r["tickets"] for r in daily.sell_through(asked, sold).collect()}
    assert found == {"MA": 3, "MOR": 0}


def test_wide_table_reads_a_text_once_a_row(spark):
    schema = "`商品说明` string, `数量` string, `结算价小计` string, `用户姓名` string"
    rows = [
        ("票种：880档单人票2张，使用时间：2024-01-03 14:30", "2", "10.5", "n"),
        ("票种：880档单人票，使用时间：2024-01-03 14:30", "0", "1", "n"),
        ("票种：880档单人票，使用时间：foo", "2", "1", "n"),
        ("无说明", "2", "1", "n"),
        (None, None, None, None),
    ]
    raw = spark.createDataFrame(rows, schema).withColumn("商品说明", F.concat("商品说明", F.lit("")))
    wide = ch.load_wide([ch.worded_orders(raw), ch.worded_orders(raw)], "MA")
    assert [(str(r.session_ts), r.tickets, float(r.net_revenue), r.production) for r in wide.collect()] == [
        ("2024-01-03 14:30:00", 4, 10.5, "MA")
    ] * 2
    plan = wide._jdf.queryExecution().optimizedPlan().toString().split("\n")
    filters = [line for line in plan if line.lstrip(" :+-").startswith("Filter")]
    assert filters and not any("RLIKE" in line or "regexp" in line for line in filters)
