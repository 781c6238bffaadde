"""Null rules, number and date rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticketlake.functions import dates as D
from ticketlake.functions import numbers as N
from ticketlake.functions import nulls as U
from ticketlake.functions.text import PRINTABLE, capture, split_pair
from ticketlake.operators import reshape
from ticketlake.schema import SALES_SCHEMA, conform, from_labels, to_labels


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def abn(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), (None, None), ("b", None)], "x string, n int")


def test_anti_filter_keeps_null(abn):
    assert [r[0] for r in rows(abn.filter(U.not_in("x", ["b"])))] == ["a", None]


def test_inequality_drops_null(abn):
    assert [r[0] for r in rows(abn.filter(F.col("x") != "b"))] == ["a"]


def test_strict_sum_and_sum0(abn):
    got = dict(
        (r[0], r[1:]) for r in rows(abn.groupBy("x").agg(U.strict_sum("n"), U.sum0("n")))
    )
    assert got == {"a": (1, 1), "b": (None, 2), None: (None, 0)}


def test_sums_over_no_rows_are_zero(abn):
    empty = abn.filter("x = 'zz'").agg(U.strict_sum("n"), U.sum0("n"), F.count("*"))
    assert rows(empty) == [(0, 0, 0)]


def test_paste_spells_missing_parts(spark):
    df = spark.createDataFrame([("t", None), ("t", None), ("t", "p")], "a string, b string")
    assert df.agg(F.countDistinct(U.paste("a", "b"))).first()[0] == 2


def test_join_on_missing_keys(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int")
    b = spark.createDataFrame([(None, 3)], "k2 string, w int")
    got = a.join(b, U.null_safe_on(a, b, [("k", "k2")]), "left").orderBy("v").select("v", "w")
    assert rows(got) == [(1, None), (2, 3)]


def test_sort_puts_null_last_both_ways(abn):
    assert [r[0] for r in rows(abn.orderBy(*U.na_last("x")))][-1] is None
    assert [r[0] for r in rows(abn.orderBy(*U.na_last("-x")))][-1] is None


def test_bad_number_is_null(spark):
    assert one(spark, N.as_number(F.lit("x")), N.as_count(F.lit("2.9")), N.as_count(F.lit("-2.9"))) == (None, 2, -2)


def test_capture_miss_is_null(spark):
    assert one(spark, capture(F.lit("abc"), "(\\d+)"), capture(F.lit("a12"), "(\\d+)")) == (None, "12")


def test_printable_matches_wide_text(spark):
    got = one(spark, capture(F.lit("场次时间：2024年 晚场"), f"^场次时间：({PRINTABLE}*)"))
    assert got == ("2024年 晚场",)


def test_number_text(spark):
    got = one(spark, *[N.num_text(F.lit(x)) for x in (12345678.0, 0.051, 2.5, 0.0, 1e10, -3.0)])
    assert got == ("12345678", "0.051", "2.5", "0", "10000000000", "-3")


def test_if_else_with_unknown_condition(spark):
    got = one(spark, U.if_else(F.lit(None).cast("boolean"), F.lit("a"), F.lit("b")))
    assert got == (None,)


def test_magnitudes(spark):
    got = one(
        spark,
        *[N.magnitude(F.lit(x), "Ww") for x in ("1.5W", "2w", "300", "x")],
        *[N.magnitude(F.lit(x), "万", whole=False) for x in ("1.5万", "2万", "7")],
    )
    assert got == (15000.0, 20000.0, 300.0, None, 15000.0, None, 7.0)


def test_commas_and_apostrophes(spark):
    assert one(spark, N.strip_commas(F.lit("1,080")), N.strip_apostrophe(F.lit("'12"))) == (1080.0, 12.0)


def test_rates(spark):
    got = one(
        spark,
        N.rate_text(F.lit(3), F.lit(5886)),
        N.rate_text(F.lit(3), F.lit(None).cast("double")),
        N.rate_text(F.lit(3), F.lit(0)),
    )
    assert got == ("0.051%", "", "")


def test_excel_serial(spark):
    got = one(spark, D.excel_serial(F.lit("45259.8125")), D.excel_serial(F.lit("x")))
    assert got == (dt.datetime(2023, 11, 29, 19, 30), None)


@pytest.mark.parametrize(
    "text,want",
    [
        ("2024-03-22 20:00:00", dt.datetime(2024, 3, 22, 20)),
        ("2024-3-2 9:30", dt.datetime(2024, 3, 2, 9, 30)),
        ("2024/3/2", dt.datetime(2024, 3, 2)),
        ("20240302", dt.datetime(2024, 3, 2)),
        ("2024年03月22日 20:00:00", dt.datetime(2024, 3, 22, 20)),
        ("2024年3月5日 19:30", dt.datetime(2024, 3, 5, 19, 30)),
        ("2023-02-29", None),
        ("2024-03", None),
        ("foo", None),
        (None, None),
    ],
)
def test_parse_ts(spark, text, want):
    assert one(spark, D.parse_ts(F.lit(text).cast("string"))) == (want,)


def test_published_date(spark):
    got = one(spark, D.parse_published(F.lit("发布于 2024-01-30")), D.parse_published(F.lit("2024-01-30")))
    assert got == (dt.datetime(2024, 1, 30), None)


def test_week_bounds_and_weekday(spark):
    day = F.lit("2024-01-30").cast("date")
    got = one(spark, D.last_monday(day), D.this_sunday(day), D.zh_weekday(day))
    assert got == (dt.date(2024, 1, 29), dt.date(2024, 2, 4), "周二")
    monday, sunday = F.lit("2024-01-29").cast("date"), F.lit("2024-02-04").cast("date")
    got = one(spark, D.last_monday(monday), D.this_sunday(sunday))
    assert got == (dt.date(2024, 1, 29), dt.date(2024, 2, 4))


def test_season_dates(spark):
    got = one(spark, D.dot_date(F.lit("12.3")), D.dot_date(F.lit("1.28")), D.dot_date(F.lit("1.28"), 2023), D.month_day(F.lit("04-05"), 2024))
    assert got == (
        dt.datetime(2023, 12, 3), dt.datetime(2024, 1, 28), dt.datetime(2023, 1, 28), dt.datetime(2024, 4, 5),
    )


def test_bad_session_text_is_null(spark):
    pattern = r"(\d{4}-\d{2}-\d{2}).*?(\d{2}):(\d{2})"
    got = one(spark, D.session_from(F.lit("foo"), pattern), D.session_from(F.lit("x 2024-03-22 周五 20:00"), pattern))
    assert got == (None, dt.datetime(2024, 3, 22, 20))


def test_normalize_session(spark):
    assert one(spark, D.normalize_session(F.lit("2024/3/2 9:30"))) == ("2024-03-02 09:30:00",)


def test_day_window_is_half_open(spark):
    df = spark.createDataFrame([("2024-01-30 00:00:00",), ("2024-01-30 23:59:59",), ("2024-01-31 00:00:00",), (None,)], "t string")
    kept = df.withColumn("t", D.ntz(F.col("t"))).filter(D.day_window("t", "2024-01-30"))
    assert kept.count() == 2


def test_split_pair(spark):
    assert one(spark, *split_pair(F.lit("a-b-c"))) == ("a", "b-c")
    assert one(spark, *split_pair(F.lit("abc"))) == (None, None)


def test_conform_pads_and_orders(spark):
    df = spark.createDataFrame([("x", "3.7", 1)], "channel_detail string, net_revenue string, other int")
    got = conform(df)
    assert got.schema == SALES_SCHEMA
    assert got.first().asDict()["net_revenue"] == 3.7 or str(got.first()["net_revenue"]) == "3.7000"
    assert got.first()["session_ts"] is None


def test_labels_round_trip(spark):
    df = conform(spark.createDataFrame([("x",)], "channel_detail string"))
    assert from_labels(to_labels(df)).columns == df.columns
    assert to_labels(df).columns[0] == "剧目"


def test_relocate(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert reshape.relocate(df, ["c"]).columns == ["c", "a", "b"]
    assert reshape.relocate(df, ["a"], last=True).columns == ["b", "c", "a"]
    assert reshape.relocate(df, ["c"], before="b").columns == ["a", "c", "b"]
    assert reshape.relocate(df, ["a"], after="b").columns == ["b", "a", "c"]


def test_marks_need_the_whole_number(spark):
    row = spark.range(1).select(*[N.magnitude(F.lit(x), "Ww") for x in ("1,080W", "x1W", "3W")]).first()
    assert tuple(row) == (None, None, 30000.0)


def test_first_patch_wins(spark):
    from ticketlake.operators.lookup import patch_overlay

    orders = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, v string")
    patches = spark.createDataFrame([("1", None, 1), ("1", "zz", 2), ("1", "aa", 3)], "k string, v string, n int")
    for given, order in ((patches, "n"), (patches.select("k", "v").coalesce(1), None)):
        assert {tuple(r) for r in patch_overlay(orders, given, "k", "v", order=order).collect()} == {("1", "zz"), ("2", "y")}


def test_numbers_that_do_not_fit_fail(spark):
    import pytest

    from ticketlake.schema import conform

    for row in ((5e14 * 1000, 1.0), (1.0, 3e9)):
        with pytest.raises(Exception, match="does not fit"):
            conform(spark.createDataFrame([row], "net_revenue double, tickets double")).collect()
    got = conform(spark.createDataFrame([("x", "y")], "net_revenue string, tickets string")).first()
    assert (got["net_revenue"], got["tickets"]) == (None, None)
