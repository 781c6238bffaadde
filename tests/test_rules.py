"""Rule tables against a row-by-row reading of the rules, and the golden lookups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.operators.lookup import patch_overlay, small_side
from ticketlake.operators.rules import RuleSet
from ticketlake.plans import channels, sales

# Rules with the shapes of the real table: open and closed windows, a gap, and a code written twice.
RULES = [
    ("zaoniaoduanxin", None, "2023-08-21 10:00:00", "短信", "2023-08-17", "短信"),
    ("zaoniaoduanxin", "2023-08-21 10:00:00", "2023-08-23 15:00:00", "短信", "2023-08-21", "短信"),
    ("zaoniaoduanxin", "2023-08-23 15:00:00", None, "短信", "2023-08-24", "短信"),
    ("QMvXQvGvSZ", "2023-08-27", "2023-08-29", "小七点对点-深圳", "2023-08-27", "小七点对点"),
    ("QMvXQvGvSZ", "2023-09-06", None, "小七点对点-深圳-全票档", "2023-09-06", "小七点对点"),
    ("QMvGZHvEvAAvC", None, None, "推文-MOR交流会招募", "2023-09-15", "推文-含品宣"),
    ("QMvGZHvEvAAvC", None, None, "推文-MOR选角", "2023-08-25", "推文-含品宣"),
]


def look(spark, rules, code, at):
    df = spark.createDataFrame([(code, at)], "code string, at string")
    got = sales.attribute(df.withColumn("at", F.col("at").cast("timestamp_ntz")), rules, "code", "at")
    return tuple(got.select("channel_detail", "action_date", "action_type").first())


@pytest.mark.parametrize(
    "code,at,want",
    [
        ("zaoniaoduanxin", "2023-08-21 09:59:00", ("短信", "2023-08-17", "短信")),
        ("zaoniaoduanxin", "2023-08-21 10:00:00", ("短信", "2023-08-21", "短信")),
        ("zaoniaoduanxin", "2023-08-23 15:00:00", ("短信", "2023-08-24", "短信")),
        ("QMvXQvGvSZ", "2023-08-30 00:00:00", ("其他", "", "其他")),
        ("QMvGZHvEvAAvC", "2023-08-30 00:00:00", ("推文-MOR选角", "2023-08-25", "推文-含品宣")),
        ("QMvGZHvEvAAvC", None, ("推文-MOR选角", "2023-08-25", "推文-含品宣")),
        ("zaoniaoduanxin", None, ("其他", "", "其他")),
        ("zzz", "2023-08-30 00:00:00", ("其他", "", "其他")),
        (None, "2023-08-30 00:00:00", ("其他", "", "其他")),
    ],
)
def test_referral_golden(spark, code, at, want):
    assert look(spark, dims.referral(spark, RULES), code, at) == want


def test_loaded_referral_rules(spark, tmp_path):
    lines = ["rule_no,code,ts_from,ts_to,detail,action_date,action_type"]
    for i, r in enumerate(RULES):
        lines.append(",".join([str(i), *["" if v is None else v for v in r]]))
    path = tmp_path / "referral.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    rules = dims.load_referral(spark, str(path))
    assert look(spark, rules, "zaoniaoduanxin", "2023-08-22 00:00:00") == ("短信", "2023-08-21", "短信")
    assert look(spark, rules, "QMvXQvGvSZ", "2023-08-30 00:00:00") == ("其他", "", "其他")


def naive(rules, code, at):
    """The rules read one after the other."""
    out = ["其他", "", "其他"]
    for c, lo, hi, *values in rules:
        if c != code or (at is None and (lo is not None or hi is not None)):
            continue
        if (lo is None or at >= lo) and (hi is None or at < hi):
            out = [v if v is not None else o for v, o in zip(values, out)]
    return tuple(out)


@pytest.mark.parametrize("seed", range(4))
def test_segments_equal_sequential_rules(spark, seed):
    rnd = random.Random(seed)
    stamps = [str(dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(12)]
    rules = []
    for n in range(40):
        lo, hi = rnd.choice([None, *stamps]), rnd.choice([None, *stamps])
        rules.append((rnd.choice("abc"), lo, hi, f"L{n}", rnd.choice([None, f"d{n}"]), f"t{n}"))
    facts = [(rnd.choice(["a", "b", "c", "d", None]), rnd.choice([*stamps, None])) for _ in range(200)]
    df = spark.createDataFrame([(i, *f) for i, f in enumerate(facts)], "i int, code string, at string")
    typed = df.withColumn("at", F.col("at").cast("timestamp_ntz"))
    ruleset = dims.referral(spark, rules)
    # The order of the stored rows does not matter, only the rule number.
    shuffled = RuleSet(
        "r", ruleset.table.orderBy(F.rand(seed)), ruleset.keys, ruleset.outputs, True, "last", len(rules)
    )
    got = {r["i"]: (r["channel_detail"], r["action_date"], r["action_type"])
           for r in sales.attribute(typed, shuffled, "code", "at").collect()}
    assert got == {i: naive(rules, c, t) for i, (c, t) in enumerate(facts)}


def test_lookup_keeps_row_count_and_audits(spark):
    df = spark.createDataFrame([("680元",), ("zz",), (None,), ("zz",)], "label string")
    price = dims.price_label(spark)
    assert price.apply(df, {"label": "label"}).count() == 4
    assert [tuple(r) for r in price.audit(df, {"label": "label"}).collect()] == [("price_label", "zz", 2)]


def test_first_key_wins(spark):
    rules = dims.session_label(spark, [("11.18 19:30", "2099-01-01 00:00:00")])
    df = spark.createDataFrame([("11.18 19:30",)], "label string")
    assert rules.apply(df, {"label": "label"}).first()["session"] == dt.datetime(2023, 11, 18, 19, 30)


def test_price_and_package(spark):
    df = spark.createDataFrame([("880*3（套票）",)], "label string")
    got = dims.package_label(spark).apply(dims.price_label(spark).apply(df, {"label": "label"}), {"label": "label"})
    assert tuple(got.select("price", "packs").first()) == (880.0, 3)


def test_ticket_types(spark):
    df = spark.createDataFrame([("原价380元",), ("580两张买一赠一",), ("foo",), ("测试票种1",), (None,)], "t string")
    got = {r["t"]: (r["face_price"], r["tickets"]) for r in sales.ticket_price(df, "t").collect()}
    assert got == {"原价380元": (380, 1), "580两张买一赠一": (580, 2), "foo": (0, 0), "测试票种1": (0.01, 0.01), None: (0, 0)}


@pytest.mark.parametrize(
    "name,price,want", [("三叶草-深圳", 780.0, 0.9), ("三叶草-深圳", 779.0, 1.0), ("一起旅课", 1080.0, 1.0), ("zz", 1080.0, None)]
)
def test_distributor_rate(spark, name, price, want):
    df = spark.createDataFrame([(name, price)], "channel_detail string, face_price double")
    assert sales.distributor_rate(df, F.lit("MA")).first()["rate"] == want


def test_direct_channel_type_default(spark):
    df = spark.createDataFrame([(None,), ("大客户",), ("分销",)], "action_type string")
    got = [r[0] for r in df.select(sales.direct_channel_type()).collect()]
    assert got == ["自营", "大客户", "分销-系统"]


@pytest.mark.parametrize("detail,want", [("服务号推文-x", "服务号"), ("推文-x", "订阅号"), ("微博-x", "微博"), ("朋友圈-x", "无"), (None, "无")])
def test_owning_account(spark, detail, want):
    df = spark.createDataFrame([(detail,)], "d string")
    assert df.select(sales.owning_account("d")).first()[0] == want


def test_patch_overlay_first_and_unique(spark):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "k string, v string")
    patches = spark.createDataFrame([("2", "p"), ("2", "p"), ("3", "q"), ("1", None)], "k string, v string")
    got = sorted(tuple(r) for r in patch_overlay(df, patches, "k", "v").select("k", "v").collect())
    assert got == [("1", "a"), ("2", "p")]


def test_half_price_tag(spark):
    data = [("-", 50.0, "2023-12-04"), ("-", None, "2023-12-04"), ("-", 10.0, "2023-12-04"), ("-", 50.0, "2023-12-01"), ("x", 50.0, "2023-12-04")]
    df = spark.createDataFrame(data, "`分销码` string, `优惠金额` double, t string").withColumns(
        {"下单时间": F.col("t").cast("timestamp_ntz"), "票价": F.lit(100.0)}
    )
    assert [r[0] for r in sales.half_price_tag(df).select("分销码").collect()] == ["ikids", None, "-", "-", "x"]


@pytest.mark.parametrize(
    "production,session,tier,want",
    [("MA", "2023-11-17 19:30:00", 1080, 355), ("MOR", "2023-12-17 19:30:00", 980, 90), ("MA", "2023-11-17 19:30:00", 980, None)],
)
def test_seats(spark, production, session, tier, want):
    df = spark.createDataFrame([(production, session, tier)], "production string, s string, t int").select(
        "production", F.col("s").cast("timestamp_ntz").alias("session_ts"), F.col("t").cast("decimal(18,4)").alias("tier")
    )
    keys = ["production", "session_ts", "tier"]
    assert dims.seat_capacity(spark).apply(df, {k: k for k in keys}).first()["seats"] == want


def test_calendar_sizes(spark):
    calendar = dims.session_calendar(spark).table
    assert calendar.count() == 87
    assert dims.seat_capacity(spark).table.count() == 87 * 7
    assert dims.tour_capacity(spark).table.count() == 60
    assert dims.bulk_slot(spark).table.count() == 39


@pytest.mark.parametrize("production,want", [("MA", dt.datetime(2023, 12, 2, 14, 30)), ("MOR", dt.datetime(2023, 12, 2, 14))])
def test_matinee_override(spark, production, want):
    df = spark.createDataFrame([("2023-12-02 午场", production)], "slot string, production string")
    assert channels.bulk_session(df, "slot", "production").first()["session_ts"] == want


def test_big_side_is_not_broadcast(spark, monkeypatch):
    from ticketlake.operators import lookup

    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", 10)
    plan = small_side(spark.range(100).toDF("k"))._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()
    plan = small_side(spark.range(5).toDF("k"))._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan.lower()


def test_repeated_keys_with_different_values(spark):
    rules = dims.text_map(spark, "m", [("a", "1"), ("a", "2"), ("b", "1"), ("b", "1")])
    assert [r["label"] for r in rules.duplicates().collect()] == ["a"]


def test_hot_code_is_attributed_without_a_shuffle(spark):
    """A third of all rows with one code: the rule side is broadcast, the rows stay where they are."""
    code = F.when(F.col("id") % 3 == 0, "zaoniaoduanxin").otherwise(F.concat(F.lit("c"), F.col("id") % 7))
    df = spark.range(30_000).select(code.alias("code"), F.lit("2023-08-22").cast("timestamp_ntz").alias("at"))
    got = sales.attribute(df, dims.referral(spark, RULES), "code", "at")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert got.filter("action_date = '2023-08-21'").count() == 10_000


def random_rules(rnd, n, codes="abc", days=12):
    stamps = [str(dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(days)]
    return stamps, [
        (rnd.choice(codes), rnd.choice([None, *stamps]), rnd.choice([None, *stamps]), f"L{i}", rnd.choice([None, f"d{i}"]), f"t{i}")
        for i in range(n)
    ]


@pytest.mark.parametrize("path", ["literal", "swept", "blocks"])
@pytest.mark.parametrize("conflict", ["last", "first"])
def test_settled_in_every_way(spark, monkeypatch, path, conflict):
    from ticketlake.operators import rules as module

    rnd = random.Random(f"{path}{conflict}")
    stamps, given = random_rules(rnd, 70, days=30)
    facts = [(rnd.choice(["a", "b", "c", "d", None]), rnd.choice([*stamps, None])) for _ in range(300)]
    base = dims.referral(spark, given)
    monkeypatch.setattr(module, "PAGE", 4)
    if path == "blocks":
        monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 10)
    if path == "literal":
        ruleset = RuleSet.of(spark, "r", given, dims.REFERRAL_KEYS, dims.REFERRAL_OUTPUTS, "timestamp_ntz", conflict)
    else:
        ruleset = RuleSet("r", base.table.repartition(3), base.keys, base.outputs, True, conflict)
    assert len(ruleset._pages) >= 2
    df = spark.createDataFrame([(i, *f) for i, f in enumerate(facts)], "i int, code string, at string")
    typed = df.withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = {r["i"]: (r["channel_detail"], r["action_date"], r["action_type"])
           for r in sales.attribute(typed, ruleset, "code", "at").collect()}
    ordered = given if conflict == "last" else given[::-1]
    assert got == {i: naive(ordered, c, t) for i, (c, t) in enumerate(facts)}
    audit = {r["label"]: r["rows"] for r in ruleset.audit(typed, {"code": "code"}, "at").collect()}
    want = {}
    for c, t in facts:
        if c is not None and not any(covers(r, c, t) for r in given):
            want[c] = want.get(c, 0) + 1
    assert audit == want


def covers(rule, code, at):
    c, lo, hi = rule[:3]
    if at is None:
        return c == code and lo is None and hi is None
    return c == code and (lo is None or at >= lo) and (hi is None or at < hi)


def test_many_rules_on_one_code(spark):
    """200,000 overlapping rules of one code and as many rows: the last rule that holds a row is its last start."""
    import time

    n = 200_000
    day = F.lit("2024-01-01").cast("timestamp_ntz")
    at = day + F.make_dt_interval(secs=F.col("id"))
    table = spark.range(n).select(
        F.col("id").cast("int").alias("rule_no"), F.lit("x").alias("code"), at.alias("lo"),
        (at + F.make_dt_interval(secs=F.col("id") % 500 + 1)).alias("hi"), F.concat(F.lit("L"), F.col("id")).alias("detail"),
    )
    rules = RuleSet("many", table, ("code",), {"detail": "none"}, True, "last", n)
    facts = spark.range(n).select("id", F.lit("x").alias("code"), at.alias("at"))
    start = time.time()
    wrong = rules.apply(facts, {"code": "code"}, "at").filter(F.col("detail") != F.concat(F.lit("L"), F.col("id"))).count()
    assert wrong == 0 and time.time() - start < 60
    first = RuleSet("many", table, ("code",), {"detail": "none"}, True, "first", n)
    got = first.apply(facts.filter("id in (0, 700, 199999)"), {"code": "code"}, "at").orderBy("id").collect()
    assert [r["detail"] for r in got] == [
        "L" + str(min(i for i in range(max(0, k - 500), k + 1) if i + i % 500 + 1 > k)) for k in (0, 700, 199_999)
    ]


def test_large_tables_are_settled_without_a_group_per_key(spark, monkeypatch):
    from ticketlake.operators import rules as module

    monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 100)
    n = 3000
    table = spark.range(n).selectExpr("cast(id as int) as rule_no", "'x' as code", "cast(id % 1000 as double) as lo",
                                      "cast(id % 1000 + 1 + id % 7 * 100 as double) as hi", "cast(id as string) as v")
    rules = RuleSet("large", table, ("code",), {"v": ""}, True, "last")
    got = {r["at"]: r["v"] for r in rules.apply(
        spark.range(0, 1700, 13).selectExpr("'x' as code", "cast(id as double) as at"), {"code": "code"}, "at").collect()}
    for at, v in got.items():
        fits = [i for i in range(n) if i % 1000 <= at < i % 1000 + 1 + i % 7 * 100]
        assert v == (str(max(fits)) if fits else "")


def test_a_few_literal_rules_need_no_join(spark):
    rules = RuleSet.of(
        spark, "m", [("a'b", "x", "1"), ("a\\", None, "2"), ("a'b", "x", None), (None, "x", "3"), ("e", "f", "4")],
        {"k": "string", "l": "string"}, {"v": ("double", None)},
    )
    df = spark.createDataFrame([("a'b", "x"), ("a\\", None), (None, "x"), ("e", "f"), ("ef", "")], "k string, l string")
    found = rules.apply(df, {"k": "k", "l": "l"})
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r["v"] for r in found.collect()] == [1.0, None, None, 4.0, None]


@pytest.mark.parametrize("tracked", [1000, 2])
def test_audit_in_the_same_pass(spark, monkeypatch, tracked):
    from ticketlake.operators import rules as module

    monkeypatch.setattr(module, "TRACKED", tracked)
    df = spark.createDataFrame([("680元",), ("zz",), (None,), ("zz",), ("y",), ("x",)], "label string").repartition(2)
    price = dims.price_label(spark)
    rows, audit = price.audited(df, {"label": "label"})
    assert sorted(tuple(r) for r in audit.collect()) == sorted(tuple(r) for r in price.audit(df, {"label": "label"}).collect())
    assert rows.columns == ["label", "price"] and rows.count() == 6
    assert rows.filter("price = 680").count() == 1
    if tracked == 1000:
        # The audit comes from metrics: no file and no join in its plan.
        plan = audit._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "Join" not in plan
