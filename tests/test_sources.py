"""Readers on real files, and channel pipelines from those files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.nulls import not_in
from ticketlake.operators import position
from ticketlake.plans import channels as ch
from ticketlake.plans import inventory
from ticketlake.plans import sales as sales_plan
from ticketlake.plans import weekly
from ticketlake.schema import conform
from ticketlake.sources import ingest, readers

D = dt.datetime


def put(folder, name, lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def grid_lines(rows, width):
    """Rows given as {column: text} to CSV lines."""
    return [",".join(str(r.get(i, "")) for i in range(1, width + 1)) for r in rows]


def test_line_positions_across_splits(spark, tmp_path):
    big = put(tmp_path, "大 文件.txt", [f"x {i}" for i in range(30_000)])
    put(tmp_path, "b.txt", [f"y {i}" for i in range(10)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = readers.read_lines(spark, str(tmp_path), "*.txt")
        assert lines.count() == 30_010
        assert lines.filter(F.element_at(F.split("line", " "), 2).cast("long") != F.col("row_idx")).count() == 0
        assert lines.select("src_file").distinct().filter(F.col("src_file").endswith(big.split("/")[-1])).count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_folder_with_file_names(spark, tmp_path):
    put(tmp_path, "user-1.csv", ["a,b", "1,x", "2,y"])
    put(tmp_path, "article.csv", ["a,b", "3,z"])
    df = readers.read_folder(spark, str(tmp_path), ["a", "b"])
    user, rest = readers.split_by_name(df, "user")
    assert (user.count(), rest.count()) == (2, 1)
    assert dict(df.dtypes)["a"] == "string"


def test_accounts_from_many_files(spark, tmp_path):
    a = [put(tmp_path, f"a{i}.csv", ["t,n", f"x,{i}"]) for i in range(3)]
    b = put(tmp_path, "b.csv", ["t,n", "y,9"])
    df = readers.read_accounts(spark, {"订阅号": a, "服务号": b}, ["t", "n"])
    assert dict(df.groupBy("account").count().collect()) == {"订阅号": 3, "服务号": 1}


def test_wrong_header_fails(spark, tmp_path):
    put(tmp_path, "x.csv", ["a,c", "1,x"])
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(tmp_path), ["a", "b"]).collect()


def test_sheets(spark, tmp_path):
    put(tmp_path, "mt/1.csv", ["a,b", "1,x"])
    put(tmp_path, "staff/1.csv", ["1,x", "2,y"])
    sheets = readers.read_sheets(spark, str(tmp_path), {"mt": ["a", "b"], "staff": ["c1", "c2"]}, ("staff",))
    assert {k: v.count() for k, v in sheets.items()} == {"mt": 1, "staff": 2}


def test_header_promotion_and_check(spark, tmp_path):
    put(tmp_path, "1.csv", ["报表,", "时间,新关注人数", "45259,3"])
    put(tmp_path, "2.csv", ["报表,", "时间,别的", "45260,4"])
    grid = readers.read_grid(spark, str(tmp_path), 2)
    named = readers.promote_header(grid, ["时间", "新关注人数"], 1)
    assert sorted(r["时间"] for r in named.collect()) == ["45259", "45260"]
    assert readers.header_mismatch(grid, ["时间", "新关注人数"], 1).count() == 1


def block_file(tiers_at, scene_at, kind_at):
    def row(**cells):
        return {k if isinstance(k, int) else int(k[1:]): v for k, v in cells.items()}

    t1, t2 = tiers_at[0], tiers_at[3]
    rows = [
        row(**{f"c{scene_at}": "演出", "c4": "剧院"}),
        row(**{f"c{scene_at}": "2024年1月27日 14:30"}),
        {},
        row(c4="柜台销售"),
    ]

    def pair(policy, n1, n2, a1, a2):
        return [
            {3: policy, kind_at: "数量", t1: n1, t2: n2},
            {kind_at: "金额", t1: a1, t2: a2},
        ]

    rows += pair("正价", 2, 0, '"2,560"', 0) + pair("早鸟", 0, 3, 0, "2040") + pair("", 2, 3, "2560", "2040")
    rows += [row(**{f"c{scene_at}": "2024年1月28日 19:30"}), {}, {}]
    rows += pair("正价", 1, 0, 1280, 0) + pair("小计", 1, 0, 1280, 0) + pair("", 1, 0, 1280, 0)
    return rows


@pytest.mark.parametrize("chunk", [2, 100_000])
def test_block_report_from_files(spark, tmp_path, chunk):
    new = block_file([7, 9, 11, 14, 17, 19, 20], 18, 6)
    old = block_file([6, 7, 8, 10, 13, 15, 16], 14, 5)
    # The new layout: kind in column 6, tiers from column 7.
    put(tmp_path, "场次明细报表11-20.csv", grid_lines(new, 20))
    put(tmp_path, "场次明细报表01-26.csv", grid_lines(old, 20))
    grid = readers.read_grid(spark, str(tmp_path), 20)
    done = ch.block_report(grid, "深圳MA", "剧院", "演出", ["剧院"], chunk_rows=max(chunk, 2))
    got = [
        (r["order_ts"], r["session_ts"], r["channel_type"], r["channel_detail"], int(r["face_price"]), r["tickets"], int(r["net_revenue"]))
        for r in done.collect()
    ]
    one = [
        (D(2024, 1, 27, 14, 30), "剧场", "早鸟", 680, 3, 2040),
        (D(2024, 1, 27, 14, 30), "剧场", "正价", 1280, 2, 2560),
        (D(2024, 1, 28, 19, 30), None, "正价", 1280, 1, 1280),
    ]
    want = [(D(2023, 11, 20), *r) for r in one] + [(D(2024, 1, 26), *r) for r in one]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_preamble_report_from_files(spark, tmp_path):
    head = [{1: "项目", 2: "名"}, {2: "2023-12-02 周六 14:30 场"}, {2: "二七剧场"}, {}, {}]
    body = [
        {2: "101", 5: "680元", 7: "612", 15: "op", 16: "2023-11-20 10:00:00"},
        {2: "102", 5: "999元", 7: "100", 15: "", 16: "2023-11-20"},
        {2: "103", 5: "680元", 7: "612", 15: "admin", 16: "2023-11-20"},
        {2: "合计", 7: "1324"},
    ]
    put(tmp_path, "r.csv", grid_lines(head + body, 17))
    raw = ch.parse_preamble_report(readers.read_grid(spark, str(tmp_path), 17))
    got = sorted((int(r["net_revenue"]), r["face_price"] and int(r["face_price"]), r["tickets"], r["session_ts"])
                 for r in ch.preamble_report(raw, ["admin"]).collect())
    assert got == [(100, None, 1, D(2023, 12, 2, 14, 30)), (612, 680, 1, D(2023, 12, 2, 14, 30))]


def test_section_and_inventory_from_files(spark, tmp_path):
    rows = [
        {1: "报表"},
        {1: "场次时间：2024-04-05 19:30"},
        {1: "280元(280.00)", 6: "5", 15: "7", 22: "1400"},
        {1: "480元(480.00)", 15: "1"},
        {1: "合计", 6: "5"},
        {1: "场次时间：2024-04-06 14:30"},
        {1: "880元(880.00)", 6: "2", 15: "3", 22: "1760"},
    ]
    put(tmp_path, "广东艺术剧院03-20.csv", grid_lines(rows, 22))
    grid = readers.read_grid(spark, str(tmp_path), 22)
    done = ch.section_report(grid, "广东艺术剧院", "NTN广州", r"广东艺术剧院(\d{2}-\d{2})")
    got = sorted((r["session_ts"], int(r["face_price"]), r["tickets"], int(r["net_revenue"]), r["order_ts"]) for r in done.collect())
    assert got == [(D(2024, 4, 5, 19, 30), 280, 5, 1400, D(2024, 3, 20)), (D(2024, 4, 6, 14, 30), 880, 2, 1760, D(2024, 3, 20))]
    stock = inventory.section_inventory(grid)
    assert sorted((int(r["tier"]), r["venue_available"], r["venue_sold"]) for r in stock.collect()) == [(280, 7, 5), (880, 3, 2)]


def test_summary_report_width(spark, tmp_path):
    def rows(width, skip_cell=False):
        out = [{1: "标题"}, {i: f"h{i}" for i in range(1, width + 1)}]
        for d in range(22, 26):
            cells = {i: "1" for i in range(1, width + 1)}
            cells |= {2: f"2024年03月{d}日 20:00:00", 5: str(d), 7: str(d + 100)}
            out.append({k: v for k, v in cells.items() if k <= width})
        if skip_cell:
            out[3].pop(3)
        return out

    put(tmp_path, "上音03-01.csv", grid_lines(rows(6), 10))
    put(tmp_path, "上音03-02.csv", grid_lines(rows(8, True), 10))
    done = ch.summary_report(readers.read_grid(spark, str(tmp_path), 10), "上音", "NTN", r"上音(\d{2}-\d{2})")
    got = sorted((r["order_ts"].day, int(r["face_price"]), r["session_ts"].day, r["tickets"], int(r["net_revenue"])) for r in done.collect())
    assert [g for g in got if g[0] == 1] == [(1, 680, d, d, 680 * d) for d in range(22, 26)]
    assert [g for g in got if g[0] == 2] == [(2, 680, d, d, 680 * d) for d in (22, 24, 25)] + [
        (2, 880, d, d + 100, 880 * (d + 100)) for d in (22, 24, 25)
    ]


def test_sheet_inventory_from_files(spark, tmp_path):
    rows = [{1: "t"}, {1: "票档"}] + [{1: f"{p}元", 3: p // 10, 17: p // 20} for p in (880, 680, 480, 280, 180)]
    put(tmp_path, "2024-03-22 周五 20-00/s.csv", grid_lines(rows, 17))
    done = inventory.platform_inventory(readers.read_grid(spark, str(tmp_path) + "/*", 17))
    got = sorted((r["session_ts"], int(r["tier"]), r["channel_sold"]) for r in done.collect())
    assert got == [(D(2024, 3, 22, 20), p, p // 10) for p in (180, 280, 480, 680, 880)]


def test_worded_and_platform_orders(spark):
    raw = spark.createDataFrame(
        [("票种：880档单人票2张，使用时间：2023-12-02 14:30", "2", "1584", "n")], ["商品说明", "数量", "结算价小计", "用户姓名"]
    )
    r = ch.worded_orders(raw).first()
    assert (int(r["face_price"]), r["tickets"], r["session_ts"]) == (880, 4, D(2023, 12, 2, 14, 30))
    cols = ["项目名称", "演出时间", "下单时间", "票面价", "总售价", "配送费", "票张数", "收件人", "收件人电话", "收件人地址"]
    raw = spark.createDataFrame([("p", "2023-12-02 14:30", "2023-11-01 09:00:00", "500", "1000", "20", "2", "n", "1", "a")], cols)
    r = ch.platform_orders(raw, "p").first()
    assert float(r["net_revenue"]) == 918.0 and r["tickets"] == 2


def test_wide_load_drops_bad_rows(spark):
    raw = spark.createDataFrame([("2023-12-02 周六 14:30", "680", "2"), ("bad", "680", "2"), ("2023-12-02 周六 14:30", "680", "0")], ["场次", "票品", "数量"])
    wide = ch.load_wide([ch.show_orders("秀动")(raw)], "MA")
    got = [(r["production"], float(r["net_revenue"])) for r in wide.collect()]
    assert got == [("MA", pytest.approx(1278.4))]


def test_bulk_entry_form(spark):
    raw = spark.createDataFrame([("MOR", "2023-12-03 14:00:00", "2023-11-07 15:46:00", "大客户-x", "280", "3640", "13")],
                                ["剧目", "场次", "下单时间", "渠道明细", "票价", "实收", "张数"])
    r = ch.bulk_inline(raw).first()
    assert (r["channel_type"], r["tickets"], r["session_ts"]) == ("大客户", 13, D(2023, 12, 3, 14))


def test_anti_filter_keeps_unknown_operator(spark):
    df = spark.createDataFrame([(None,), ("admin",)], "op string")
    assert df.filter(not_in("op", ["admin"])).count() == 1


def test_dashboard_from_file(spark, tmp_path):
    def tags(tokens, n):
        return "<i>".join(tokens.get(i, "") for i in range(1, n + 1))

    lines = ["<b>info-text</b>", "x"]
    for k in range(3):
        stats = {}
        for (a, b), (lbl, v) in zip(weekly.GRAPHIC_PAIRS, [("观看量", 100 + k), ("点赞量", 1), ("评论数", 2), ("收藏数", 3), ("分享数", 4)]):
            stats[a], stats[b] = lbl, str(v)
        lines += [tags({1: "info-text", 3: f"t{k}", 5: "发布于 2023-12-19"}, 6), "-", tags(stats, 47)]
    put(tmp_path, "xhs.txt", lines)
    posts = weekly.dashboard_posts(readers.read_lines(spark, str(tmp_path)), "小红书", "a", chunk_rows=3)
    got = sorted((r["views"], r["interactions"], r["shares"], r["published_at"]) for r in posts.collect())
    assert got == [(100.0 + k, 6.0, 4.0, D(2023, 12, 19)) for k in range(3)]


def test_summary_tiers_from_the_header(spark, tmp_path):
    def sheet(name, heads, *rows):
        put(tmp_path, name, ["title", *grid_lines([heads], 12), *grid_lines(rows, 12)])

    day = "2024年03月22日 20:00:00"
    full = {i: "v" for i in range(1, 11)}
    sheet("one.csv", {i: "h" for i in range(1, 7)}, {**full, 2: day, 5: 7})
    sheet("two.csv", {i: "h" for i in range(1, 9)}, {**full, 2: day, 5: 7, 7: 8})
    sheet("three.csv", {**{i: "h" for i in range(1, 11)}, 9: "1080元 已售"}, {**full, 2: day, 5: 7, 7: 8, 9: 9})
    grid = readers.read_grid(spark, str(tmp_path), 12)
    for files in (None, 3):
        found = ch.summary_rows(grid, files=files)
        got = sorted((r["src_file"].split("/")[-1], r["price"], r["sold"]) for r in found.collect())
        assert got == [
            ("one.csv", 680.0, 7.0), ("three.csv", 680.0, 7.0), ("three.csv", 880.0, 8.0), ("three.csv", 1080.0, 9.0),
            ("two.csv", 680.0, 7.0), ("two.csv", 880.0, 8.0),
        ]
    # A third tier without a price is not left out without a word.
    sheet("four.csv", {i: "h" for i in range(1, 11)}, {**full, 2: day, 5: 7, 7: 8, 9: 9})
    with pytest.raises(Exception, match="no price for tier 3 of"):
        ch.summary_rows(readers.read_grid(spark, str(tmp_path), 12)).collect()


def test_incremental_batch_reads_a_file_once(spark, tmp_path):
    src, store, manifest = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "manifest")
    put(src, "1.csv", ["a", "1"])
    assert ingest.append_unread(readers.read_folder(spark, str(src), ["a"]), store, manifest).count() == 1
    put(src, "2.csv", ["a", "2", "3"])
    assert ingest.append_unread(readers.read_folder(spark, str(src), ["a"]), store, manifest).count() == 3


def test_runs_at_once_add_each_file_once(spark, tmp_path, monkeypatch):
    from ticketlake.sources import commits

    src, store, manifest = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "manifest")
    put(src, "1.csv", ["a", "1", "2"])
    put(src, "2.csv", ["a", "3"])
    real, others = commits.commit, []

    def late(session, log, number, batch):
        # Another run commits between this run's reading and its own commit: once the same files, then a new one.
        if len(others) < 2:
            others.append(number)
            put(src, f"x{len(others)}.csv", ["a", str(10 * len(others))])
            ingest.append_unread(readers.read_folder(spark, str(src), ["a"]), store, manifest)
        return real(session, log, number, batch)

    monkeypatch.setattr(commits, "commit", late)
    first = readers.read_folder(spark, str(src), ["a"])
    rows = ingest.append_unread(first, store, manifest)
    assert sorted(r["a"] for r in rows.collect()) == ["1", "10", "2", "20", "3"]
    # The first run lost twice; what was left of its batch is empty, yet its entry is in the log.
    assert [r["n"] for r in commits.entries(spark, f"{manifest}/log").orderBy("n").collect()] == [1, 2, 3]
    assert ingest.append_unread(readers.read_folder(spark, str(src), ["a"]), store, manifest).count() == 5


def test_an_entry_has_one_winner(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from ticketlake.sources import commits

    log = str(tmp_path / "一 log")
    for number in range(1, 6):
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda k, n=number: commits.commit(spark, log, n, f"b{k}"), range(8)))
        assert sum(won) == 1
        assert commits.head(spark, log) == number
        named = {r["n"]: r["batch"] for r in commits.entries(spark, log).collect()}
        assert named[number] == f"b{won.index(True)}"


def test_days_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "wide")

    def days(*rows):
        return conform(spark.createDataFrame(list(rows), "day string, net_revenue double").withColumn("order_ts", F.col("day").cast("timestamp_ntz")))

    ingest.write_sales(days(("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-02-01", 3.0)), path)
    for _ in range(2):
        ingest.write_sales(days(("2024-01-02", 5.0), ("2024-01-02", 6.0), ("2024-03-01", 7.0)), path, only_given=True)
    back = spark.read.parquet(path).select(F.col("order_start").cast("string"), F.col("net_revenue").cast("double"))
    assert sorted(map(tuple, back.collect())) == [
        ("2024-01-01", 1.0), ("2024-01-02", 5.0), ("2024-01-02", 6.0), ("2024-02-01", 3.0), ("2024-03-01", 7.0),
    ]
    ingest.write_sales(days(("2024-05-01", 1.0)), path)
    assert spark.read.parquet(path).count() == 1


def test_cached_table(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert ingest.cached(spark, path, build).count() == 3
    assert ingest.cached(spark, path, build).count() == 3
    assert len(built) == 1


def test_union_row_count_and_master(spark):
    a = conform(spark.createDataFrame([("v1",)], "venue string").withColumn("session_ts", F.lit("2024-01-01").cast("timestamp_ntz")))
    b = conform(spark.createDataFrame([("v2",), (None,)], "venue string"))
    assert ch.union_all([a, b]).count() == 3
    master = sales_plan.tour_master([a, b], dims.text_map(spark, "vp", [("v1", "P")]))
    assert [(r["venue"], r["project"]) for r in master.collect()] == [("v1", "P")]


def test_text_columns(spark):
    df = spark.createDataFrame([("f", 0, "x", 1.0)], "src_file string, row_idx long, c1 string, c2 double")
    assert readers.text_columns(df).columns == ["src_file", "row_idx", "c1"]
    assert position.ORDER in df.columns
