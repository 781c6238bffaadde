"""Order sources to the canonical sales table.

Every function takes a raw table with its source's own column names (all text) and returns
``SALES_SCHEMA`` rows.  The functions only describe joins, windows and projections.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.functions.dates import (
    dot_date,
    parse_ts,
    session_from,
    zh_minute,
)
from ticketlake.functions.nulls import is_in, na_last, not_in
from ticketlake.functions.numbers import as_count, as_number, strip_commas
from ticketlake.functions.text import PRINTABLE, capture, split_pair
from ticketlake.operators import position, reshape
from ticketlake.operators.position import ORDER, PART
from ticketlake.operators.rules import RuleSet
from ticketlake.schema import conform
from ticketlake.session import written
from ticketlake.sources import readers

Transform = Callable[[DataFrame], DataFrame]

SELF, BULK, PLATFORM, VENUE = "自营", "大客户", "票务网站", "剧场"
DIST_SYSTEM, DIST_REPORTED = dims.DISTRIBUTOR_TYPES

# Cells and labels of the block report.
BLOCK_TIERS = ["1280", "1080", "880", "680", "480", "280", "180"]
BLOCK_LAYOUT = dict(
    zip(["policy", "kind", *BLOCK_TIERS, "scene", "channel"], [3, 6, 7, 9, 11, 14, 17, 19, 20, 18, 4])
)
BLOCK_LAYOUT_OLD = dict(
    zip(["policy", "kind", *BLOCK_TIERS, "scene", "channel"], [3, 5, 6, 7, 8, 10, 13, 15, 16, 14, 4])
)
BLOCK_OLD_FILES = r"01-26\.[a-z]+$"
BLOCK_FILE_DATE = r"场次明细报表(\d{2}-\d{2})"
KIND_COUNT, KIND_AMOUNT = "数量", "金额"
TOTAL, SUBTOTAL, NO_CHANNEL = "合计", "小计", "无"

_REGISTRY: dict[str, Transform] = {}


def register_channel(name: str, transform: Transform) -> None:
    """Make a source available to :func:`run_channels` under a key."""
    _REGISTRY[name] = transform


def run_channels(raw: dict[str, DataFrame]) -> DataFrame:
    """All registered sources that are present, as one table."""
    parts = [conform(_REGISTRY[key](df)) for key, df in raw.items()]
    return union_all(parts)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union by name; a column that a part lacks is NULL there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def once(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with some columns worked out once a row.

    Without it a filter on them moves below everything that makes them, where each mention of a text
    reads it again, and the rows that pass are read once more.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names)))).select([F.col(f"`{c}`") for c in df.columns])


def load_wide(parts: list[DataFrame], production: str) -> DataFrame:
    """Final wide table in order of the orders: typed, with a production, a session and at least one ticket."""
    wide = union_all([once(conform(p), "session_ts", "tickets") for p in parts])
    rows = wide.withColumn("production", F.coalesce("production", F.lit(production))).filter(
        F.col("session_ts").isNotNull() & (F.col("tickets") > 0)
    )
    return rows.orderBy(*na_last("order_ts"))


def lits(**values) -> dict[str, Column]:
    return {k: F.lit(v) for k, v in values.items()}


# ------------------------------------------------------------------------------- block report
def parse_block_report(
    grid: DataFrame, show: str, venue: str, chunk_rows: int = position.CHUNK_ROWS
) -> DataFrame:
    """Block report grid to ``(src_file, channel, policy, session, tier, count, amount)`` rows.

    A block is one session and channel.  It ends one row after its total marker, and the n-th
    session and channel labels of a file belong to its n-th block.
    """
    cells = readers.by_layout(grid, [(BLOCK_OLD_FILES, BLOCK_LAYOUT_OLD)], BLOCK_LAYOUT)
    scene = F.col("scene").isNotNull() & (F.col("scene") != show)

    # The channel label stands two rows under the session label; a blank one means no channel.
    labels = position.shift(
        cells.withColumn("_scene", F.coalesce(scene, F.lit(False))), {"_scene": "_under"}, -2, chunk_rows=chunk_rows
    ).withColumn(
        "channel",
        F.when(F.col("_under") & F.col("channel").isNull(), NO_CHANNEL).otherwise(F.col("channel")),
    )
    is_body = F.col("kind").isNotNull() & F.col("1280").isNotNull()
    policy = F.when((F.col("kind") == KIND_COUNT) & F.col("policy").isNull(), TOTAL).otherwise(F.col("policy"))
    ended = F.when(is_body, F.coalesce(policy == TOTAL, F.lit(False)).cast("long"))
    is_channel = F.col("channel").isNotNull() & ~F.col("channel").isin(show, venue)
    marked = labels.withColumns({"_body": is_body, "_channel": F.coalesce(is_channel, F.lit(False)), "_end": ended})
    # One pass: the policy of each body row, how many sessions and channels there were, and the ends
    # of blocks above the previous body row.
    scanned = position.scan(
        marked,
        fills={"policy": F.when(is_body, policy)},
        above={"_last_end": F.col("_end")},
        sums={
            "_sessions": F.col("_scene").cast("long"),
            "_channels": F.col("_channel").cast("long"),
            "_ends": F.coalesce("_end", F.lit(0)),
        },
        chunk_rows=chunk_rows,
    ).filter(F.col("_body") | F.col("_scene") | F.col("_channel"))
    # Three readers: written once, so that the reports are not parsed again for each.
    scanned = written(scanned, "block-rows")
    body = scanned.filter("_body").withColumn(
        "block", F.col("_ends") - F.col("_end") - F.coalesce("_last_end", F.lit(0)) + 1
    )
    sessions = scanned.filter("_scene").select(
        PART, F.col("_sessions").alias("block"), zh_minute("scene").alias("session_ts")
    )
    channels = scanned.filter("_channel").select(PART, F.col("_channels").alias("block"), "channel")
    body = body.drop("scene", "channel")

    tagged = (
        body.join(sessions, [PART, "block"], "left")
        .join(channels, [PART, "block"], "left")
        .filter(not_in("policy", [SUBTOTAL, TOTAL]))
        .withColumns({t: strip_commas(t) for t in BLOCK_TIERS})
    )
    # A channel and session may have several blocks, each with its own cells.
    ids = [PART, "block", "channel", "policy", "session_ts"]
    long = reshape.to_long(tagged, [*ids, "kind"], BLOCK_TIERS, "tier", "amount")
    wide = reshape.to_wide(
        long,
        [*ids, "tier"],
        "kind",
        [KIND_COUNT, KIND_AMOUNT],
        {"value": F.sum("amount")},
    )
    return (
        wide.withColumnsRenamed({KIND_COUNT: "count", KIND_AMOUNT: "amount"})
        .drop("block")
        .filter("count <> 0 or amount <> 0")
    )


def block_report(
    grid: DataFrame,
    project: str,
    venue: str,
    show: str,
    exclude: list[str],
    production: str = "MA",
    chunk_rows: int = position.CHUNK_ROWS,
) -> DataFrame:
    """Venue block reports to sales, without the venue's own and the producer's channels."""
    rows = parse_block_report(grid, show, venue, chunk_rows).filter(not_in("channel", exclude))
    rows = dims.venue_channel(grid.sparkSession).apply(
        rows, {"label": "channel"}, into={"channel": "channel_type"}
    )
    return conform(
        rows.withColumns(
            {
                **lits(production=production, project=project, venue=venue),
                "order_ts": readers.file_date(BLOCK_FILE_DATE),
                "channel_detail": F.col("policy"),
                "face_price": as_number("tier"),
                "net_revenue": F.col("amount"),
                "tickets": F.col("count"),
            }
        )
    )


# --------------------------------------------------------------------------- platform sources
# Columns, cells and session text of the report with a preamble.
PREAMBLE_COLUMNS = [
    "票单号码", "大麦订单号", "B端订单号", "票品名称", "票品金额", "实收金额", "优惠金额", "优惠政策",
    "看台", "楼层", "排号", "座号", "购票人", "操作人", "售出时间", "备注",
]
PREAMBLE_CELLS = {"项目名称": (0, 2), "场次名称": (1, 2), "演出场馆": (2, 2)}
PREAMBLE_SKIP = 5
SESSION_CLOCK = r"(\d{4}-\d{2}-\d{2}).*?(\d{2}):(\d{2})"


def parse_preamble_report(grid: DataFrame, files: int | None = None) -> DataFrame:
    """Report whose first rows describe the file; only rows with a ticket number are data."""
    rows = readers.preamble(grid, PREAMBLE_CELLS, PREAMBLE_SKIP, files)
    cells = readers.grid_columns(grid)[1 : len(PREAMBLE_COLUMNS) + 1]
    named = rows.select(
        PART,
        ORDER,
        *[F.col(c).alias(n) for c, n in zip(cells, PREAMBLE_COLUMNS)],
        *PREAMBLE_CELLS,
    )
    return named.filter(F.col("票单号码").rlike(r"^\d+$"))


def preamble_report(
    raw: DataFrame, exclude_operators: list[str], detail: str = "北京大麦", production: str = "MA"
) -> DataFrame:
    rows = raw.filter(not_in("操作人", exclude_operators))
    rows = dims.price_label(raw.sparkSession).apply(
        rows, {"label": "票品名称"}, into={"price": "face_price"}
    )
    return conform(
        rows.withColumns(
            {
                **lits(production=production, channel_type="大麦", channel_detail=detail, tickets=1),
                "session_ts": session_from("场次名称", SESSION_CLOCK),
                "order_ts": parse_ts("售出时间"),
                "net_revenue": as_number("实收金额"),
            }
        )
    )


def platform_orders(raw: DataFrame, project_name: str, production: str = "MA") -> DataFrame:
    """Order details of a ticketing platform for one project; revenue is 90 % incl. delivery."""
    return conform(
        raw.filter(F.col("项目名称") == project_name).withColumns(
            {
                **lits(production=production, channel_type=PLATFORM, channel_detail="猫眼"),
                "session_ts": parse_ts("演出时间"),
                "order_ts": parse_ts("下单时间"),
                "face_price": as_number("票面价"),
                "net_revenue": (as_number("总售价") + as_number("配送费")) * 0.9,
                "tickets": as_count("票张数"),
                "recipient_name": F.col("收件人"),
                "recipient_phone": F.col("收件人电话"),
                "address": F.col("收件人地址"),
            }
        )
    )


def tour_platform_orders(raw: DataFrame, city_production: RuleSet) -> DataFrame:
    """Platform orders of all cities in one pass; a city without a production is left out."""
    rows = city_production.apply(raw, {"label": "演出城市"}, into={"value": "production"})
    return conform(
        rows.filter(F.col("production").isNotNull()).withColumns(
            {
                **lits(channel_type=PLATFORM, channel_detail="猫眼"),
                "venue": F.col("演出场馆"),
                "session_ts": parse_ts("演出时间"),
                "order_ts": parse_ts("下单时间"),
                "face_price": as_number("票面价"),
                "net_revenue": as_number("现金支付"),
                "tickets": as_count("票张数"),
                "recipient_name": F.col("收件人"),
                "recipient_phone": F.col("收件人电话"),
                "address": F.col("收件人地址"),
            }
        )
    )


def merged_cell_orders(
    raw: DataFrame,
    channels: RuleSet,
    sessions: RuleSet | None = None,
    production: str = "MA",
    chunk_rows: int = position.CHUNK_ROWS,
) -> DataFrame:
    """Orders in which a blank cell repeats the cell above (within its file)."""
    spark = raw.sparkSession
    sessions = sessions or dims.labelled_sessions(spark, "live_session", dims.LIVE_SESSIONS)
    cols = readers.grid_columns(raw)
    rows = position.locf(raw, cols, chunk_rows=chunk_rows)
    rows = sessions.apply(rows, {"label": "场次"}, into={"session": "session_ts"})
    rows = channels.apply(rows, {"label": "项目"}, into={"value": "channel_detail"})
    return conform(
        rows.withColumns(
            {
                **lits(production=production, channel_type=DIST_REPORTED, tickets=1),
                "order_ts": parse_ts("支付时间"),
                "face_price": as_number("票价"),
                "net_revenue": as_number("票价") * 0.9,
                "recipient_name": F.col("收件人"),
                "recipient_phone": F.col("收件人手机号"),
                "address": F.col("收件人地址"),
            }
        )
    )


# ------------------------------------------------------------------------ reported distributors
# Session texts of two distributors.
SHOW_SESSION = r"(\d{4}-\d{2}-\d{2}).{4}(\d{2}:\d{2})"
PICKUP_SESSION = r"([0-9 -:]+[0-9])"


def show_orders(channel: str, rate: float = 0.94) -> Transform:
    """Factory for distributors that report session, price and count."""

    def transform(raw: DataFrame) -> DataFrame:
        price, count = as_number("票品"), as_number("数量")
        return conform(
            raw.withColumns(
                {
                    **lits(channel_type=DIST_REPORTED, channel_detail=channel),
                    "session_ts": session_from("场次", SHOW_SESSION),
                    "face_price": price,
                    "tickets": as_count("数量"),
                    "net_revenue": price * count * rate,
                }
            )
        )

    return transform


def pickup_orders(raw: DataFrame, channel: str = "麦淘") -> DataFrame:
    """Session text ``MM-DD HH:mm``; months after January belong to the first season year."""
    spark = raw.sparkSession
    # Text parts that are read several times become columns, so each pattern is matched once.
    dated = raw.withColumn("_text", capture("场次名称", PICKUP_SESSION))
    year = F.when(F.substring("_text", 1, 2) > "01", "2023-").otherwise("2024-")
    dated = dated.withColumn("_text", F.concat(year, F.col("_text")))
    rows = dims.price_label(spark).apply(dated, {"label": "套餐名称"}, into={"price": "face_price"})
    rows = dims.package_label(spark).apply(rows, {"label": "售卖数量"}, into={"packs": "tickets"})
    return conform(
        rows.withColumns(
            {
                **lits(channel_type=DIST_REPORTED, channel_detail=channel),
                "session_ts": parse_ts("_text"),
                "order_ts": parse_ts("付款时间"),
                "net_revenue": as_number("底价"),
                "recipient_name": F.col("订单联系人"),
                "recipient_phone": F.col("手机"),
            }
        )
    )


def spec_orders(raw: DataFrame, channel: str = "大小爱玩") -> DataFrame:
    """Goods spec ``<session label>-<package label>``."""
    spark = raw.sparkSession
    session, package = split_pair("商品规格")
    rows = raw.filter(F.col("商品规格").isNotNull()).withColumns(
        {"_session": session, "_package": package}
    )
    rows = dims.session_label(spark).apply(
        rows, {"label": "_session"}, into={"session": "session_ts"}
    )
    rows = dims.price_label(spark).apply(rows, {"label": "_package"}, into={"price": "face_price"})
    rows = dims.package_label(spark).apply(rows, {"label": "_package"}, into={"packs": "_packs"})
    return conform(
        rows.withColumns(
            {
                **lits(channel_type=DIST_REPORTED, channel_detail=channel),
                "order_ts": parse_ts("买家付款时间"),
                "tickets": as_count("商品数量") * F.col("_packs"),
                "net_revenue": as_number("商品金额小计") * 0.9,
                "recipient_name": F.col("收货人/提货人"),
                "recipient_phone": F.col("收货人手机号/提货人手机号"),
                "address": F.col("详细收货地址/提货地址"),
            }
        )
    )


def dotted_orders(
    raw: DataFrame, channel: str, year: int = 2023, chunk_rows: int = position.CHUNK_ROWS
) -> DataFrame:
    """Sheet with merged cells and sale days ``M.D``."""
    spark = raw.sparkSession
    rows = position.locf(raw, readers.grid_columns(raw), chunk_rows=chunk_rows).filter(
        F.col("售卖日期").isNotNull()
    )
    rows = dims.price_label(spark).apply(rows, {"label": "Price 1"}, into={"price": "face_price"})
    rows = dims.package_label(spark).apply(rows, {"label": "Price 1"}, into={"packs": "_packs"})
    return conform(
        rows.withColumns(
            {
                **lits(channel_type=DIST_REPORTED, channel_detail=channel),
                "session_ts": parse_ts("Session 1"),
                "order_ts": dot_date("售卖日期", year),
                "tickets": as_count("Quantity 1") * F.col("_packs"),
                "net_revenue": as_number("price") * 0.9,
                "recipient_name": F.col("Receiver"),
                "recipient_phone": F.col("Phone"),
                "address": F.col("Full address"),
            }
        )
    )


def worded_orders(raw: DataFrame, channel: str = "父母邦-北京") -> DataFrame:
    """Goods text ``票种：<price>档<wording>，使用时间：<session>``."""
    pattern = "票种：(\\d+)档(.*?)，使用时间：(.*)"
    rows = dims.single_wording(raw.sparkSession).apply(
        raw.withColumns(
            {f"_{n}": capture("商品说明", pattern, i) for i, n in ((1, "price"), (2, "wording"), (3, "session"))}
        ),
        {"label": "_wording"},
        into={"packs": "_packs"},
    )
    return conform(
        rows.withColumns(
            {
                **lits(channel_type=DIST_REPORTED, channel_detail=channel),
                "session_ts": parse_ts("_session"),
                "face_price": as_number("_price"),
                "tickets": F.col("_packs") * as_count("数量"),
                "net_revenue": as_number("结算价小计"),
                "recipient_name": F.col("用户姓名"),
            }
        )
    )


def standard_orders(raw: DataFrame, config: RuleSet | None = None) -> DataFrame:
    """All sheets with the common layout in one plan; ``source_key`` names the sheet.

    A shared session label comes before a channel's own one.
    """
    spark = raw.sparkSession
    config = config or dims.channel_config(spark)
    rows = config.apply(raw, {"source_key": "source_key"}, into={"channel": "channel_detail", "rate": "_rate"})
    rows = dims.session_label(spark).apply(rows, {"label": "场次"}, into={"session": "_shared"})
    rows = dims.channel_session(spark).apply(
        rows, {"source_key": "source_key", "label": "场次"}, into={"session": "_own"}
    )
    return conform(
        rows.withColumns(
            {
                "channel_type": F.lit(DIST_REPORTED),
                "session_ts": F.coalesce("_shared", "_own"),
                "order_ts": parse_ts("售卖时间"),
                "face_price": as_number("票档"),
                "tickets": as_count("张数"),
                "net_revenue": as_number("总金额") * F.col("_rate"),
                "recipient_name": F.col("姓名"),
                "recipient_phone": F.col("手机号"),
            }
        )
    )


# ------------------------------------------------------------------------------- venue reports
# Grades of the wide venue report; tiers and patterns of the report by sections.
GRADES = ["A级", "B级", "C级", "D级"]
GRADE_ATTRS = {"票价": "face_price", "已售数量": "tickets", "已售金额": "net_revenue"}
SECTION = f"^场次时间：({PRINTABLE}*)"
SECTION_TIERS = ["280元(280.00)", "480元(480.00)", "680元(680.00)", "880元(880.00)"]
PRICE_IN_PARENS = f"[0-9]*[(]({PRINTABLE}*)[)]"


def graded_report(raw: DataFrame, venue: str, production: str, file_pattern: str) -> DataFrame:
    """Wide venue report with one group of columns per seat grade."""
    rows = reshape.graded_wide(raw, [PART, "演出时间"], GRADES, GRADE_ATTRS)
    return conform(
        rows.withColumns({c: as_number(c) for c in GRADE_ATTRS.values()})
        .filter("tickets <> 0 or net_revenue <> 0")
        .withColumns(
            {
                **lits(production=production, venue=venue, channel_type=VENUE, channel_detail=VENUE),
                "session_ts": parse_ts("演出时间"),
                "order_ts": readers.file_date(file_pattern, 2024),
            }
        )
    )


def section_rows(
    grid: DataFrame,
    columns: dict[str, int],
    tiers: list[str] = SECTION_TIERS,
    chunk_rows: int = position.CHUNK_ROWS,
) -> DataFrame:
    """Tier rows under ``场次时间：`` headers; ``columns`` must name ``label`` and ``sold``."""
    cells = readers.pick(grid, columns)
    return tier_rows(cells, tiers, chunk_rows)


def tier_rows(
    cells: DataFrame, tiers: list[str], chunk_rows: int = position.CHUNK_ROWS
) -> DataFrame:
    rows = position.section_header(
        cells, capture("label", SECTION), "session", is_in("label", tiers), chunk_rows=chunk_rows
    )
    return rows.filter(F.col("sold").isNotNull()).withColumns(
        {
            "face_price": as_number(capture("label", PRICE_IN_PARENS)),
            "session_ts": parse_ts("session"),
            "sold": as_number("sold"),
        }
    )


def section_report(
    grid: DataFrame,
    venue: str,
    production: str,
    file_pattern: str,
    chunk_rows: int = position.CHUNK_ROWS,
) -> DataFrame:
    rows = section_rows(grid, {"label": 1, "sold": 6, "left": 15, "income": 22}, chunk_rows=chunk_rows)
    return conform(
        rows.withColumns(
            {
                **lits(production=production, venue=venue, channel_type=VENUE, channel_detail=VENUE),
                "order_ts": readers.file_date(file_pattern, 2024),
                "tickets": F.col("sold"),
                "net_revenue": as_number("income"),
            }
        )
    )


# Tiers of the summary report in the order of its columns, and the first tier's sold column; a
# tier takes two columns, and it is on sale once the header has a column after its sold count.
SUMMARY_TIERS = [680.0, 880.0]
SUMMARY_SOLD, SUMMARY_STEP = 5, 2
SUMMARY_HEADER, SUMMARY_FIRST = 1, 2
#: The price that stands in a header cell such as ``1080元``.
SUMMARY_PRICE = r"(\d+)\s*元"


def summary_rows(
    grid: DataFrame, complete: bool = True, files: int | None = None, tiers: list[float] = SUMMARY_TIERS
) -> DataFrame:
    """Summary report to one row per session and tier; rows without a session are no sessions.

    How many tiers a report has follows from its header: the first one always, each further one if its
    columns are there.  A tier's price is that of its header cell, else the listed one; a tier with
    neither fails the job rather than being left out.  With ``complete`` a row with any empty cell is
    left out.
    """
    names = readers.grid_columns(grid)
    cells = F.array(*[F.col(c) for c in names])
    filled = F.array_max(
        F.transform(cells, lambda c, i: F.when(c.isNotNull(), i + 1).otherwise(F.lit(0)))
    )
    sold_at = range(SUMMARY_SOLD, len(names) + 1, SUMMARY_STEP)
    prices = F.array(*[as_number(F.nullif(F.regexp_extract(names[i - 1], SUMMARY_PRICE, 1), F.lit(""))) for i in sold_at])
    header = F.struct(filled.alias("width"), prices.alias("prices"))
    if files is None:
        # The header reaches the rows through the chunk summary of their file.
        at_header = F.when(F.col(ORDER) == SUMMARY_HEADER, header)
        rows = position.scan(grid, greatest={"_header": at_header}).filter(F.col(ORDER) >= SUMMARY_FIRST)
        rows = rows.filter(F.col("_header").isNotNull())
    else:
        heads = grid.filter(F.col(ORDER) == SUMMARY_HEADER).select(PART, header.alias("_header"))
        rows = readers.attach_to_source(readers.rows_between(grid, SUMMARY_FIRST), heads, files).filter(F.col("_header").isNotNull())
    width = F.col("_header.width")
    if complete:
        rows = rows.filter(F.forall(F.slice(cells, F.lit(1), width), lambda c: c.isNotNull()))
    found = []
    for k, i in enumerate(sold_at):
        listed = F.lit(tiers[k]).cast("double") if k < len(tiers) else F.raise_error(
            F.concat(F.lit(f"no price for tier {k + 1} of "), PART)
        ).cast("double")
        price = F.coalesce(F.get("_header.prices", F.lit(k)), listed)
        on_sale = F.lit(True) if k == 0 else width > i
        tier = F.struct(price.alias("price"), as_number(names[i - 1]).alias("sold"))
        found.append(F.when(on_sale, tier))
    return rows.select(
        PART,
        zh_minute(names[1]).alias("session_ts"),
        F.inline(F.filter(F.array(*found), lambda t: t.isNotNull())),
    ).filter(F.col("session_ts").isNotNull())


def summary_report(grid: DataFrame, venue: str, production: str, file_pattern: str) -> DataFrame:
    """Venue summary report: revenue is price times sold count."""
    return conform(
        summary_rows(grid).withColumns(
            {
                **lits(production=production, venue=venue, channel_type=VENUE, channel_detail=VENUE),
                "order_ts": readers.file_date(file_pattern, 2024),
                "face_price": F.col("price"),
                "tickets": F.col("sold"),
                "net_revenue": F.col("price") * F.col("sold"),
            }
        )
    )


# ----------------------------------------------------------------------------------- bulk orders
# Fixed value: state of an approval that no longer counts.
WITHDRAWN = "已撤销"


def bulk_session(df: DataFrame, label: str, production: str) -> DataFrame:
    """Slot label to ``session_ts``; a production's own slot time comes first."""
    spark = df.sparkSession
    df = dims.bulk_slot(spark).apply(df, {"label": label}, into={"session": "_general"})
    df = dims.bulk_slot_override(spark).apply(
        df, {"production": production, "label": label}, into={"session": "_own"}
    )
    return df.withColumn("session_ts", F.coalesce("_own", "_general")).drop("_own", "_general")


def bulk_orders(raw: DataFrame) -> DataFrame:
    """Approved bulk orders."""
    spark = raw.sparkSession
    rows = raw.filter((F.col("审批状态") != WITHDRAWN) & F.col("特殊处理").isNull())
    rows = dims.bulk_production(spark).apply(rows, {"label": "剧目及城市"}, into={"value": "production"})
    rows = bulk_session(
        rows.withColumn("_slot", F.concat_ws(" ", "场次日期", "开演时间")), "_slot", "production"
    )
    rows = dims.session_calendar(spark).apply(
        rows, {"production": "production", "session_ts": "session_ts"},
        into={"project": "project", "venue": "_venue"},
    )
    return conform(
        rows.withColumns(
            {
                "channel_type": F.lit(BULK),
                "channel_detail": F.concat(F.lit("大客户团单-"), F.coalesce("客户名称", F.lit("NA"))),
                "order_ts": parse_ts("发起时间"),
                "face_price": as_number("价位(张)"),
                "tickets": as_count("张数(张)"),
                "net_revenue": as_number("实收"),
            }
        )
    )


def bulk_inline(df: DataFrame) -> DataFrame:
    """Hand-entered bulk orders with the seven columns of the entry form."""
    return conform(
        df.select(
            F.col("剧目").alias("production"),
            parse_ts("场次").alias("session_ts"),
            parse_ts("下单时间").alias("order_ts"),
            F.lit(BULK).alias("channel_type"),
            F.col("渠道明细").alias("channel_detail"),
            as_number("票价").alias("face_price"),
            as_number("实收").alias("net_revenue"),
            as_number("张数").alias("tickets"),
        )
    )
