"""Order sources, on source-shaped text tables that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake import dims
from ticketlake.functions.nulls import sum0
from ticketlake.operators import position
from ticketlake.operators.position import ORDER, PART
from ticketlake.plans import channels as ch
from ticketlake.plans import sales as sales_plan
from ticketlake.schema import SALES_SCHEMA, conform
from ticketlake.session import shared_dir, written
from ticketlake.sources import ingest, readers

from .base import MONEY, TS, out, pick, pick_sql, q, query, table, values_sql
from .rules import ALL_PACK_LABELS, PACK_SQL, PRICE_SQL, SEEN_LABELS

KEYS = ["channel_type", "channel_detail", "session_ts", "face_price"]
DIGEST_SQL = (
    "count(*) as lines, cast(coalesce(sum(tickets), 0) as bigint) as tickets, "
    f"cast(coalesce(sum(cast(net_revenue as {MONEY})), 0) as double) as revenue"
)


def digest(df: DataFrame, *keys: str) -> DataFrame:
    """Comparable form of a sales table."""
    return out(
        df.groupBy(*(keys or KEYS)).agg(
            F.count(F.lit(1)).alias("lines"),
            sum0("tickets").cast("long").alias("tickets"),
            sum0("net_revenue").alias("revenue"),
        )
    )


def text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def cents(c: str) -> Column:
    """A money column as plain text."""
    return F.col(c).cast("decimal(18,2)").cast("string")


def day_text(c: str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(c, fmt)


def lines(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem")


# -------------------------------------------------------------------------- reported distributors
@query(
    "channel_show_orders",
    f"""with x as (select case when l_linenumber = 7 then null else l_shipdate + interval 1170 minute end
        as session_ts, cast(floor(l_extendedprice) as double) as face_price, cast(l_quantity as integer) as tickets,
        floor(l_extendedprice) * l_quantity * 0.94 as net_revenue from lineitem)
    select '分销-报单' as channel_type, '秀动' as channel_detail, strftime(session_ts, {TS}) as session_ts,
      face_price, {DIGEST_SQL} from x group by x.session_ts, face_price""",
)
def channel_show_orders(spark, sf, rows: bool = False):
    raw = lines(spark, sf).select(
        F.when(F.col("l_linenumber") == 7, "foo")
        .otherwise(F.concat(day_text("l_shipdate"), F.lit(" 周六 19:30")))
        .alias("场次"),
        text(F.floor("l_extendedprice")).alias("票品"),
        text(F.col("l_quantity").cast("int")).alias("数量"),
    )
    done = ch.show_orders("秀动")(raw)
    return done if rows else digest(done)


@query(
    "channel_pickup_orders",
    f"""with x as (select try_cast(case when month(l_shipdate) > 1 then '2023-' else '2024-' end ||
          strftime(l_shipdate, '%m-%d') || ' 14:30:00' as timestamp) as session_ts,
        {pick_sql(SEEN_LABELS, 'l_partkey')} as a, {pick_sql(ALL_PACK_LABELS, 'l_suppkey')} as b,
        l_extendedprice as net_revenue from lineitem)
    select '分销-报单' as channel_type, '麦淘' as channel_detail, strftime(session_ts, {TS}) as session_ts,
      cast(price as double) as face_price, count(*) as lines, cast(coalesce(sum(packs), 0) as bigint) as tickets,
      cast(sum(cast(net_revenue as {MONEY})) as double) as revenue
    from x left join {PRICE_SQL} on a = p.label left join {PACK_SQL} on b = k.label group by x.session_ts, price""",
)
def channel_pickup_orders(spark, sf, rows: bool = False):
    raw = lines(spark, sf).select(
        F.concat(F.lit("【北京】"), day_text("l_shipdate", "MM-dd"), F.lit(" 14:30（周六）")).alias("场次名称"),
        pick(SEEN_LABELS, F.col("l_partkey")).alias("套餐名称"),
        pick(ALL_PACK_LABELS, F.col("l_suppkey")).alias("售卖数量"),
        day_text("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("付款时间"),
        cents("l_extendedprice").alias("底价"),
        F.lit("n").alias("订单联系人"),
        F.lit("p").alias("手机"),
    )
    done = ch.pickup_orders(raw)
    return done if rows else digest(done)


_SPEC_SESSIONS = [x for x, _ in dims.SESSION_LABELS] + ["zz"]


@query(
    "channel_spec_orders",
    f"""with s as (select {pick_sql(_SPEC_SESSIONS, 'l_partkey')} || '-' || {pick_sql(ALL_PACK_LABELS, 'l_suppkey')} as spec,
        cast(l_quantity as integer) as n, cast(l_extendedprice as decimal(12,2)) * 0.9 as net_revenue
        from lineitem where l_returnflag <> 'R'),
    x as (select regexp_extract(spec, '^([^-]*)-(.*)$', 1) as a, regexp_extract(spec, '^([^-]*)-(.*)$', 2) as b, n,
        net_revenue from s),
    d as (select label, arg_min(session, i) as session from (select *, row_number() over () as i from
        {values_sql(dims.SESSION_LABELS, 'v', 'label, session')}) group by 1)
    select '分销-报单' as channel_type, '大小爱玩' as channel_detail, session as session_ts,
      cast(price as double) as face_price, count(*) as lines, cast(coalesce(sum(n * packs), 0) as bigint) as tickets,
      cast(sum(net_revenue) as double) as revenue
    from x left join d on a = d.label left join {PRICE_SQL} on b = p.label left join {PACK_SQL} on b = k.label
    group by session, price""",
)
def channel_spec_orders(spark, sf, rows: bool = False):
    spec = F.concat_ws(
        "-", pick(_SPEC_SESSIONS, F.col("l_partkey")), pick(ALL_PACK_LABELS, F.col("l_suppkey"))
    )
    raw = lines(spark, sf).select(
        F.when(F.col("l_returnflag") != "R", spec).alias("商品规格"),
        text(F.col("l_quantity").cast("int")).alias("商品数量"),
        cents("l_extendedprice").alias("商品金额小计"),
        day_text("l_shipdate").alias("买家付款时间"),
        F.lit("n").alias("收货人/提货人"),
        F.lit("p").alias("收货人手机号/提货人手机号"),
        F.lit("a").alias("详细收货地址/提货地址"),
    )
    done = ch.spec_orders(raw)
    return done if rows else digest(done)


# The events as one report file per month whose blank cells repeat the cell above.
def _sheet(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM").alias(PART), F.col("event_id").alias(ORDER), "ts", "user_id", "value", "event_type"
    )


def _every(n: int, value: Column) -> Column:
    return F.when(F.col(ORDER) % n == 0, value)


def _filled(n: int, value: str) -> str:
    return (
        f"last_value(case when event_id % {n} = 0 then {value} end ignore nulls) "
        "over (partition by strftime(ts, '%Y-%m') order by event_id rows unbounded preceding)"
    )


@query(
    "channel_dotted_orders",
    f"""with s as (select event_id, {_filled(3, "date_trunc('day', ts - interval 1 year)")} as order_ts,
        {_filled(4, "date_trunc('day', ts) + interval 1170 minute")} as session_ts,
        {_filled(2, pick_sql(SEEN_LABELS, 'event_id'))} as label, cast(user_id % 5 + 1 as integer) as n,
        cast(cast(value as decimal(18,2)) * 0.9 as {MONEY}) as net_revenue from events),
    x as (select *, n * packs as tickets, cast(price as double) as face_price
      from s left join {PRICE_SQL} on s.label = p.label left join {PACK_SQL} on s.label = k.label)
    select strftime(order_ts, {TS}) as order_ts, strftime(session_ts, {TS}) as session_ts, face_price, {DIGEST_SQL}
    from x group by x.order_ts, x.session_ts, face_price""",
)
def channel_dotted_orders(spark, sf, detail: str = "247-北京", rows: bool = False):
    raw = _sheet(spark, sf).select(
        PART,
        ORDER,
        _every(3, F.concat_ws(".", F.month("ts"), F.dayofmonth("ts"))).alias("售卖日期"),
        _every(4, F.concat(day_text("ts"), F.lit(" 19:30:00"))).alias("Session 1"),
        _every(2, pick(SEEN_LABELS, F.col(ORDER))).alias("Price 1"),
        text(F.col("user_id") % 5 + 1).alias("Quantity 1"),
        cents("value").alias("price"),
        _every(5, F.lit("n")).alias("Receiver"),
        F.lit("p").alias("Phone"),
        F.lit("a").alias("Full address"),
    )
    done = ch.dotted_orders(raw, detail)
    return done if rows else digest(done, "order_ts", "session_ts", "face_price")


_LIVE = [x for x, _ in dims.LIVE_SESSIONS] + ["2023.1.1 foo"]
_LIVE_CHANNELS = [("北京站【直播间】", "抖音-直播间"), ("北京站", "抖音")]


@query(
    "channel_merged_cell_orders",
    f"""with s as (select event_id, {_filled(3, pick_sql(_LIVE, 'event_id'))} as label,
        {_filled(7, pick_sql(['北京站', '北京站【直播间】', '上海站'], 'event_id'))} as project,
        {_filled(2, "cast(floor(value) as integer)")} as face_price from events),
    x as (select *, 1 as tickets, face_price * 0.9 as net_revenue from s)
    select '分销-报单' as channel_type, case project when '北京站' then '抖音' when '北京站【直播间】' then '抖音-直播间' end
      as channel_detail, session as session_ts, cast(face_price as double) as face_price, {DIGEST_SQL}
    from x left join {values_sql(dims.LIVE_SESSIONS, 'v', 'label, session')} on x.label = v.label
    group by 2, 3, x.face_price""",
)
def channel_merged_cell_orders(spark, sf, rows: bool = False):
    raw = _sheet(spark, sf).select(
        PART,
        ORDER,
        _every(7, pick(["北京站", "北京站【直播间】", "上海站"], F.col(ORDER))).alias("项目"),
        _every(3, pick(_LIVE, F.col(ORDER))).alias("场次"),
        _every(4, day_text("ts", "yyyy-MM-dd HH:mm:ss")).alias("支付时间"),
        _every(2, text(F.floor("value"))).alias("票价"),
        F.lit("n").alias("收件人"),
        F.lit("p").alias("收件人手机号"),
        F.lit("a").alias("收件人地址"),
    )
    channels = dims.text_map(spark, "live_channel", _LIVE_CHANNELS)
    done = ch.merged_cell_orders(raw, channels)
    return done if rows else digest(done)


_WORDS = ["单人票3张", "单人票2张", "单人票", "双人票"]


@query(
    "channel_worded_orders",
    f"""with s as (select {pick_sql(_WORDS, 'l_partkey')} as w, l_shipdate + interval 870 minute as t,
        cast(l_quantity as integer) as n, cast(floor(l_extendedprice) as double) as p,
        l_extendedprice as net_revenue, l_returnflag <> 'R' as good from lineitem),
    x as (select case when good then t end as session_ts, case when good then p end as face_price,
        case when good then n * case w when '单人票3张' then 3 when '单人票2张' then 2 when '单人票' then 1 end end as tickets,
        net_revenue from s)
    select '分销-报单' as channel_type, '父母邦-北京' as channel_detail, strftime(session_ts, {TS}) as session_ts,
      face_price, {DIGEST_SQL} from x group by x.session_ts, face_price""",
)
def channel_worded_orders(spark, sf, rows: bool = False):
    goods = F.concat(
        F.lit("票种："), text(F.floor("l_extendedprice")), F.lit("档"), pick(_WORDS, F.col("l_partkey")),
        F.lit("，使用时间："), day_text("l_shipdate"), F.lit(" 14:30"),
    )
    raw = lines(spark, sf).select(
        F.when(F.col("l_returnflag") != "R", goods).otherwise("无说明").alias("商品说明"),
        text(F.col("l_quantity").cast("int")).alias("数量"),
        cents("l_extendedprice").alias("结算价小计"),
        F.lit("n").alias("用户姓名"),
    )
    done = ch.worded_orders(raw)
    return done if rows else digest(done)


_SHEETS = list(dims.STANDARD_CHANNELS) + ["zz"]
_STD_LABELS = sorted({x for x, _ in dims.SESSION_LABELS} | {x for _, x, _ in dims.CHANNEL_SESSIONS}) + ["foo"]
_RATES = {k: (n, 1.0 if k != "qm" else 0.9) for k, (n, _) in dims.STANDARD_CHANNELS.items()}


@query(
    "channel_standard_orders",
    f"""with s as (select {pick_sql(_SHEETS, 'l_orderkey')} as source_key, {pick_sql(_STD_LABELS, 'l_partkey')} as label,
        cast(floor(l_extendedprice) as double) as face_price, cast(l_quantity as integer) as tickets,
        cast(l_extendedprice as decimal(12,2)) as amount from lineitem),
    x as (select channel as channel_detail, coalesce(a.session, b.session) as session_ts, face_price, tickets,
        amount * cast(rate as decimal(3,2)) as net_revenue
      from s left join {values_sql([(k, n, r) for k, (n, r) in _RATES.items()], 'c', 'source_key, channel, rate')}
        on s.source_key = c.source_key
      left join {values_sql(dims.SESSION_LABELS, 'a', 'label, session')} on s.label = a.label
      left join {values_sql(dims.CHANNEL_SESSIONS, 'b', 'source_key, label, session')}
        on s.source_key = b.source_key and s.label = b.label)
    select '分销-报单' as channel_type, channel_detail, session_ts, face_price, {DIGEST_SQL}
    from x group by channel_detail, session_ts, face_price""",
)
def channel_standard_orders(spark, sf, rows: bool = False):
    raw = lines(spark, sf).select(
        pick(_SHEETS, F.col("l_orderkey")).alias("source_key"),
        pick(_STD_LABELS, F.col("l_partkey")).alias("场次"),
        day_text("l_shipdate").alias("售卖时间"),
        text(F.floor("l_extendedprice")).alias("票档"),
        text(F.col("l_quantity").cast("int")).alias("张数"),
        cents("l_extendedprice").alias("总金额"),
        F.lit("n").alias("姓名"),
        F.lit("p").alias("手机号"),
    )
    done = ch.standard_orders(raw, dims.channel_config(spark, _RATES))
    return done if rows else digest(done)


# ------------------------------------------------------------------------------ platform orders
def _platform_raw(spark, sf) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_mktsegment").alias("项目名称"),
            pick(["北京", "深圳", "上海", "广州"], F.col("c_nationkey")).alias("演出城市"),
            F.col("o_orderpriority").alias("演出场馆"),
            day_text("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("演出时间"),
            day_text("o_orderdate", "yyyy/M/d").alias("下单时间"),
            text(F.col("c_nationkey") * 10).alias("票面价"),
            text(F.col("o_custkey") % 6).alias("票张数"),
            cents("o_totalprice").alias("总售价"),
            text(F.col("o_orderkey") % 25).alias("配送费"),
            cents("o_totalprice").alias("现金支付"),
            F.col("c_name").alias("收件人"),
            text("c_custkey").alias("收件人电话"),
            F.lit(None).cast("string").alias("收件人地址"),
        )
    )


@query(
    "channel_platform_orders",
    f"""with x as (select o_orderdate as session_ts, o_orderdate as order_ts, c_nationkey * 10.0 as face_price,
        cast(o_custkey % 6 as integer) as tickets,
        (cast(o_totalprice as decimal(14,2)) + o_orderkey % 25) * 0.9 as net_revenue
      from orders join customer on o_custkey = c_custkey where c_mktsegment = 'BUILDING')
    select '票务网站' as channel_type, '猫眼' as channel_detail, strftime(session_ts, {TS}) as session_ts,
      strftime(order_ts, {TS}) as order_ts, cast(face_price as double) as face_price, {DIGEST_SQL}
    from x group by x.session_ts, x.order_ts, x.face_price""",
)
def channel_platform_orders(spark, sf, rows: bool = False):
    done = ch.platform_orders(_platform_raw(spark, sf), "BUILDING")
    return done if rows else digest(done, *KEYS, "order_ts")


_CITIES = [("北京", "NTN北京"), ("深圳", "NTN深圳"), ("上海", "NTN上海")]


@query(
    "channel_tour_platform_orders",
    f"""with x as (select {pick_sql(['北京', '深圳', '上海', '广州'], 'c_nationkey')} as city, o_orderpriority as venue,
        o_orderdate as session_ts, cast(o_custkey % 6 as integer) as tickets, o_totalprice as net_revenue
      from orders join customer on o_custkey = c_custkey)
    select 'NTN' || city as production, venue, strftime(session_ts, {TS}) as session_ts, {DIGEST_SQL}
    from x where city <> '广州' group by x.city, x.venue, x.session_ts""",
)
def channel_tour_platform_orders(spark, sf, rows: bool = False):
    cities = dims.text_map(spark, "city", _CITIES)
    done = ch.tour_platform_orders(_platform_raw(spark, sf), cities)
    return done if rows else digest(done, "production", "venue", "session_ts")


# ----------------------------------------------------------------------------- reports with grids
def cell_grid(df: DataFrame, width: int, cells: dict[int, Column]) -> DataFrame:
    """Text grid of a width with some cells filled."""
    return df.select(
        PART,
        ORDER,
        *[
            (cells[i].cast("string") if i in cells else F.lit(None).cast("string")).alias(f"c{i}")
            for i in range(1, width + 1)
        ],
    )


_OPERATORS = ["admin", "o1", "o2"]


def _preamble_grid(spark, sf) -> DataFrame:
    """One file per event day: three descriptive rows, two spare rows, then one row per event."""
    events = _sheet(spark, sf).withColumn(PART, F.concat(F.lit("d/"), day_text("ts")))
    body = position.densify(events).withColumn(ORDER, F.col(ORDER) + 5)
    no = F.when(F.col("event_type") == "error", F.lit("合计")).otherwise(text(F.col(ORDER)))
    rows = cell_grid(
        body,
        17,
        {
            1: F.lit("x"),
            2: no,
            5: pick(SEEN_LABELS, F.col("user_id")),
            7: cents("value"),
            15: F.when(F.col("user_id") % 4 < 3, pick(_OPERATORS, F.col("user_id"))),
            16: day_text("ts", "yyyy-MM-dd HH:mm:ss"),
        },
    )
    files = table(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct()
    heads = files.select(
        F.concat(F.lit("d/"), F.date_format("day", "yyyy-MM-dd")).alias(PART),
        F.posexplode(
            F.array(
                F.lit("项目"),
                F.concat(F.lit("【场】"), F.date_format("day", "yyyy-MM-dd"), F.lit(" 周五 19:30 开演")),
                F.lit("二七剧场"),
            )
        ).alias(ORDER, "head"),
    ).withColumn(ORDER, F.col(ORDER).cast("long"))
    return cell_grid(heads, 17, {2: F.col("head")}).unionByName(rows)


@query(
    "channel_preamble_report",
    f"""with x as (select {pick_sql(SEEN_LABELS, 'user_id')} as label, date_trunc('day', ts) + interval 1170 minute as session_ts,
        1 as tickets, value as net_revenue,
        case when user_id % 4 < 3 then {pick_sql(_OPERATORS, 'user_id')} end as op from events where event_type <> 'error')
    select '大麦' as channel_type, '北京大麦' as channel_detail, strftime(session_ts, {TS}) as session_ts,
      cast(price as double) as face_price, {DIGEST_SQL}
    from x left join {PRICE_SQL} on x.label = p.label where op is null or op not in ('admin', 'o1')
    group by x.session_ts, price""",
)
def channel_preamble_report(spark, sf, rows: bool = False):
    raw = ch.parse_preamble_report(_preamble_grid(spark, sf))
    done = ch.preamble_report(raw, ["admin", "o1"])
    return done if rows else digest(done)


# Block reports: one file per month and day of shipping, one block per line number (session and
# channel), one pair of rows per return flag (policy), one column per tier (size class).
_BLOCK_ROWS = 12
_POLICIES = ["A", "N", "R"]
_BLOCK_CHANNELS = ["柜台销售", "猫眼（T3渠道）", "大麦（T3渠道）", "自有", None, "市场部票务", "外部"]


def _tier_sums(kind: str, value: Column) -> list[Column]:
    cls = F.pmod(F.col("l_partkey"), F.lit(len(ch.BLOCK_TIERS)))
    return [F.coalesce(F.sum(F.when(cls == i, value)), F.lit(0)).alias(f"{kind}{i}") for i in range(7)]


def _block_grid(spark, sf) -> DataFrame:
    sums = (
        lines(spark, sf)
        .groupBy(
            F.date_format("l_shipdate", "MM-dd").alias("day"),
            F.col("l_linenumber").alias("block"),
            F.col("l_returnflag").alias("policy"),
        )
        .agg(
            *_tier_sums("n", F.col("l_quantity").cast("int")),
            *_tier_sums("a", F.col("l_extendedprice").cast("decimal(18,2)")),
        )
    )
    # A block only has the policies that sold, so the rows of a file are numbered afterwards.
    at = F.col("block") * 100 + F.ascii("policy") * 2 - 120
    pair = F.explode(F.array(F.lit(0), F.lit(1)))
    body = sums.withColumn("k", pair).select(
        "day", "block", (at + F.col("k")).alias("pos"),
        F.when(F.col("k") == 0, F.col("policy")).alias("policy"),
        F.when(F.col("k") == 0, ch.KIND_COUNT).otherwise(ch.KIND_AMOUNT).alias("kind"),
        *[
            F.when(F.col("k") == 0, F.format_number(f"n{i}", 0)).otherwise(F.format_number(f"a{i}", 2)).alias(t)
            for i, t in enumerate(ch.BLOCK_TIERS)
        ],
    )
    blocks = sums.select("day", "block").distinct()
    # Session row, channel row two below it, and the total pair at the end.
    extra = blocks.withColumn("k", F.explode(F.array(*[F.lit(i) for i in (0, 1, 2, 98, 99)]))).select(
        "day", "block", (F.col("block") * 100 + F.col("k")).alias("pos"),
        F.lit(None).cast("string").alias("policy"),
        F.when(F.col("k") == 98, ch.KIND_COUNT).when(F.col("k") == 99, ch.KIND_AMOUNT).alias("kind"),
        *[F.when(F.col("k") >= 98, "1").alias(t) for t in ch.BLOCK_TIERS],
        F.when(
            F.col("k") == 0, F.concat(F.lit("2024年"), (F.col("block") + 1).cast("string"), F.lit("月9日 19:30"))
        ).alias("scene"),
        F.when(F.col("k") == 2, pick([c or "" for c in _BLOCK_CHANNELS], F.col("block") - 1)).alias("channel"),
    )
    title = sums.select("day").distinct().select(
        "day", F.lit(0).alias("block"), F.lit(0).alias("pos"), F.lit("演出").alias("scene"), F.lit("剧院").alias("channel")
    )
    rows = body.unionByName(extra, allowMissingColumns=True).unionByName(title, allowMissingColumns=True)
    rows = rows.withColumn("channel", F.nullif("channel", F.lit("")))
    named = rows.withColumns(
        {
            PART: F.concat(F.lit("in/场次明细报表"), F.col("day"), F.lit(".xlsx")),
            ORDER: F.col("pos").cast("long"),
        }
    )
    dense = position.densify(named)
    old = F.col(PART).rlike(ch.BLOCK_OLD_FILES)
    cells = {}
    for i in range(1, 21):
        new_name = next((k for k, v in ch.BLOCK_LAYOUT.items() if v == i), None)
        old_name = next((k for k, v in ch.BLOCK_LAYOUT_OLD.items() if v == i), None)
        null = F.lit(None).cast("string")
        cells[i] = F.when(old, F.col(old_name) if old_name else null).otherwise(
            F.col(new_name) if new_name else null
        )
    return cell_grid(dense, 20, cells)


def _block_sql() -> str:
    tiers = [(i, t) for i, t in enumerate(ch.BLOCK_TIERS)]
    kinds = {"猫眼（T3渠道）": "猫眼", "柜台销售": "剧场", "市场部票务": "剧场", "大麦（T3渠道）": "大麦"}
    channel = " ".join(f"when {i + 1} then {q(c or '无')}" for i, c in enumerate(_BLOCK_CHANNELS))
    kind = " ".join(f"when {q(k)} then {q(v)}" for k, v in kinds.items())
    return f"""with s as (select strftime(l_shipdate, '%m-%d') as day, l_linenumber as block, l_returnflag as policy,
        cast(tier as double) as face_price, sum(l_quantity) as n, sum(cast(l_extendedprice as decimal(18,2))) as a
      from lineitem join {values_sql(tiers, 't', 'i, tier')} on l_partkey % 7 = i group by 1, 2, 3, 4),
    x as (select *, case block {channel} end as channel from s)
    select case channel {kind} end as channel_type, policy as channel_detail,
      case when day > '04' then '2023-' else '2024-' end || day || ' 00:00:00' as order_ts,
      '2024-' || lpad(cast(block + 1 as varchar), 2, '0') || '-09 19:30:00' as session_ts, face_price,
      cast(sum(n) as bigint) as tickets, cast(sum(a) as double) as revenue, count(*) as lines
    from x where channel <> '自有' group by 1, 2, 3, 4, 5"""


@query("channel_block_report", _block_sql())
def channel_block_report(spark, sf, rows: bool = False):
    # Reports are files: the derived ones are written once, and the pipeline starts from them.
    grid = written(_block_grid(spark, sf), "block-reports")
    done = ch.block_report(grid, "深圳MA", "剧院", "演出", ["自有"])
    return done if rows else digest(done, "channel_type", "channel_detail", "order_ts", "session_ts", "face_price")


# Wide venue report: one row per ship day, grades from the size class.
@query(
    "channel_graded_report",
    f"""with x as (select strftime(l_shipdate, '%m-%d') as day, l_shipdate + interval 1200 minute as session_ts,
        l_partkey % 4 as g, sum(l_quantity) as tickets, sum(cast(l_extendedprice as decimal(18,2))) as net_revenue
      from lineitem group by 1, 2, 3)
    select '2024-' || day || ' 00:00:00' as order_ts, strftime(session_ts, {TS}) as session_ts,
      cast(880 - 200 * g as double) as face_price, cast(sum(tickets) as bigint) as tickets,
      cast(sum(net_revenue) as double) as revenue, count(*) as lines
    from x group by x.day, x.session_ts, g""",
)
def channel_graded_report(spark, sf, rows: bool = False):
    cls = F.pmod(F.col("l_partkey"), F.lit(4))
    cells = []
    for i, grade in enumerate(ch.GRADES):
        qty, amount = F.when(cls == i, F.col("l_quantity")), F.when(cls == i, F.col("l_extendedprice").cast("decimal(18,2)"))
        cells += [
            F.lit(str(880 - 200 * i)).alias(f"{grade}_票价"),
            text(F.coalesce(F.sum(qty), F.lit(0)).cast("long")).alias(f"{grade}_已售数量"),
            text(F.coalesce(F.sum(amount), F.lit(0))).alias(f"{grade}_已售金额"),
        ]
    raw = (
        lines(spark, sf)
        .groupBy("l_shipdate")
        .agg(*cells)
        .withColumns(
            {
                PART: F.concat(F.lit("x/场次汇总表"), F.date_format("l_shipdate", "MM-dd"), F.lit(".xlsx")),
                "演出时间": F.concat(day_text("l_shipdate"), F.lit(" 20:00")),
            }
        )
    )
    done = ch.graded_report(raw, "剧院", "NTN", r"场次汇总表(\d{2}-\d{2})")
    return done if rows else digest(done, "order_ts", "session_ts", "face_price")


# Section report: one file per day of the year, one section per year, four tier rows and a total.
def _section_grid(spark, sf) -> DataFrame:
    cls = F.pmod(F.col("l_partkey"), F.lit(4))
    sums = (
        lines(spark, sf)
        .groupBy("l_shipdate", cls.alias("g"))
        .agg(
            F.sum("l_quantity").cast("long").alias("n"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("a"),
        )
    )
    at = (F.year("l_shipdate") - 1990) * 10
    body = sums.select(
        "l_shipdate", (at + F.col("g") + 1).alias(ORDER), pick(ch.SECTION_TIERS, F.col("g")).alias("label"), "n", "a"
    )
    days = sums.select("l_shipdate").distinct()
    heads = days.select(
        "l_shipdate", at.alias(ORDER), F.concat(F.lit("场次时间："), day_text("l_shipdate"), F.lit(" 19:30")).alias("label")
    )
    totals = days.select("l_shipdate", (at + 6).alias(ORDER), F.lit("合计").alias("label"), F.lit(5).cast("long").alias("n"))
    rows = (
        body.unionByName(heads, allowMissingColumns=True)
        .unionByName(totals, allowMissingColumns=True)
        .withColumns(
            {
                PART: F.concat(F.lit("x/艺术剧院"), F.date_format("l_shipdate", "MM-dd"), F.lit(".xlsx")),
                ORDER: F.col(ORDER).cast("long"),
            }
        )
    )
    return cell_grid(rows, 22, {1: F.col("label"), 6: F.col("n"), 15: F.lit(3), 22: F.col("a")})


@query(
    "channel_section_report",
    f"""with x as (select strftime(l_shipdate, '%m-%d') as day, l_shipdate + interval 1170 minute as session_ts,
        280.0 + 200 * (l_partkey % 4) as face_price, sum(l_quantity) as tickets,
        sum(cast(l_extendedprice as decimal(18,2))) as net_revenue from lineitem group by 1, 2, 3)
    select '2024-' || day || ' 00:00:00' as order_ts, strftime(session_ts, {TS}) as session_ts,
      cast(face_price as double) as face_price, cast(sum(tickets) as bigint) as tickets,
      cast(sum(net_revenue) as double) as revenue, count(*) as lines
    from x group by x.day, x.session_ts, x.face_price""",
)
def channel_section_report(spark, sf, rows: bool = False):
    done = ch.section_report(_section_grid(spark, sf), "剧院", "NTN", r"艺术剧院(\d{2}-\d{2})")
    return done if rows else digest(done, "order_ts", "session_ts", "face_price")


# Summary report: one file per ship day, five session rows; the second tier is on sale on odd days.
@query(
    "channel_summary_report",
    f"""with s as (select l_shipdate, l_linenumber as k, sum(l_quantity) as n, sum(l_linenumber) as m
        from lineitem group by 1, 2),
    x as (select l_shipdate, l_shipdate + to_days(cast(k as integer)) + interval 1200 minute as session_ts,
        680.0 as face_price, n as tickets from s where k <> 4
      union all select l_shipdate, l_shipdate + to_days(cast(k as integer)) + interval 1200 minute, 880.0, m
        from s where k <> 4 and day(l_shipdate) % 2 = 1)
    select '2024-' || strftime(l_shipdate, '%m-%d') || ' 00:00:00' as order_ts,
      strftime(session_ts, {TS}) as session_ts, cast(face_price as double) as face_price,
      cast(sum(tickets) as bigint) as tickets, cast(sum(tickets * face_price) as double) as revenue, count(*) as lines
    from x group by 1, x.session_ts, x.face_price""",
)
def channel_summary_report(spark, sf, rows: bool = False):
    sums = (
        lines(spark, sf)
        .groupBy("l_shipdate", F.col("l_linenumber").alias("k"))
        .agg(F.sum("l_quantity").cast("long").alias("n"), F.sum("l_linenumber").alias("m"))
    )
    # The fourth session row has an empty cell and is left out as incomplete.
    body = sums.select(
        "l_shipdate", (F.col("k") + 1).cast("long").alias(ORDER),
        F.date_format(
            F.col("l_shipdate") + F.make_dt_interval(F.col("k")), "yyyy年MM月dd日 20:00:00"
        ).alias("session"),
        F.when(F.col("k") != 4, F.col("n")).alias("n"), F.col("m").alias("m"),
    )
    heads = sums.select("l_shipdate").distinct().select("l_shipdate", F.lit(1).cast("long").alias(ORDER))
    cells_of = body.unionByName(heads, allowMissingColumns=True).withColumn(
        PART, F.concat(F.lit("x/上音"), day_text("l_shipdate"), F.lit("_"), F.date_format("l_shipdate", "MM-dd"), F.lit(".csv"))
    )
    wide = F.dayofmonth("l_shipdate") % 2 == 1
    head = F.col(ORDER) == 1
    cells = {i: F.when(head, f"h{i}").otherwise("v") for i in (1, 3, 4, 6)}
    cells |= {
        2: F.when(head, "场次").otherwise(F.col("session")),
        5: F.when(head, "h5").otherwise(text("n")),
        7: F.when(wide, F.when(head, "h7").otherwise(text("m"))),
        8: F.when(wide, F.when(head, "h8").otherwise("v")),
    }
    done = ch.summary_report(cell_grid(cells_of, 10, cells), "剧院", "NTN", r"_(\d{2}-\d{2})\.csv")
    return done if rows else digest(done, "order_ts", "session_ts", "face_price")


# ------------------------------------------------------------------------ direct and distributor
_PROJECTS = [("ECONOMY", "NTN"), ("SMALL", "MOR"), ("LARGE", "MA"), ("MEDIUM", "MA"), ("PROMO", "test")]
_DIRECT_RULES = [
    ("1-URGENT", None, None, "自然销售", None, "自然销售"),
    ("2-HIGH", None, "1997-01-01", "分销-a", None, "分销"),
    ("2-HIGH", "1998-01-01", None, "c", None, "分销"),
    ("3-MEDIUM", None, None, "大客户-施耐德", None, "大客户"),
    ("3-MEDIUM", "1996-06-01", "1999-01-01", "微博-排练照", "1996-06-01", "微博"),
    ("ikids", None, None, "ikids", None, "分销"),
]
_SINCE = "1995-06-01 00:00:00"


def _direct_raw(spark, sf, start: Column | None = None) -> DataFrame:
    """Direct orders; ``start`` is another text of the session, from the line's keys."""
    start = F.concat(day_text("l_shipdate"), F.lit(" 19:30")) if start is None else start
    return (
        lines(spark, sf)
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            text("l_orderkey").alias("订单号"),
            F.col("p_type").alias("项目"),
            F.col("p_brand").alias("场馆"),
            start.alias("开始时间"),
            day_text("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("下单时间"),
            F.when(F.col("l_returnflag") == "R", "-").otherwise(F.col("o_orderpriority")).alias("分销码"),
            cents("p_retailprice").alias("票价"),
            F.when(F.col("l_linenumber") == 1, (F.col("p_retailprice") * 0.5).cast("string"))
            .when(F.col("l_linenumber") > 1, "0")
            .alias("优惠金额"),
            cents("l_extendedprice").alias("结算金额"),
            F.when(F.col("l_linestatus") == "O", "线上").otherwise(
                F.when(F.col("l_linenumber") == 7, sales_plan.OFFLINE_DESK).otherwise("线上")
            ).alias("来源"),
            F.lit("n").alias("收货人姓名"),
            text("o_custkey").alias("收货人手机"),
            F.when(F.col("o_orderstatus") == "P", F.when(F.col("l_linenumber") == 2, "测试").otherwise(F.lit(None)))
            .otherwise("地址")
            .alias("地址信息"),
        )
    )


def _patches(spark, sf) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .filter("o_orderstatus = 'O' and o_orderpriority = '5-LOW'")
        .select(text("o_orderkey").alias("订单号"), F.lit("3-MEDIUM").alias("分销码"))
    )


_DIRECT_SRC = f"""src as (
    select l_orderkey, o_orderdate as order_ts, l_shipdate + interval 1170 minute as session_ts, p_type, p_brand,
      l_linenumber, cast(p_retailprice as double) as price, l_extendedprice as settled, o_custkey,
      case when o_orderstatus = 'O' and o_orderpriority = '5-LOW' then '3-MEDIUM'
           when l_returnflag = 'R' then '-' else o_orderpriority end as code0,
      not (l_linestatus = 'F' and l_linenumber = 7) as online,
      case when o_orderstatus = 'P' then case when l_linenumber = 2 then '测试' end else '地址' end as address
    from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
    where p_type <> 'STANDARD'),
  clean as (
    select *, case when l_linenumber = 1 and order_ts >= timestamp '2000-01-01' and code0 = '-' then 'ikids' else code0 end as code
    from src where online),
  known as (select *, case p_type when 'ECONOMY' then 'NTN' when 'SMALL' then 'MOR' when 'LARGE' then 'MA'
        when 'MEDIUM' then 'MA' when 'PROMO' then 'test' else '未知' end as production,
      row_number() over () as rid
    from clean where address <> '测试' and order_ts >= timestamp '{_SINCE}'),
  matched as (
    select k.rid, coalesce(arg_max(detail, n) filter (detail is not null), '其他') as channel_detail,
      coalesce(arg_max(action_date, n) filter (action_date is not null), '') as action_date,
      coalesce(arg_max(action_type, n) filter (action_type is not null), '其他') as action_type
    from known k left join {values_sql([(i, *r) for i, r in enumerate(_DIRECT_RULES)], 'r',
                                       'n, code, lo, hi, detail, action_date, action_type')}
      on k.code = r.code and (lo is null or order_ts >= cast(lo as timestamp))
      and (hi is null or order_ts < cast(hi as timestamp)) group by 1),
  attributed as (
    select k.*, m.channel_detail, m.action_date, m.action_type,
      case m.action_type when '大客户' then '大客户' when '分销' then '分销-系统' else '自营' end as channel_type
    from known k join matched m on k.rid = m.rid),
  rated as (
    select *, case when channel_detail in ('分销-a', 'c', 'b', 'd', 'e') then case when price >= 780 then 0.9 else 1.0 end
        when channel_detail = '大客户-施耐德' then 0.5
        when channel_type in ('自营', '大客户') then 1.0 end as rate
    from attributed)"""
_DIRECT_KEYS = ["production", "channel_type", "channel_detail", "action_date", "action_type"]


def _tagged_since(spark, sf, start: Column | None = None):
    """Cleaned direct orders with the half-price promotion moved into the data's time range."""
    clean = sales_plan.clean_direct_orders(_direct_raw(spark, sf, start), _patches(spark, sf), "STANDARD")
    return sales_plan.half_price_tag(clean, since="2000-01-01")


@query(
    "direct_sales",
    f"""with {_DIRECT_SRC}
    select production, channel_type, channel_detail, action_date, action_type, count(*) as lines,
      count(*) as tickets, cast(coalesce(sum(cast(cast(settled as decimal(12,2)) * cast(rate as decimal(2,1)) as {MONEY})), 0)
        as double) as revenue
    from rated where production <> 'test' group by 1, 2, 3, 4, 5""",
)
def direct_sales(spark, sf):
    productions = dims.text_map(spark, "production", _PROJECTS, sales_plan.UNKNOWN)
    done = sales_plan.direct_sales(
        _tagged_since(spark, sf), productions, dims.referral(spark, _DIRECT_RULES), _SINCE
    )
    return digest(done, *_DIRECT_KEYS)


@query(
    "tour_direct_sales",
    f"""with {_DIRECT_SRC}
    select p_brand as venue, strftime(session_ts, {TS}) as session_ts, channel_type, count(*) as lines,
      count(*) as tickets, cast(sum(cast(settled as {MONEY})) as double) as revenue
    from attributed where production = 'NTN' group by p_brand, attributed.session_ts, channel_type""",
)
def tour_direct_sales(spark, sf):
    productions = dims.text_map(spark, "production", _PROJECTS, sales_plan.UNKNOWN)
    done = sales_plan.tour_direct_sales(
        _tagged_since(spark, sf), productions, dims.referral(spark, _DIRECT_RULES), _SINCE
    )
    return digest(done, "venue", "session_ts", "channel_type")


_ACCOUNTS = [("1-URGENT", "大客户-a"), ("2-HIGH", "三叶草-深圳"), ("3-MEDIUM", "一起旅课"), ("KH", "自然销售")]
_DIST_TICKETS = ["原价980元", "580两张", "880三张套票", "380", "foo"]
_DIST_PATCHES = [("ECONOMY", None, "KH"), ("SMALL", ["5-LOW", "2-HIGH"], "KH")]


def _distributor_raw(spark, sf, start: Column | None = None) -> DataFrame:
    start = day_text("l_shipdate") if start is None else start
    return (
        lines(spark, sf)
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("p_type").alias("项目"),
            F.when(F.col("l_linenumber") == 7, "test").otherwise(F.col("p_brand")).alias("场地"),
            start.alias("开始时间"),
            day_text("o_orderdate").alias("下单时间"),
            F.col("o_orderpriority").alias("分销码"),
            pick(_DIST_TICKETS, F.col("l_suppkey")).alias("票种"),
            cents("l_extendedprice").alias("结算金额"),
            F.lit("n").alias("收货人姓名"),
            F.lit("p").alias("收货人手机"),
            F.lit("a").alias("地址信息"),
        )
    )


@query(
    "distributor_sales",
    f"""with s as (select p_type, {pick_sql(_DIST_TICKETS, 'l_suppkey')} as t, l_extendedprice as settled,
        case when p_type = 'ECONOMY' or (p_type = 'SMALL' and o_orderpriority in ('5-LOW', '2-HIGH')) then 'KH'
          else o_orderpriority end as code
      from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
      where l_linenumber <> 7 and p_type not in ('PROMO', 'STANDARD')),
    x as (select case code when '1-URGENT' then '大客户-a' when '2-HIGH' then '三叶草-深圳' when '3-MEDIUM' then '一起旅课'
        when 'KH' then '自然销售' else '未知' end as channel_detail,
      case t when '原价980元' then 980.0 when '580两张' then 580.0 when '880三张套票' then 880.0 when '380' then 380.0 else 0.0 end
        as face_price,
      case t when '580两张' then 2 when '880三张套票' then 3 when 'foo' then 0 else 1 end as tickets, settled from s),
    y as (select *, case channel_detail when '大客户-a' then '大客户' when '三叶草-深圳' then '分销-系统'
        when '一起旅课' then '分销-系统' when '自然销售' then '自营' else '' end as channel_type,
      cast(settled as decimal(12,2)) * case channel_detail when '三叶草-深圳' then case when face_price >= 780 then 0.9 else 1.0 end
        when '未知' then null else 1.0 end as net_revenue from x)
    select channel_type, channel_detail, cast(face_price as double) as face_price, {DIGEST_SQL} from y
    group by channel_type, channel_detail, y.face_price""",
)
def distributor_sales(spark, sf):
    done = sales_plan.distributor_sales(
        _distributor_raw(spark, sf),
        dims.text_map(spark, "production", _PROJECTS, sales_plan.UNKNOWN),
        dims.text_map(spark, "account", _ACCOUNTS, sales_plan.UNKNOWN),
        ["PROMO", "STANDARD"],
        _DIST_PATCHES,
    )
    return digest(done, "channel_type", "channel_detail", "face_price")


# Sessions of the calendar, the test session, one outside the calendar, and one that cannot be read.
_MARKET_SESSIONS = [
    *sorted({session[:16] for _, session, *_ in dims.CALENDAR}), dims.TEST_SESSION[0][:16], "2023-01-01 19:30", "soon",
]
_CALENDAR_SQL = values_sql(dims.CALENDAR, "cal", "production, session, project, venue")


@query(
    "market_sales",
    f"""with {_DIRECT_SRC}, merged as (
      select production, order_ts, channel_type, action_date, 1 as tickets, l_orderkey from rated where production <> 'test'
      union all
      select case p_type when 'ECONOMY' then 'NTN' when 'SMALL' then 'MOR' when 'LARGE' then 'MA'
        when 'MEDIUM' then 'MA' else '未知' end, o_orderdate,
        case case when p_type = 'ECONOMY' or (p_type = 'SMALL' and o_orderpriority in ('5-LOW', '2-HIGH')) then 'KH'
          else o_orderpriority end when '1-URGENT' then '大客户' when '2-HIGH' then '分销-系统' when '3-MEDIUM' then '分销-系统'
          when 'KH' then '自营' else '' end, '',
        case {pick_sql(_DIST_TICKETS, 'l_suppkey')} when '580两张' then 2 when '880三张套票' then 3 when 'foo' then 0 else 1 end,
        l_orderkey
      from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
      where l_linenumber <> 7 and p_type not in ('PROMO', 'STANDARD')),
    m as (select *, {pick_sql(_MARKET_SESSIONS, 'l_orderkey')} || ':00' as session from merged),
    placed as (select m.*, case when m.session = {q(dims.TEST_SESSION[0])} then {q(dims.TEST_SESSION[1])} else coalesce(project, '') end as project,
        case when m.session = {q(dims.TEST_SESSION[0])} then {q(dims.TEST_SESSION[2])} else coalesce(venue, '') end as venue
      from m left join {_CALENDAR_SQL} on m.production = cal.production and m.session = cal.session)
    select production, project, venue, strftime(order_ts, '%Y-%m') as month, channel_type, action_date,
      count(*) as lines, cast(sum(tickets) as bigint) as tickets from placed group by 1, 2, 3, 4, 5, 6""",
)
def market_sales(spark, sf):
    """Both systems with project and venue from the calendar."""
    productions = dims.text_map(spark, "production", _PROJECTS, sales_plan.UNKNOWN)
    start = pick(_MARKET_SESSIONS, F.col("l_orderkey"))
    direct = sales_plan.direct_sales(
        _tagged_since(spark, sf, start), productions, dims.referral(spark, _DIRECT_RULES), _SINCE
    )
    distributor = sales_plan.distributor_sales(
        _distributor_raw(spark, sf, start),
        productions,
        dims.text_map(spark, "account", _ACCOUNTS, sales_plan.UNKNOWN),
        ["PROMO", "STANDARD"],
        _DIST_PATCHES,
    )
    both = sales_plan.market_sales(direct, distributor)
    return both.groupBy(
        "production", "project", "venue", F.date_format("order_ts", "yyyy-MM").alias("month"),
        "channel_type", "action_date",
    ).agg(F.count(F.lit(1)).alias("lines"), F.sum("tickets").alias("tickets"))


# ------------------------------------------------------------------------------------ bulk orders
_BULK_LABELS = ["MOR上海大剧院", "MA北京", "MA上海", "其他剧目"]


@query(
    "bulk_orders",
    f"""with s as (select {pick_sql(_BULK_LABELS, 'o_custkey')} as label,
        {pick_sql(['2023-12-02', '2023-12-09', '2024-01-13'], 'o_orderkey')} as d,
        {pick_sql(['午场', '晚场'], 'o_custkey // 4')} as slot, o_orderpriority as name, o_totalprice as net_revenue,
        cast(o_custkey % 9 as integer) as tickets from orders
      where o_orderstatus <> 'F' and o_orderpriority <> '5-LOW'),
    x as (select *, case label when 'MOR上海大剧院' then 'MOR' when 'MA北京' then 'MA' when 'MA上海' then 'MA' else '' end
        as production, d || case when slot = '晚场' then ' 19:30:00' when label in ('MA北京', 'MA上海') and d < '2024'
        then ' 14:30:00' else ' 14:00:00' end as session_ts from s)
    select production, case when production = 'MOR' and d < '2024' then '上海正式'
        when production = 'MA' and d < '2024' then '北京MA' when production = 'MA' then '上海MA' end as project,
      session_ts, '大客户' as channel_type, '大客户团单-' || name as channel_detail, {DIGEST_SQL}
    from x group by production, 2, session_ts, name""",
)
def bulk_orders(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", ch.WITHDRAWN).otherwise("通过").alias("审批状态"),
        F.when(F.col("o_orderpriority") == "5-LOW", "是").alias("特殊处理"),
        pick(_BULK_LABELS, F.col("o_custkey")).alias("剧目及城市"),
        pick(["2023-12-02", "2023-12-09", "2024-01-13"], F.col("o_orderkey")).alias("场次日期"),
        pick(["午场", "晚场"], F.floor(F.col("o_custkey") / 4)).alias("开演时间"),
        F.col("o_orderpriority").alias("客户名称"),
        day_text("o_orderdate").alias("发起时间"),
        text(F.lit(280)).alias("价位(张)"),
        text(F.col("o_custkey") % 9).alias("张数(张)"),
        cents("o_totalprice").alias("实收"),
    )
    done = ch.bulk_orders(raw)
    return digest(done, "production", "project", "session_ts", "channel_type", "channel_detail")


@query(
    "bulk_inline",
    f"""with x as (select {pick_sql(['MA', 'MOR'], 'o_custkey')} as production, o_orderdate + interval 840 minute as session_ts,
        o_orderdate as order_ts, '大客户-' || o_orderstatus as channel_detail, 280.0 as face_price,
        cast(o_custkey % 9 as integer) as tickets, 280 * (o_custkey % 9) as net_revenue from orders)
    select production, '大客户' as channel_type, channel_detail, strftime(session_ts, {TS}) as session_ts,
      strftime(order_ts, {TS}) as order_ts, cast(face_price as double) as face_price, {DIGEST_SQL}
    from x group by production, channel_detail, x.session_ts, x.order_ts, x.face_price""",
)
def bulk_inline(spark, sf):
    raw = table(spark, sf, "orders").select(
        pick(["MA", "MOR"], F.col("o_custkey")).alias("剧目"),
        F.concat(day_text("o_orderdate"), F.lit(" 14:00:00")).alias("场次"),
        day_text("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("下单时间"),
        F.concat(F.lit("大客户-"), F.col("o_orderstatus")).alias("渠道明细"),
        F.lit("280").alias("票价"),
        text(F.lit(280) * (F.col("o_custkey") % 9)).alias("实收"),
        text(F.col("o_custkey") % 9).alias("张数"),
    )
    return digest(ch.bulk_inline(raw), "production", *KEYS, "order_ts")


# --------------------------------------------------------------------------- union and wide table
@query(
    "union_by_name_pad",
    """select 'orders' as source, strftime(o_orderdate, '%Y-%m') as month, count(*) as lines,
      cast(null as bigint) as tickets, cast(sum(cast(o_totalprice as decimal(18,4))) as double) as revenue
    from orders group by 2
    union all
    select event_type, strftime(ts, '%Y-%m'), count(*), cast(sum(event_id % 3) as bigint), null from events group by 1, 2""",
)
def union_by_name_pad(spark, sf):
    a = conform(
        table(spark, sf, "orders").select(
            F.lit("orders").alias("channel_detail"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_totalprice").alias("net_revenue"),
        )
    )
    b = table(spark, sf, "events").select(
        F.col("event_type").alias("channel_detail"),
        F.col("ts").alias("order_ts"),
        (F.col("event_id") % 3).alias("tickets"),
        F.lit(1).alias("not_in_schema"),
    )
    both = ch.union_all([a, conform(b)])
    return out(
        both.groupBy(
            F.col("channel_detail").alias("source"), F.date_format("order_ts", "yyyy-MM").alias("month")
        ).agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("tickets").alias("tickets"),
            F.sum("net_revenue").alias("revenue"),
        )
    )


def _show_raw(spark, sf) -> DataFrame:
    return lines(spark, sf).select(
        F.when(F.col("l_linenumber") == 7, "foo")
        .otherwise(F.concat(day_text("l_shipdate"), F.lit(" 周六 19:30")))
        .alias("场次"),
        text(F.floor("l_extendedprice")).alias("票品"),
        text(F.col("l_quantity").cast("int") - 25).alias("数量"),
    )


@query(
    "wide_sales_load",
    f"""with a as (select '秀动' as channel_detail, cast(null as varchar) as production,
        case when l_linenumber <> 7 then l_shipdate + interval 1170 minute end as session_ts,
        cast(l_quantity as integer) - 25 as tickets,
        floor(l_extendedprice) * (cast(l_quantity as integer) - 25) * 0.94 as net_revenue from lineitem),
    b as (select '猫眼' as channel_detail, 'MA' as production, o_orderdate as session_ts,
        cast(o_custkey % 6 as integer) as tickets,
        (cast(o_totalprice as decimal(14,2)) + o_orderkey % 25) * 0.9 as net_revenue
      from orders join customer on o_custkey = c_custkey where c_mktsegment = 'BUILDING'),
    u as (select channel_detail, production, session_ts, tickets, cast(net_revenue as {MONEY}) as net_revenue from a
      union all select channel_detail, production, session_ts, tickets, cast(net_revenue as {MONEY}) from b)
    select coalesce(production, 'MA') as production, channel_detail, strftime(session_ts, {TS}) as session_ts, {DIGEST_SQL}
    from u where session_ts is not null and tickets > 0 group by 1, 2, u.session_ts""",
)
def wide_sales_load(spark, sf):
    ch.register_channel("show", ch.show_orders("秀动"))
    ch.register_channel("platform", lambda raw: ch.platform_orders(raw, "BUILDING"))
    parts = ch.run_channels({"show": _show_raw(spark, sf), "platform": _platform_raw(spark, sf)})
    return digest(ch.load_wide([parts], "MA"), "production", "channel_detail", "session_ts")


_VENUE_PROJECTS = [("Brand#1", "北京站"), ("Brand#2", "上海站"), ("1-URGENT", "猫眼站")]


@query(
    "tour_master",
    f"""with {_DIRECT_SRC}, u as (
      select p_brand as venue, channel_type, 1 as tickets, cast(settled as {MONEY}) as net_revenue from attributed
        where production = 'NTN'
      union all
      select o_orderpriority, '票务网站', cast(o_custkey % 6 as integer), cast(o_totalprice as {MONEY})
      from orders join customer on o_custkey = c_custkey where c_nationkey % 4 <> 3)
    select case venue when 'Brand#1' then '北京站' when 'Brand#2' then '上海站' when '1-URGENT' then '猫眼站' end as project,
      venue, channel_type, {DIGEST_SQL} from u group by 1, 2, 3""",
)
def tour_master(spark, sf):
    productions = dims.text_map(spark, "production", _PROJECTS, sales_plan.UNKNOWN)
    direct = sales_plan.tour_direct_sales(
        _tagged_since(spark, sf), productions, dims.referral(spark, _DIRECT_RULES), _SINCE
    )
    platform = ch.tour_platform_orders(_platform_raw(spark, sf), dims.text_map(spark, "city", _CITIES))
    master = sales_plan.tour_master(
        [direct, platform], dims.text_map(spark, "venue_project", _VENUE_PROJECTS)
    )
    return digest(master, "project", "venue", "channel_type")


# ----------------------------------------------------------------------------- files in and out
@query(
    "csv_folder_scan",
    """select l_returnflag as part, strftime(l_shipdate, '%Y') as year, count(*) as lines,
      cast(sum(l_orderkey) as bigint) as orders, cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as revenue
    from lineitem group by 1, 2""",
)
def csv_folder_scan(spark, sf):
    """Export text files, one folder per sheet, and read them back as the sources are read."""
    root = shared_dir(spark, "csv")
    names = ["订单号", "下单时间", "实收"]
    lines(spark, sf).select(
        F.col("l_returnflag").alias("sheet"),
        text("l_orderkey").alias("订单号"),
        day_text("l_shipdate").alias("下单时间"),
        cents("l_extendedprice").alias("实收"),
    ).write.partitionBy("sheet").option("header", True).csv(root)
    raw = readers.read_folder(spark, root, names)
    sheet = F.element_at(F.split(readers.sheet_name(), "="), -1)
    return out(
        raw.groupBy(sheet.alias("part"), F.substring("下单时间", 1, 4).alias("year")).agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(F.col("订单号").cast("long")).alias("orders"),
            F.sum(F.col("实收").cast("decimal(18,2)")).alias("revenue"),
        )
    )


START = T.StructField("order_start", T.DateType())


_RESTATED = "o_orderdate >= timestamp '1997-03-01' and o_orderdate < timestamp '1997-04-01'"


@query(
    "partitioned_sales_sink",
    f"""select strftime(o_orderdate, '%Y-%m-%d') as order_day, count(*) as lines,
      cast(sum(cast(o_totalprice as decimal(18,4)) * case when {_RESTATED} then 2 else 1 end) as double) as revenue
    from orders group by 1""",
)
def partitioned_sales_sink(spark, sf):
    """Wide table on disk by order month; one month is written again with other prices, the rest stays."""
    path = shared_dir(spark, "wide")
    price = F.col("o_totalprice").cast("decimal(18,4)")
    given = table(spark, sf, "orders").select(F.col("o_orderdate").alias("order_ts"), price.alias("net_revenue"))
    ingest.write_sales(conform(given), path, unit="month")
    march = given.filter("order_ts >= timestamp_ntz '1997-03-01' and order_ts < timestamp_ntz '1997-04-01'")
    doubled = conform(march.withColumn("net_revenue", F.col("net_revenue") * 2))
    for _ in range(2):  # again after a failure: the same table
        ingest.write_sales(doubled, path, unit="month", only_given=True)
    back = spark.read.schema(T.StructType([*SALES_SCHEMA.fields, START])).parquet(path)
    return out(
        back.groupBy(F.to_date("order_ts").alias("order_day")).agg(
            F.count(F.lit(1)).alias("lines"), F.sum("net_revenue").alias("revenue")
        )
    )
