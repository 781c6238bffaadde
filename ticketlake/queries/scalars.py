"""Text, number, date, position and inventory-source queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlake.functions import dates as D
from ticketlake.functions import numbers as N
from ticketlake.functions.text import split_pair
from ticketlake.operators import position, reshape
from ticketlake.operators.position import ORDER, PART
from ticketlake.plans import channels as ch
from ticketlake.plans import daily, inventory
from ticketlake.session import written
from ticketlake.sources import readers

from .base import TS, out, pick, pick_sql, query, table, values_sql
from .channels import cell_grid, cents
from .star import NET_SQL, net_revenue

# ----------------------------------------------------------------------------- text and numbers
_ORDERS_OF = "count(*) as orders"


@query(
    "regex_session_extract",
    f"""with x as (select case when o_orderstatus = 'P' then null else o_orderdate + interval 1200 minute end as s from orders)
    select strftime(s, {TS}) as session_ts, {_ORDERS_OF} from x group by x.s""",
)
def regex_session_extract(spark, sf):
    name = F.concat(F.lit("【站】"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 周五 20-00"))
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "Sheet1").otherwise(name).alias("sheet")
    )
    found = orders.withColumn("session_ts", inventory.sheet_session("sheet"))
    return out(found.groupBy("session_ts").agg(F.count(F.lit(1)).alias("orders")))


@query(
    "magnitude_suffix",
    """with x as (select o_custkey % 100 as n, o_orderkey % 6 as k from orders)
    select k, n, case k when 0 then n * 1000.0 when 1 then n * 10000.0 when 2 then cast(n as double) end as w,
      case k when 3 then n * 1000.0 when 2 then cast(n as double) end as wan, count(*) as orders
    from x group by 1, 2, 3, 4""",
)
def magnitude_suffix(spark, sf):
    """Ten-thousand marks of two platforms; the second accepts its mark on decimals only."""
    n, k = F.col("o_custkey") % 100, F.col("o_orderkey") % 6
    tenth = (n.cast("decimal(6,1)") / 10).cast("decimal(6,1)").cast("string")
    whole = n.cast("string")
    text = (
        F.when(k == 0, F.concat(tenth, F.lit("W")))
        .when(k == 1, F.concat(whole, F.lit("w")))
        .when(k == 2, whole)
        .when(k == 3, F.concat(tenth, F.lit("万")))
        .when(k == 4, F.concat(whole, F.lit("万")))
    )
    rows = table(spark, sf, "orders").select(k.alias("k"), n.alias("n"), text.alias("t"))
    both = rows.select(
        "k", "n", N.magnitude("t", "Ww").alias("w"), N.magnitude("t", "万", whole=False).alias("wan")
    )
    return both.groupBy("k", "n", "w", "wan").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "comma_number",
    """select strftime(o_orderdate, '%Y-%m') as month, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total,
      cast(sum(o_custkey) as bigint) as quoted from orders group by 1""",
)
def comma_number(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2).alias("t"),
        F.concat(F.lit("'"), F.col("o_custkey").cast("string")).alias("quoted"),
    )
    return out(
        rows.groupBy("month").agg(
            F.sum(N.strip_commas("t").cast("decimal(18,2)")).alias("total"),
            F.sum(N.strip_apostrophe("quoted").cast("long")).alias("quoted"),
        )
    )


@query(
    "number_text",
    """select l_linenumber, cast(l_quantity as integer) as quantity, cast(cast(l_quantity * 1000000 as bigint) as varchar) as big,
      rtrim(rtrim(cast(cast(l_discount as decimal(4,2)) as varchar), '0'), '.') as discount, count(*) as lines
    from lineitem group by 1, 2, 3, 4""",
)
def number_text(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("quantity"),
        N.num_text(F.col("l_quantity") * 1000000).alias("big"),
        N.num_text("l_discount").alias("discount"),
    )
    return rows.groupBy(rows.columns).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "split_pair",
    """with x as (select case when o_orderstatus = 'P' then 'whole' else o_orderpriority || '-' || o_orderstatus end as t from orders)
    select case when contains(t, '-') then split_part(t, '-', 1) end as head,
      case when contains(t, '-') then substr(t, strpos(t, '-') + 1) end as tail, count(*) as orders from x group by 1, 2""",
)
def split_pair_query(spark, sf):
    t = F.when(F.col("o_orderstatus") == "P", "whole").otherwise(
        F.concat_ws("-", "o_orderpriority", "o_orderstatus")
    )
    head, tail = split_pair("t")
    rows = table(spark, sf, "orders").select(t.alias("t"))
    return rows.groupBy(head.alias("head"), tail.alias("tail")).agg(F.count(F.lit(1)).alias("orders"))


# ---------------------------------------------------------------------------------------- dates
@query(
    "excel_serial",
    f"""select strftime(o_orderdate + interval 1170 minute, {TS}) as at, count(*) as orders from orders
    group by o_orderdate""",
)
def excel_serial(spark, sf):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("2023-01-01").cast("date")) + 44927
    serial = F.concat(days.cast("string"), F.lit(".8125"))
    rows = table(spark, sf, "orders").select(D.excel_serial(serial).alias("at"))
    return out(rows.groupBy("at").agg(F.count(F.lit(1)).alias("orders")))


@query(
    "week_bounds",
    """select strftime(o_orderdate, '%Y-%m-%d') as day, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') as monday,
      strftime(date_trunc('week', o_orderdate) + interval 6 day, '%Y-%m-%d') as sunday,
      (['周一','周二','周三','周四','周五','周六','周日'])[isodow(o_orderdate)] as weekday, count(*) as orders
    from orders group by 1, 2, 3, 4""",
)
def week_bounds(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("day"),
        D.last_monday("o_orderdate").alias("monday"),
        D.this_sunday("o_orderdate").alias("sunday"),
        D.zh_weekday("o_orderdate").alias("weekday"),
    )
    return out(rows.groupBy(rows.columns).agg(F.count(F.lit(1)).alias("orders")))


@query(
    "date_formats",
    f"""select o_custkey % 6 as kind, case when o_custkey % 6 = 5 then null else strftime(o_orderdate + case when
      o_custkey % 6 in (0, 4) then interval 870 minute else interval 0 minute end, {TS}) end as at, count(*) as orders
    from orders group by 1, 2""",
)
def date_formats(spark, sf):
    at = F.col("o_orderdate") + F.expr("INTERVAL 870 MINUTE")
    kind = F.col("o_custkey") % 6
    text = (
        F.when(kind == 0, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(kind == 2, F.date_format("o_orderdate", "yyyy/M/d"))
        .when(kind == 3, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(kind == 4, F.date_format(at, "yyyy年M月d日 HH:mm"))
        .otherwise("not a date")
    )
    rows = table(spark, sf, "orders").select(kind.alias("kind"), D.parse_ts(text).alias("at"))
    return out(rows.groupBy("kind", "at").agg(F.count(F.lit(1)).alias("orders")))


@query(
    "season_dates",
    f"""with x as (select month(o_orderdate) as m, day(o_orderdate) as d from orders)
    select m as month, d as day,
      strftime(try_cast(case when m > 3 then '2023-' else '2024-' end || m || '-' || d as date), {TS}) as season,
      strftime(try_cast('2023-' || m || '-' || d as date), {TS}) as given, count(*) as orders
    from x group by 1, 2""",
)
def season_dates(spark, sf):
    month, day = F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    dotted = F.concat_ws(".", month, day)
    rows = table(spark, sf, "orders").select(
        month.cast("long").alias("month"), day.cast("long").alias("day"),
        D.dot_date(dotted).alias("season"), D.dot_date(dotted, 2023).alias("given"),
    )
    return out(rows.groupBy(rows.columns).agg(F.count(F.lit(1)).alias("orders")))


# ------------------------------------------------------------------------------------- position
_BY_FILE = "partition by strftime(ts, '%Y-%m') order by event_id"


def _file(spark, sf):
    """The events as one report file per month, in row order."""
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM").alias(PART), F.col("event_id").alias(ORDER), "event_type", "value", "user_id"
    )


@query(
    "locf_fill",
    f"""select event_id as row_idx, last_value(case when event_type = 'purchase' then value end ignore nulls)
        over ({_BY_FILE} rows unbounded preceding) as price,
      last_value(case when user_id % 10 = 0 then event_type end ignore nulls)
        over ({_BY_FILE} rows unbounded preceding) as label from events""",
)
def locf_fill(spark, sf):
    rows = _file(spark, sf).select(
        PART, ORDER,
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("price"),
        F.when(F.col("user_id") % 10 == 0, F.col("event_type")).alias("label"),
    )
    return position.locf(rows, ["price", "label"], chunk_rows=1000).drop(PART)


@query(
    "block_assign",
    f"""with x as (select strftime(ts, '%Y-%m') as src_file, sum(case when event_type = 'error' then 1 else 0 end)
        over ({_BY_FILE} rows between unbounded preceding and 2 preceding) as n, value from events)
    select src_file, coalesce(n, 0) + 1 as block, count(*) as rows, cast(sum(cast(value as decimal(18,2))) as double) as value
    from x group by 1, 2""",
)
def block_assign(spark, sf):
    rows = position.block_number(_file(spark, sf), F.col("event_type") == "error", chunk_rows=1000)
    return out(
        rows.groupBy(PART, "block").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value")
        )
    )


@query(
    "line_offset",
    f"""with x as (select event_id, event_type, strftime(ts, '%Y-%m') as f, lead(value, 2) over ({_BY_FILE}) as below,
        lag(event_type, 2) over ({_BY_FILE}) as above from events)
    select event_id as row_idx, below, above from x where event_type = 'purchase'
      and event_id > (select min(event_id) from x y where event_type = 'purchase' and y.f = x.f)""",
)
def line_offset(spark, sf):
    rows = position.shift(_file(spark, sf), {"value": "below"}, 2, chunk_rows=1000)
    rows = position.shift(rows, {"event_type": "above"}, -2, chunk_rows=1000)
    marked = position.drop_first(rows.filter(F.col("event_type") == "purchase"))
    return marked.select(ORDER, "below", "above")


@query(
    "running_totals",
    """select event_id as row_idx, cast(row_number() over (partition by event_type order by event_id) - 1 as bigint) as rank,
      event_type from events""",
)
def running_totals(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias(PART), F.col("event_id").alias(ORDER), F.col("event_id").alias("id")
    )
    dense = position.densify(rows, chunk_rows=1000)
    return dense.select(F.col("id").alias("row_idx"), F.col(ORDER).alias("rank"), F.col(PART).alias("event_type"))


@query(
    "section_headers",
    f"""with x as (select event_id, event_type, value, last_value(case when event_type = 'error' then event_id end ignore nulls)
        over ({_BY_FILE} rows unbounded preceding) as section from events)
    select section, count(*) as rows, cast(sum(cast(value as decimal(18,2))) as double) as value
    from x where event_type = 'view' group by 1""",
)
def section_headers(spark, sf):
    rows = position.section_header(
        _file(spark, sf),
        F.when(F.col("event_type") == "error", F.col(ORDER)),
        "section",
        F.col("event_type") == "view",
        chunk_rows=1000,
    )
    views = rows.filter(F.col("event_type") == "view")
    return out(
        views.groupBy("section").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value")
        )
    )


# ------------------------------------------------------------------------------------- reshape
_GRADES = ["N", "A", "R"]


@query(
    "unpivot_pivot",
    f"""with s as (select l_shipdate, l_returnflag as grade, cast(sum(l_quantity) as bigint) as qty, sum({NET_SQL}) as amount
        from lineitem group by 1, 2)
    select strftime(l_shipdate, {TS}) as day, grade, qty, cast(amount as double) as amount from s""",
)
def unpivot_pivot(spark, sf):
    """Sums to wide grade columns and back to one row per grade."""
    sums = (
        table(spark, sf, "lineitem")
        .groupBy("l_shipdate", "l_returnflag")
        .agg(F.sum("l_quantity").cast("long").alias("qty"), F.sum(net_revenue()).alias("amount"))
    )
    wide = reshape.to_wide(
        sums, ["l_shipdate"], "l_returnflag", _GRADES, {"qty": F.first("qty"), "amount": F.first("amount")}
    )
    named = wide.withColumnsRenamed({f"{m}_{g}": f"{g}_{m}" for g in _GRADES for m in ("qty", "amount")})
    long = reshape.graded_wide(named, ["l_shipdate"], _GRADES, {"qty": "qty", "amount": "amount"})
    return out(long.filter("qty is not null").withColumnRenamed("l_shipdate", "day"))


@query(
    "measure_columns",
    f"""with s as (select o_orderstatus, l_linenumber, sum(l_quantity) as a, sum({NET_SQL}) as b
        from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)
    select o_orderstatus, l_linenumber, 'amount' as measure, cast(b as double) as value from s
    union all select o_orderstatus, l_linenumber, 'count', cast(a as double) from s""",
)
def measure_columns(spark, sf):
    sums = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_orderstatus", "l_linenumber")
        .agg(F.sum("l_quantity").alias("count"), F.sum(net_revenue()).cast("double").alias("amount"))
    )
    return reshape.to_long(sums, ["o_orderstatus", "l_linenumber"], ["count", "amount"], "measure", "value")


# ---------------------------------------------------------------------------- inventory sources
_PRODUCTIONS = ["ECONOMY", "SMALL"]


@query(
    "inventory_self",
    f"""select strftime(date_trunc('month', l_shipdate), {TS}) as session_ts, cast(p_size as double) as tier,
      cast(sum(l_quantity) as bigint) as self_available, cast(sum(l_linenumber) as bigint) as self_locked,
      count(*) as self_sold
    from lineitem join part on l_partkey = p_partkey where p_type in ('ECONOMY', 'SMALL') group by 1, 2""",
)
def inventory_self(spark, sf):
    raw = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("p_type").alias("演出名称"),
            F.date_format("l_shipdate", "yyyy-MM-01 00:00:00").alias("场次时间"),
            F.col("p_size").cast("string").alias("票档"),
            F.col("l_quantity").cast("int").cast("string").alias("剩余数"),
            F.col("l_linenumber").cast("string").alias("预留数"),
            F.lit("1").alias("售出数"),
        )
    )
    rows = inventory.self_inventory(raw, _PRODUCTIONS)
    return out(
        rows.groupBy("session_ts", "tier").agg(
            *[F.sum(c).cast("long").alias(c) for c in ("self_available", "self_locked", "self_sold")]
        )
    )


@query(
    "inventory_sheets",
    f"""with s as (select l_shipdate, l_partkey % 4 as g, sum(l_quantity) as a, sum(l_linenumber) as b from lineitem group by 1, 2)
    select strftime(l_shipdate + interval 1200 minute, {TS}) as session_ts, cast(280 + 200 * g as double) as tier,
      cast(a as bigint) as channel_available, cast(b as bigint) as channel_sold from s
    union all select distinct strftime(l_shipdate + interval 1200 minute, {TS}), 1080, 9, 9 from s""",
)
def inventory_sheets(spark, sf):
    """One sheet per session: two heading rows, then five tier rows and a last one without a tier."""
    g = F.pmod(F.col("l_partkey"), F.lit(4))
    sums = (
        table(spark, sf, "lineitem")
        .groupBy("l_shipdate", g.alias("g"))
        .agg(F.sum("l_quantity").cast("long").alias("a"), F.sum("l_linenumber").alias("b"))
    )
    tail = sums.select("l_shipdate").distinct().withColumns(
        {"g": F.lit(4).cast("long"), "a": F.lit(9).cast("long"), "b": F.lit(9).cast("long")}
    )
    rows = sums.unionByName(tail).unionByName(tail.withColumn("g", F.lit(5).cast("long"))).withColumns(
        {
            PART: F.concat(F.lit("in/"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 周五 20-00/s.csv")),
            ORDER: F.col("g") + 2,
        }
    )
    label = F.when(F.col("g") < 5, F.concat((F.lit(280) + F.col("g") * 200).cast("string"), F.lit("元"))).otherwise("合计")
    grid = cell_grid(rows, 17, {1: label, 3: F.col("b"), 17: F.col("a")})
    done = inventory.platform_inventory(grid)
    return out(
        done.withColumns({c: F.col(c).cast("long") for c in ("channel_available", "channel_sold")})
    )


@query(
    "header_discovery",
    f"""with s as (select l_shipdate, l_partkey % 4 as g, sum(l_quantity) as n, sum(cast(l_extendedprice as decimal(18,2))) as a
        from lineitem group by 1, 2)
    select 'MA' as production, strftime(l_shipdate + interval 1170 minute, {TS}) as session_ts,
      cast(280 + 200 * g as double) as face_price, cast(n as bigint) as tickets, cast(a as double) as revenue from s""",
)
def header_discovery(spark, sf):
    """Reports whose sold and income columns move from file to file."""
    done = venue_sales(spark, sf)
    return out(
        done.select(
            "production", "session_ts", "face_price", F.col("tickets").cast("long").alias("tickets"),
            F.col("net_revenue").alias("revenue"),
        )
    )


def venue_sales(spark, sf):
    g = F.pmod(F.col("l_partkey"), F.lit(4))
    sums = (
        table(spark, sf, "lineitem")
        .groupBy("l_shipdate", g.alias("g"))
        .agg(F.sum("l_quantity").cast("long").alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("a"))
    )
    body = sums.select(
        "l_shipdate", (F.col("g") + 4).alias(ORDER), pick(ch.SECTION_TIERS, F.col("g")).alias("label"),
        F.col("n").cast("string").alias("n"), F.col("a").cast("string").alias("a"),
    )
    days = sums.select("l_shipdate").distinct()
    heads = days.select(
        "l_shipdate",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).cast("long").alias(ORDER), F.lit(lbl).alias("label"), F.lit(n).alias("n"), F.lit(a).alias("a"))
                    for i, (lbl, n, a) in enumerate(
                        [("票价等级", "张", "元"), ("票价等级", "数", "合计应收金额（元）"), ("票价等级", "正常票", "元")]
                    )
                ]
            )
        ).alias("h"),
    ).select("l_shipdate", "h.*")
    section = days.select(
        "l_shipdate", F.lit(3).cast("long").alias(ORDER),
        F.concat(F.lit("场次时间："), F.date_format("l_shipdate", "yyyy-MM-dd 19:30")).alias("label"),
    )
    rows = (
        body.unionByName(heads)
        .unionByName(section, allowMissingColumns=True)
        .withColumn(PART, F.date_format("l_shipdate", "yyyy-MM-dd"))
    )
    # The sold column is 3 or 5, the income column 4 or 6, by the parity of the day.
    odd = F.dayofmonth("l_shipdate") % 2 == 1
    grid = cell_grid(
        rows, 7,
        {1: F.col("label"), 3: F.when(odd, F.col("n")), 5: F.when(~odd, F.col("n")),
         4: F.when(odd, F.col("a")), 6: F.when(~odd, F.col("a"))},
    )
    return inventory.venue_grid_sales(written(grid, "venue-grid"), "MA", ch.SECTION_TIERS)


@query(
    "header_promotion",
    """select event_type, count(*) as rows, cast(sum(cast(value as decimal(18,2))) as double) as value from events group by 1""",
)
def header_promotion(spark, sf):
    """One report per event type with two heading rows; names come from the second."""
    events = table(spark, sf, "events").select(
        F.col("event_type").alias(PART), F.col("event_id").alias(ORDER), "value"
    )
    body = position.densify(events).select(
        PART, (F.col(ORDER) + 2).alias(ORDER), F.col(ORDER).cast("string").alias("c1"), cents("value").alias("c2")
    )
    heads = events.select(PART).distinct().select(
        PART,
        F.posexplode(
            F.array(
                F.struct(F.lit("报表").alias("c1"), F.lit(None).cast("string").alias("c2")),
                F.struct(F.lit("序号").alias("c1"), F.lit("播放量").alias("c2")),
            )
        ).alias(ORDER, "h"),
    ).select(PART, F.col(ORDER).cast("long").alias(ORDER), "h.c1", "h.c2")
    named = readers.promote_header(heads.unionByName(body), ["序号", "播放量"], 1)
    return out(
        named.groupBy(F.col(PART).alias("event_type")).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.col("播放量").cast("decimal(18,2)")).alias("value")
        )
    )


_LABELS = ["早", "中", "晚"]


@query(
    "sell_through_capacity",
    f"""with s as (select {pick_sql(_LABELS, 'o_orderkey')} as production, o_orderdate as session_ts, l_linenumber as tier,
        sum(l_quantity) as n from lineitem join orders on l_orderkey = o_orderkey group by 1, 2, 3),
    cap as (select * from {values_sql([('早', 1, 100), ('中', 2, 200), ('晚', 3, 300)], 'c', 'production, tier, seats')})
    select s.production, strftime(session_ts, {TS}) as session_ts, cast(s.tier as double) as tier, cast(n as bigint) as tickets,
      coalesce(cast(seats as bigint), 0) as seats
    from s left join cap on s.production = cap.production and s.tier = cap.tier""",
)
def sell_through_capacity(spark, sf):
    from ticketlake.operators.rules import RuleSet

    sold = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            pick(_LABELS, F.col("o_orderkey")).alias("production"),
            F.col("o_orderdate").alias("session_ts"),
            F.col("l_linenumber").cast("decimal(18,4)").alias("face_price"),
            F.col("l_quantity").cast("int").alias("tickets"),
            F.lit(0).cast("decimal(18,4)").alias("net_revenue"),
        )
    )
    asked = sold.select("production", "session_ts", F.col("face_price").alias("tier")).distinct()
    seats = RuleSet.of(
        spark, "seats", [("早", 1, 100), ("中", 2, 200), ("晚", 3, 300)],
        {"production": "string", "tier": "decimal(18,4)"}, {"seats": ("bigint", None)},
    )
    return out(daily.sell_through(asked, sold, seats).drop("revenue"))
