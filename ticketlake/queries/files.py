"""Queries over written files: several exports, sheets, caches, and strict checks on what they hold."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions import dates
from ticketlake.operators import reshape
from ticketlake.operators.lookup import require, small_side
from ticketlake.operators.position import ORDER, PART
from ticketlake.plans import weekly
from ticketlake.session import shared_dir
from ticketlake.sources import commits, ingest, readers

from .base import out, pick, pick_sql, query, table

_NAMES = ["day", "reads", "shares"]


def _exports(spark, sf) -> str:
    """One folder per event type and parity of the user, as accounts export theirs."""
    root = shared_dir(spark, "exports")
    table(spark, sf, "events").select(
        "event_type",
        F.when(F.col("user_id") % 2 == 0, "user").otherwise("article").alias("kind"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.floor("value").cast("string").alias("reads"),
        (F.col("event_id") % 7).cast("string").alias("shares"),
    ).write.partitionBy("event_type", "kind").option("header", True).csv(root)
    return root


@query(
    "account_exports",
    """select event_type as account, case when user_id % 2 = 0 then 'user' else 'article' end as kind,
      (select count(*) from events e where e.event_type = events.event_type) as all_rows, count(*) as rows, cast(sum(floor(value)) as bigint) as reads, cast(sum(event_id % 7) as bigint) as shares
    from events group by 1, 2, 3""",
)
def account_exports(spark, sf):
    """Several accounts, each from a list of folders; the files are told apart by their name."""
    root = _exports(spark, sf)
    paths = {
        a: [f"{root}/event_type={a}/kind={k}" for k in ("user", "article")] for a in ("view", "click", "signup", "purchase", "error")
    }
    accounts = readers.read_accounts(spark, paths, _NAMES).groupBy("account").agg(F.count(F.lit(1)).alias("all_rows"))
    # The same files by their names.
    files = readers.read_folder(spark, root, _NAMES).withColumn("account", F.regexp_extract(PART, "event_type=([a-z]+)", 1))
    named = files.withColumn(PART, F.regexp_extract(PART, "(kind=[a-z]+)", 1))
    users, articles = readers.split_by_name(named.join(accounts, "account"), "user")
    both = users.withColumn("kind", F.lit("user")).unionByName(articles.withColumn("kind", F.lit("article")))
    return both.groupBy("account", "kind", "all_rows").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("reads").cast("long")).alias("reads"),
        F.sum(F.col("shares").cast("long")).alias("shares"),
    )


@query(
    "sheet_exports",
    """select event_type as sheet, strftime(ts, '%Y-%m') as month, count(*) as rows,
      cast(sum(case when event_type = 'error' then floor(value) else event_id % 7 end) as bigint) as amount
    from events group by 1, 2""",
)
def sheet_exports(spark, sf):
    """A workbook exported sheet by sheet; one sheet has no header and only the first columns."""
    root = shared_dir(spark, "sheets")
    events = table(spark, sf, "events").select(
        "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.floor("value").cast("string").alias("reads"),
        (F.col("event_id") % 7).cast("string").alias("shares"),
    )
    headed = ["click", "purchase", "signup", "view"]
    events.filter(F.col("event_type") != "error").write.partitionBy("event_type").option("header", True).csv(root)
    events.filter(F.col("event_type") == "error").drop("event_type", "shares").write.option("header", False).csv(f"{root}/error")
    with_header = readers.read_sheets(spark, root, {f"event_type={x}": _NAMES for x in headed})
    bare = readers.read_sheets(spark, root, {"error": _NAMES[:2]}, no_header=("error",))["error"]
    parts = [df.select(F.lit(k.split("=")[1]).alias("sheet"), "day", F.col("shares").alias("n")) for k, df in with_header.items()]
    # Only the text columns of a sheet are read.
    parts.append(readers.text_columns(bare).select(F.lit("error").alias("sheet"), "day", F.col("reads").alias("n")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("sheet", F.substring("day", 1, 7).alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("n").cast("long")).alias("amount")
    )


@query(
    "cached_sums",
    """select o_orderpriority as priority, count(*) as orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
    from orders group by 1""",
)
def cached_sums(spark, sf):
    """Built once, then read from its table."""
    path = shared_dir(spark, "cache")

    def build() -> DataFrame:
        return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")
        )

    ingest.cached(spark, path, build)
    again = ingest.cached(spark, path, lambda: build().limit(0))
    return out(reshape.relocate(again, ["total"], before="orders"))


_TEXTS = ["2024-01-05 19:30:00", "2024-01-05 19:30", "2024年01月05日 19:30", "2024/1/5 19:30", "soon"]


@query(
    "session_texts",
    f"""select {pick_sql(_TEXTS, 'o_orderkey')} as given,
      case when o_orderkey % 5 < 4 then '2024-01-05 19:30:00' end as session, count(*) as orders
    from orders group by 1, 2""",
)
def session_texts(spark, sf):
    given = table(spark, sf, "orders").select(pick(_TEXTS, F.col("o_orderkey")).alias("given"))
    return given.groupBy("given", dates.normalize_session("given").alias("session")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    "strict_prices",
    """select o_orderpriority as priority, cast(sum(case o_orderstatus when 'F' then 280 when 'O' then 480 else 680 end) as double) as price
    from orders group by 1""",
)
def strict_prices(spark, sf):
    """A price for every tier, or the job fails."""
    price = F.create_map(*[F.lit(x) for k, v in (("F", 280.0), ("O", 480.0), ("P", 680.0)) for x in (k, v)])
    rows = table(spark, sf, "orders").withColumn("price", require(price[F.col("o_orderstatus")], "tier"))
    return rows.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.sum("price").alias("price"))


@query(
    "full_join_on_measures",
    """with a as (select event_type as platform, user_id % 5 as account, count(*) as items, nullif(sum(event_id % 3), 0) as shares
        from events group by 1, 2),
    b as (select event_type as platform, case when event_type in ('view', 'click') then user_id % 5 else user_id % 7 end as account,
        count(*) as items, nullif(sum(event_id % 3), 0) as shares, max(event_id) as last from events group by 1, 2)
    select coalesce(a.platform, b.platform) as platform, cast(coalesce(a.account, b.account) as bigint) as account,
      coalesce(a.items, b.items) as items, cast(coalesce(a.shares, b.shares) as bigint) as shares, last
    from a full join b on a.platform = b.platform and a.account = b.account and a.items = b.items
      and a.shares is not distinct from b.shares""",
)
def full_join_on_measures(spark, sf):
    """Two tables of accounts that agree on four keys, two of them measures, or stand side by side."""
    events = table(spark, sf, "events")
    sums = [F.count(F.lit(1)).alias("items"), F.nullif(F.sum(F.col("event_id") % 3), F.lit(0)).alias("shares")]

    def accounts(account, *more):
        return events.groupBy(F.col("event_type").alias("platform"), account.alias("account")).agg(*sums, *more)

    five, seven = F.col("user_id") % 5, F.col("user_id") % 7
    left = accounts(five)
    # The same accounts for two platforms, others for the rest.
    right = accounts(F.when(F.col("event_type").isin("view", "click"), five).otherwise(seven), F.max("event_id").alias("last"))
    return weekly.full_join_on_measures(left, right, ["platform", "account", "items", "shares"])


_QUOTED_SQL = """
with lines as (
  select o_orderpriority as note, '"' || o_orderstatus || '",' || chr(10) || 'of ' || o_orderpriority as cell,
    cast(o_totalprice as decimal(18,2)) as price
  from orders
)
select note, cell, count(*) as rows, cast(sum(price) as double) as price
from lines group by 1, 2"""


@query("quoted_breaks_grid", _QUOTED_SQL)
def quoted_breaks_grid(spark, sf):
    """A report with quotes, separators and line breaks inside its cells; every row has a position of its own."""
    root = shared_dir(spark, "quoted")
    status = F.concat(F.lit('"'), "o_orderstatus", F.lit('",\nof '), "o_orderpriority")
    table(spark, sf, "orders").select(
        status.alias("cell"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderpriority"
    ).write.options(quoteAll=True, escape='"').csv(root)
    grid = readers.read_grid(spark, root, 3, glob="*.csv", quoted_breaks=True)
    return out(
        grid.groupBy(F.col("c3").alias("note"), F.col("c1").alias("cell")).agg(
            F.count_distinct(PART, ORDER).alias("rows"), F.sum(F.col("c2").cast("decimal(18,2)")).alias("price")
        )
    )


@query(
    "concurrent_ingest",
    """select event_type, count(*) as rows, cast(sum(floor(value)) as bigint) as reads,
      (select cast(count(*) as integer) from (select distinct event_type, user_id % 2 from events)) as files
    from events group by 1""",
)
def concurrent_ingest(spark, sf):
    """Two runs read the same folder at once, then a third; each file is added once."""
    root, store, manifest = _exports(spark, sf), shared_dir(spark, "store"), shared_dir(spark, "manifest")

    def run(_) -> None:
        # One file of rows per folder counts as one: the folders are the accounts' exports.
        read = readers.read_folder(spark, root, _NAMES)
        ingest.append_unread(read.withColumn(PART, F.regexp_replace(PART, "/[^/]*$", "")), store, manifest)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(run, range(2)))
    run(None)
    schema = "day string, reads string, shares string, src_file string, batch string"
    named = commits.entries(spark, f"{manifest}/log").select("batch")
    rows = spark.read.schema(schema).parquet(store).join(small_side(named), "batch", "left_semi")
    files = ingest.read_manifest(spark, manifest).agg(F.count(F.lit(1)).cast("int").alias("files"))
    counted = rows.groupBy(F.regexp_extract(PART, "event_type=([a-z]+)", 1).alias("event_type")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("reads").cast("long")).alias("reads")
    )
    return counted.withColumn("files", F.lit(files.first()["files"]))
