"""Shared parts of the registered queries: table access, label derivation, output form, SQL text.

A registered query runs a library function over the whole given tables, or over source-shaped
tables that Spark derives from them.  Next to it stands the same result in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query function with its SQL twin."""

    def add(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn

    return add


# Columns of the given tables that the queries read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table with its declared columns: no file is opened to infer them."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def stream_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The same table as a file stream, whether it is one file or a folder."""
    given = table(spark, sf, name)
    files = given.inputFiles()
    if len(files) == 1 and files[0].endswith(f"/{name}.parquet"):
        return spark.readStream.schema(given.schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)
    return spark.readStream.schema(given.schema).parquet(f"{sf}/{name}.parquet")


def out(df: DataFrame) -> DataFrame:
    """Output form: exact decimals as double, wall-clock times and dates as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(cols)


def pick(labels: list[str], key: Column) -> Column:
    """One of the labels, chosen by a number."""
    names = F.array(*[F.lit(x) for x in labels])
    return F.element_at(names, (F.pmod(key, F.lit(len(labels))) + 1).cast("int"))


def q(value) -> str:
    """SQL literal."""
    if value is None:
        return "null"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def pick_sql(labels: list, key: str) -> str:
    return f"([{', '.join(q(x) for x in labels)}])[cast(({key}) % {len(labels)} as integer) + 1]"


def values_sql(rows: list[tuple], name: str, cols: str) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows)
    return f"(values {body}) {name}({cols})"


def in_sql(values: list[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


TS = "'%Y-%m-%d %H:%M:%S'"
DAY = "'%Y-%m-%d'"
MONEY = "decimal(18,4)"
