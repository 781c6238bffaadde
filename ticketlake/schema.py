"""Canonical tables and how a source is brought into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money keeps four exact decimals: sums do not depend on the order in which tasks finish.
MONEY = T.DecimalType(18, 4)

SALES_SCHEMA = T.StructType(
    [
        T.StructField("production", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField("venue", T.StringType()),
        T.StructField("session_ts", T.TimestampNTZType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("channel_type", T.StringType()),
        T.StructField("channel_detail", T.StringType()),
        T.StructField("face_price", MONEY),
        T.StructField("net_revenue", MONEY),
        T.StructField("tickets", T.IntegerType()),
        T.StructField("recipient_name", T.StringType()),
        T.StructField("recipient_phone", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("action_date", T.StringType()),
        T.StructField("action_type", T.StringType()),
    ]
)

# Column names of the source files.
SALES_LABELS = {
    "production": "剧目",
    "project": "项目",
    "venue": "剧场",
    "session_ts": "场次",
    "order_ts": "下单时间",
    "channel_type": "渠道类型",
    "channel_detail": "渠道明细",
    "face_price": "票价",
    "net_revenue": "实收",
    "tickets": "张数",
    "recipient_name": "收货人姓名",
    "recipient_phone": "收货人手机",
    "address": "地址",
    "action_date": "动作日期",
    "action_type": "动作类型",
}

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField("session_ts", T.TimestampNTZType()),
        T.StructField("tier", MONEY),
        T.StructField("self_available", T.LongType()),
        T.StructField("self_locked", T.LongType()),
        T.StructField("self_sold", T.LongType()),
        T.StructField("venue_available", T.LongType()),
        T.StructField("venue_sold", T.LongType()),
        T.StructField("channel_available", T.LongType()),
        T.StructField("channel_sold", T.LongType()),
    ]
)

FOLLOWERS_SCHEMA = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("account", T.StringType()),
        T.StructField("day", T.TimestampNTZType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("new", T.DoubleType()),
        T.StructField("cancelled", T.DoubleType()),
    ]
)

CONTENT_SCHEMA = T.StructType(
    [
        T.StructField("platform", T.StringType()),
        T.StructField("account", T.StringType()),
        T.StructField("published_at", T.TimestampNTZType()),
        T.StructField("views", T.DoubleType()),
        T.StructField("interactions", T.DoubleType()),
        T.StructField("shares", T.DoubleType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType = SALES_SCHEMA) -> DataFrame:
    """Exactly the schema's columns, in its order and types; absent columns are typed NULLs.

    Text that is no value of the type becomes NULL.  A number that the type cannot hold fails the job:
    as NULL it would be missing from sums without a word.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        [
            (fitted(f, have[f.name]) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def fitted(field: T.StructField, given: T.DataType) -> Column:
    c = F.col(f"`{field.name}`")
    if given == field.dataType:
        return c
    cast = c.try_cast(field.dataType)
    if not isinstance(field.dataType, T.NumericType):
        return cast
    if isinstance(field.dataType, T.DecimalType):
        most = 10.0 ** (field.dataType.precision - field.dataType.scale)
    elif isinstance(field.dataType, (T.IntegerType, T.LongType)):
        most = 2.0 ** (31 if isinstance(field.dataType, T.IntegerType) else 63)
    else:
        return cast
    number = c.try_cast("double")
    too_big = cast.isNull() & (F.abs(number) >= most) & ~F.isnan(number)
    message = F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "), c.cast("string"))
    return F.when(too_big, F.raise_error(message).cast(field.dataType)).otherwise(cast)


def from_labels(df: DataFrame) -> DataFrame:
    """Rename source labels to canonical names where present."""
    back = {v: k for k, v in SALES_LABELS.items()}
    return df.withColumnsRenamed({c: back[c] for c in df.columns if c in back})


def to_labels(df: DataFrame) -> DataFrame:
    """Rename canonical names back to the report labels."""
    return df.withColumnsRenamed({c: SALES_LABELS[c] for c in df.columns if c in SALES_LABELS})


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
