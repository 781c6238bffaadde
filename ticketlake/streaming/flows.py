"""The batch reports as Structured Streaming flows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ticketlake.operators.rules import RuleSet
from ticketlake.plans.daily import channel_group, totals
from ticketlake.plans.sales import attribute
from ticketlake.schema import conform
from ticketlake.session import shared_dir
from ticketlake.sources import commits
from ticketlake.sources.readers import text_schema

# Event time of a stream; watermarks need a zoned timestamp.
EVENT_TIME = "event_time"
VERSION = "version"


def order_files(spark: SparkSession, folder: str, names: list[str], per_batch: int = 1000) -> DataFrame:
    """New CSV files of a folder, all text."""
    return (
        spark.readStream.schema(text_schema(names))
        .options(header=True, maxFilesPerTrigger=per_batch)
        .csv(folder)
    )


def parquet_files(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet", per_batch: int = 1000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .options(pathGlobFilter=glob, maxFilesPerTrigger=per_batch)
        .parquet(folder)
    )


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that is there, append to a parquet table, stop.

    The checkpoint records each file, so a restarted run reads no file twice.
    """
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_complete(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Like :func:`run_available`, but each batch writes the whole aggregate table as a new version.

    A reader of :func:`latest` sees the version before until the new one is written.
    """

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{VERSION}={number}")
        named = batch.sparkSession.range(1).select(F.lit(number).cast("bigint").alias(VERSION))
        named.write.mode("append").parquet(f"{out}/written")

    query = (
        df.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def latest(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The last version that :func:`run_complete` has written."""
    number = spark.read.parquet(f"{out}/written").agg(F.max(VERSION)).first()[0]
    return spark.read.schema(schema).parquet(f"{out}/{VERSION}={number}")


def ingest(
    spark: SparkSession,
    folder: str,
    names: list[str],
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
) -> DataFrame:
    """Append new order files to a sales table, each file exactly once."""
    run_available(conform(transform(order_files(spark, folder, names))), out, checkpoint)
    return spark.read.parquet(out)


def with_event_time(sales: DataFrame, late: str, at: str = "order_ts") -> DataFrame:
    """Wall-clock time as the same reading in UTC, whatever the session time zone."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(at))
    return sales.withColumn(EVENT_TIME, F.timestamp_micros(micros)).withWatermark(EVENT_TIME, late)


def window_day() -> Column:
    """Date on which a window starts."""
    days = F.floor(F.unix_seconds(F.col("window.start")) / 86400)
    return F.date_from_unix_date(days.cast("int"))


def daily_revenue(sales: DataFrame, late: str = "2 days") -> DataFrame:
    """Tickets and revenue per day and channel group; a day is final when it is ``late`` old."""
    day = F.window(EVENT_TIME, "1 day")
    items = F.count(F.lit(1)).alias("items")
    sums = with_event_time(sales, late).groupBy(day, channel_group().alias("channel_group")).agg(*totals(), items)
    return sums.select(
        window_day().alias("order_day"), "channel_group", "tickets", "revenue", "items"
    )


def weekly_metrics(items: DataFrame, at: str, keys: list[str], late: str = "8 days") -> DataFrame:
    """Item count and value per Monday-based week.

    The epoch was a Thursday, so weeks are shifted by four days.
    """
    week = F.window(EVENT_TIME, "7 days", "7 days", "4 days")
    sums = (
        with_event_time(items, late, at)
        .groupBy(week, *keys)
        .agg(F.count(F.lit(1)).alias("items"), F.sum("amount").alias("amount"))
    )
    return sums.select(window_day().alias("week"), *keys, "items", "amount")


def attributed(orders: DataFrame, rules: RuleSet, code: str, at: str) -> DataFrame:
    """Referral attribution of a stream by one rule table that stays as it is."""
    return attribute(orders, rules, code, at)


@dataclass(frozen=True)
class Run:
    """What one run of a flow did: rows read, rows of the state afterwards, and the watermark it reached."""

    batches: int
    rows: int
    state_rows: int
    late: int
    watermark: str | None

    @classmethod
    def of(cls, query: StreamingQuery) -> Run:
        steps = query.recentProgress
        states = [op for p in steps for op in p.stateOperators]
        marks = [p.eventTime.get("watermark") for p in steps if p.eventTime]
        return cls(
            len(steps),
            sum(p.numInputRows for p in steps),
            states[-1].numRowsTotal if states else 0,
            # Spark counts what reaches the state: partial sums of a task, not single rows.
            sum(op.numRowsDroppedByWatermark for op in states),
            marks[-1] if marks else None,
        )


def finalised(df: DataFrame, out: str, checkpoint: str) -> Run:
    """Append what the watermark has made final, once; the state keeps open windows only.

    Each call reads what is new.  A row that comes after its window became final is left out of it.
    """
    return Run.of(run_available(df, out, checkpoint))


def late_rows(arrived: DataFrame, final: DataFrame, keys: list[str], count: str = "items") -> DataFrame:
    """Final windows with ``late``: how many of the rows that have arrived for them came too late.

    ``arrived`` has one row per key with ``count``, from a batch read of the same files; ``final`` holds
    what the stream has counted.
    """
    came = arrived.select(*[F.col(k).alias(f"_came_{k}") for k in keys], F.col(count).alias("_came"))
    joined = final.join(came, [F.col(k).eqNullSafe(F.col(f"_came_{k}")) for k in keys], "left")
    return joined.withColumn("late", F.col("_came") - F.col(count)).select(*final.columns, "late")


# ----------------------------------------------------------------------------- rules that change
def publish_rules(spark: SparkSession, path: str, rules: DataFrame) -> int:
    """Write a rule table as the next version and return its number; versions never change."""
    while True:
        number = commits.head(spark, f"{path}/log") + 1
        name = f"{VERSION}-{uuid.uuid4().hex}"
        rules.write.parquet(f"{path}/{name}")
        if commits.commit(spark, f"{path}/log", number, name):
            return number


def published(spark: SparkSession, path: str, schema: T.StructType, number: int) -> DataFrame:
    """A version of a rule table."""
    name = commits.entries(spark, f"{path}/log").filter(F.col("n") == number).first()["batch"]
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def attribute_by_version(
    orders: DataFrame, rules_path: str, ruleset: Callable[[DataFrame], RuleSet], schema: T.StructType, code: str, at: str, out: str, checkpoint: str
) -> Run:
    """Referral attribution where each micro-batch uses the rules that are valid when it starts.

    Rows carry the number of the rule version.  The version of a batch is decided once, in a log beside
    its output, so a batch that is run again after a failure gives the same rows in the same folder.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        chosen = f"{out}/{VERSION}s/{number:012d}.json"
        newest = commits.head(spark, f"{rules_path}/log")
        if not newest:
            raise ValueError(f"no rules have been published in {rules_path}")
        commits.claim(spark, chosen, json.dumps({"n": newest, "batch": str(number)}))
        version = spark.read.schema(commits.ENTRY).json(chosen).first()["n"]
        rules = ruleset(published(spark, rules_path, schema, version))
        done = attribute(batch, rules, code, at).withColumn(VERSION, F.lit(version).cast("bigint"))
        done.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    query = (
        orders.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return Run.of(query)


def versioned_rows(spark: SparkSession, out: str) -> DataFrame:
    """The rows that :func:`attribute_by_version` has written."""
    return spark.read.parquet(f"{out}/rows").drop("batch")


def finished(spark: SparkSession, df: DataFrame, name: str, complete: bool = False) -> DataFrame:
    """Run a flow over what is available and read its table back."""
    out, checkpoint = shared_dir(spark, name), shared_dir(spark, f"{name}-checkpoint")
    (run_complete if complete else run_available)(df, out, checkpoint)
    return latest(spark, out, df.schema) if complete else spark.read.schema(df.schema).parquet(out)
