"""Streams over several runs: final days, bounded state, rules that change, batches that run again."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ticketlake import dims
from ticketlake.operators.rules import RuleSet
from ticketlake.schema import SALES_SCHEMA, conform
from ticketlake.streaming import flows


def orders(spark, days, folder):
    rows = [("自营", f"2024-01-{d:02d} 10:00:00", 1, 1.0) for d in days]
    df = conform(spark.createDataFrame(rows, ["channel_type", "order_ts", "tickets", "net_revenue"]))
    df.coalesce(1).write.mode("append").parquet(folder)


def test_days_become_final_once_and_late_rows_are_counted(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    seen = []
    # Each run: days that arrive.  Two days must pass before a day is final.
    for days in ([1, 1, 2, 3], [2, 3, 6], [1, 2, 5, 9], [9, 14], [3, 20]):
        orders(spark, days, folder)
        stream = flows.daily_revenue(flows.parquet_files(spark, folder, SALES_SCHEMA))
        seen.append(flows.finalised(stream, out, check))
    final = spark.read.parquet(out)
    days = {r["order_day"].day: r["items"] for r in final.collect()}
    # The watermark after each run: day 1, 4, 7, 12 and 18, always 10:00.  Day 1 is final after the second run,
    # days 2 and 3 too; what comes for them later is late.
    assert days == {1: 2, 2: 2, 3: 2, 5: 1, 6: 1, 9: 2, 14: 1}
    assert final.count() == len(days)
    came = spark.read.schema(SALES_SCHEMA).parquet(folder).groupBy(
        F.to_date("order_ts").alias("order_day"), F.col("channel_type").alias("channel_group")
    ).agg(F.count(F.lit(1)).alias("items"))
    late = {r["order_day"].day: r["late"] for r in flows.late_rows(came, final, ["order_day", "channel_group"]).collect()}
    assert late == {1: 1, 2: 1, 3: 1, 5: 0, 6: 0, 9: 0, 14: 0}
    assert [s.late for s in seen] == [0, 0, 2, 0, 1] and [s.rows for s in seen] == [4, 3, 4, 2, 2]
    # The state holds open days only, however many have passed.
    assert [s.state_rows for s in seen] == [3, 1, 1, 1, 1]


RULES = [("a", None, None, "one", "d1", "t1"), ("b", "2024-01-05", None, "two", "d2", "t2")]
CHANGED = [("a", None, None, "ONE", "d1", "t1"), ("c", None, None, "three", "d3", "t3")]


def events(spark, codes, folder):
    rows = [(c, dt.datetime(2024, 1, 9)) for c in codes]
    spark.createDataFrame(rows, "code string, at timestamp_ntz").coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, base, check="check"):
    folder, rules, out, check = (str(tmp_path / x) for x in ("in", "rules", "out", check))
    stream = flows.parquet_files(spark, folder, spark.read.parquet(folder).schema, per_batch=1)
    flows.attribute_by_version(
        stream, rules, lambda t: RuleSet("referral", t, base.keys, base.outputs, True), base.table.schema, "code", "at", out, check
    )
    return sorted((r["code"], r["channel_detail"], r["version"]) for r in flows.versioned_rows(spark, out).collect())


def test_rules_change_between_batches(spark, tmp_path):
    folder, rules = str(tmp_path / "in"), str(tmp_path / "rules")
    base = dims.referral(spark, RULES)
    events(spark, "ab", folder)
    with pytest.raises(Exception, match="no rules have been published"):
        run(spark, tmp_path, base, "no-rules")
    assert flows.publish_rules(spark, rules, base.table) == 1
    assert run(spark, tmp_path, base) == [("a", "one", 1), ("b", "two", 1)]
    assert flows.publish_rules(spark, rules, dims.referral(spark, CHANGED).table) == 2
    events(spark, "abc", folder)
    want = [("a", "ONE", 2), ("a", "one", 1), ("b", "two", 1), ("b", "其他", 2), ("c", "three", 2)]
    assert run(spark, tmp_path, base) == want
    # A batch that failed after writing runs again with its own version, though newer rules are there.
    flows.publish_rules(spark, rules, base.table)
    newest = max(int(n) for n in os.listdir(tmp_path / "check" / "commits") if n.isdigit())
    for name in (str(newest), f".{newest}.crc"):
        path = tmp_path / "check" / "commits" / name
        if path.exists():
            path.unlink()
    assert run(spark, tmp_path, base) == want


def test_observed_lookups_on_a_stream(spark, tmp_path):
    """The audit of a lookup travels with every batch of the stream."""
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    base = dims.referral(spark, RULES)
    events(spark, "aazzy", folder)
    stream = flows.parquet_files(spark, folder, spark.read.parquet(folder).schema)
    found = base.observed(stream, {"code": "code"}, "at", metrics="referral").drop("_r_unknown")
    query = flows.run_available(found, out, check)
    metrics = query.recentProgress[0].observedMetrics["referral"]
    assert (metrics["rows"], metrics["unknown"]) == (5, 3)
    # What is known stands under no label.
    assert {(r["item"], r["count"]) for r in metrics["labels"]} == {("z", 2), ("y", 1), (None, 2)}
