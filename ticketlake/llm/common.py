"""Shared helpers: folds, row functions over Arrow batches, written tables, connected components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.session import shared_dir, written

__all__ = ["add_columns", "components", "fold", "kept", "shared_dir", "ship", "written"]

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of rows that Spark hands to a Python worker at once.  By rows alone a batch has 10,000 texts of any length, which the
#: executor and the worker both hold, in and out, for every task.
BATCH_BYTES = 1 << 22


def ship(spark: SparkSession) -> None:
    """Let Python workers on this file system find the package, wherever they are started, and get batches of bounded size.

    A cluster whose nodes lack it gets it with ``--py-files``.  A bound that the session sets itself stays.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, str(BATCH_BYTES))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])


def fold(key: str, size: int) -> Column:
    """crc32 of the key as text, modulo ``size`` (a null key: 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(size)), F.lit(0))


def add_columns(df: DataFrame, fields: str, work: Callable[[], Callable[[pa.RecordBatch], list]]) -> DataFrame:
    """All columns of ``df`` plus new ones that ``work()`` computes for each Arrow batch.

    ``work`` is called once per task and returns the function for a batch.  A column of ``df`` that
    has the name of a new one gives way to it.
    """
    new = T._parse_datatype_string(fields)
    names = {f.name.lower() for f in new.fields}
    old = [f for f in df.schema.fields if f.name.lower() not in names]
    base = df.select([F.col(f"`{f.name}`") for f in old])
    schema = T.StructType(old + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = work()
        for batch in batches:
            if batch.num_rows:
                extra = each(batch)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *extra], names=[*batch.schema.names, *[f.name for f in new.fields]]
                )

    return base.mapInArrow(run, schema)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, so that later steps and lost executors do not repeat the work."""
    return written(df, name)


def components(nodes: DataFrame, links: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id that each node reaches over links (a, b).

    Large-star and small-star in turn: each round hangs a node's larger neighbours, then its smaller
    ones, on its smallest neighbour.  A round sends one row per link; the number of rounds is
    logarithmic.  Each round is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = kept(edges, f"{name}-links")
    before = None
    for _ in range(rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = big.filter("u != v").distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(
            small.union(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), f"{name}-star"
        )
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return nodes.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("component"))
