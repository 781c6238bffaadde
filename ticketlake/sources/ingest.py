"""Incremental batch ingest and table sinks."""

from __future__ import annotations

import copy
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.operators.lookup import small_side
from ticketlake.operators.position import PART

from . import commits

BATCH = "batch"
FILES = f"{PART} string"
MANIFEST = f"{FILES}, {BATCH} string"


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are not in the manifest of processed files."""
    return files.join(manifest.select(PART).distinct(), PART, "left_anti")


def table_exists(spark, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def cached(spark, path: str, build, refresh: bool = False) -> DataFrame:
    """Read a materialised table, or build and write it first."""
    if refresh or not table_exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def append_unread(df: DataFrame, store: str, manifest: str) -> DataFrame:
    """Append the rows of unread files to a store, each file once, and return the store's rows.

    A batch has a folder of its own and a list of its files; it counts once the manifest's log names it.
    What a failed run leaves behind is never read.  Several runs may work at once: only one can write
    the next entry of the log, the others take out what it has added and try the entry after it.
    """
    spark = df.sparkSession
    log, lists = f"{manifest}/log", f"{manifest}/files"
    seen = commits.head(spark, log)
    fresh = new_files(df, read_manifest(spark, manifest, seen)) if seen else df
    batch = _write_batch(fresh, store, lists)
    while not commits.commit(spark, log, seen + 1, batch):
        before, seen = seen, commits.head(spark, log)
        added = read_manifest(spark, manifest, seen).filter(F.col("n") > before)
        mine = spark.read.schema(FILES).parquet(f"{lists}/{BATCH}={batch}")
        if not mine.join(added, PART, "left_semi").isEmpty():
            rows = spark.read.schema(df.schema).parquet(f"{store}/{BATCH}={batch}")
            batch = _write_batch(new_files(rows, added), store, lists)
    done = commits.entries(spark, log).select(BATCH)
    rows = spark.read.schema(copy.deepcopy(df.schema).add(BATCH, "string")).parquet(store)
    return rows.join(small_side(done), BATCH, "left_semi").drop(BATCH)


def _write_batch(fresh: DataFrame, store: str, lists: str) -> str:
    """Rows and file names of a new batch, which nobody reads until it is committed."""
    batch = uuid.uuid4().hex
    folder = f"{store}/{BATCH}={batch}"
    fresh.write.parquet(folder)
    spark = fresh.sparkSession
    spark.read.schema(fresh.schema).parquet(folder).select(PART).distinct().write.parquet(f"{lists}/{BATCH}={batch}")
    return batch


def read_manifest(spark, manifest: str, upto: int | None = None) -> DataFrame:
    """(src_file, batch, n): the files of every committed batch, up to an entry of the log."""
    done = commits.entries(spark, f"{manifest}/log")
    done = done if upto is None else done.filter(F.col("n") <= upto)
    if done.isEmpty():
        return spark.createDataFrame([], f"{MANIFEST}, n bigint")
    listed = spark.read.schema(MANIFEST).parquet(f"{manifest}/files")
    return listed.join(small_side(done), BATCH).select(PART, BATCH, "n")


def write_sales(
    df: DataFrame, path: str, unit: str = "day", mode: str = "overwrite", only_given: bool = False
) -> None:
    """Wide sales table partitioned by the start of the order's day (or month), so reports prune files.

    The rebalance keeps the rows of a folder together, yet splits one that is too big for one task.  With
    ``only_given`` an overwrite replaces the days (months) that ``df`` holds and leaves the others as they
    are; writing the same days again gives the same table.
    """
    start = F.date_trunc(unit, "order_ts").cast("date")
    grouped = df.withColumn("order_start", start).hint("rebalance", "order_start")
    writer = grouped.sortWithinPartitions("order_start", "order_ts").write.partitionBy("order_start").mode(mode)
    if only_given:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv", rows_per_file: int = 1_000_000) -> None:
    """Report table with a header: as few files as its size asks for, each of a bounded number of rows."""
    writer = df.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)
