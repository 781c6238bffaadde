"""Comparing the rows of groups of any size, within bounded tasks.

A group is dealt into blocks by a hash of the row, and every pair of blocks is a unit of work that some
task streams through.  Small groups are one unit.  Nothing is emitted per pair of rows: a unit returns,
for each of its rows, the sum of what the row is linked to and the root of its linked rows in the unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, kept

#: Bytes of rows that are put together and compared at once, unless one unit has more: a batch of Spark's has 10,000
#: rows, of which every copy would stay in the worker.
PIECE_BYTES = 1 << 22


def in_units(rows: DataFrame, group: list[Column], size: Column, block: int, row: str = "uid") -> DataFrame:
    """Rows with (unit, side, whole), together and in order by unit.

    ``whole``: the unit is one block against itself; else side 0 is compared with side 1.
    """
    n = F.ceil(size / F.lit(float(block))).cast("int")
    parts = rows.withColumn("__n", n).withColumn(
        "__own", F.when(F.col("__n") > 1, F.pmod(F.xxhash64(row), F.col("__n")).cast("int")).otherwise(0)
    )
    dealt = parts.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    low, high = F.least("__own", "__other"), F.greatest("__own", "__other")
    return (
        dealt.withColumns(
            {
                "unit": F.xxhash64(*group, low, high),
                "side": (F.col("__own") > F.col("__other")).cast("int"),
                "whole": F.col("__own") == F.col("__other"),
            }
        )
        .drop("__n", "__own", "__other")
        .repartition("unit")
        .sortWithinPartitions("unit")
    )


def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``PIECE_BYTES``."""
    for batch in batches:
        step = max(1, PIECE_BYTES * batch.num_rows // max(1, batch.nbytes))
        for s in range(0, batch.num_rows, step):
            yield batch.slice(s, step)


def copied(batch: pa.RecordBatch) -> pa.Table:
    """The rows by themselves, so that the batch that they come from is not held."""
    every = pa.array(np.arange(batch.num_rows))
    return pa.Table.from_batches([pa.RecordBatch.from_arrays([c.take(every) for c in batch.columns], schema=batch.schema)])


def stream_units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole units, and the bounds of the units in them."""
    rest: list[pa.Table] = []
    for batch in in_pieces(batches):
        keys = batch.column("unit").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # where the last, perhaps unfinished, unit begins
        if cut == 0 and rest and rest[0]["unit"][0].as_py() == keys[0]:
            rest.append(copied(batch))
            continue
        whole = pa.concat_tables([*rest, pa.Table.from_batches([batch.slice(0, cut)])]).combine_chunks()
        rest = [copied(batch.slice(cut))]
        if whole.num_rows:
            yield whole, bounds_of(whole)
        del whole
    if rest:
        whole = pa.concat_tables(rest).combine_chunks()
        yield whole, bounds_of(whole)


def bounds_of(table: pa.Table) -> np.ndarray:
    keys = table["unit"].to_numpy()
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def fixed(table: pa.Table, name: str, kind: str) -> np.ndarray:
    """A binary column whose values are equally long, as a matrix."""
    found = table[name].combine_chunks()
    if isinstance(found, pa.ChunkedArray):
        found = found.chunk(0)
    found = found.cast(pa.large_binary())
    off = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
    data = np.frombuffer(found.buffers()[2], np.uint8)[off[0] : off[-1]]
    return data.view(kind).reshape(len(found), -1)


def ragged(table: pa.Table, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """A binary column as one array and the bounds of its rows."""
    found = table[name].combine_chunks()
    if isinstance(found, pa.ChunkedArray):
        found = found.chunk(0)
    found = found.cast(pa.large_binary())
    off = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
    data = np.frombuffer(found.buffers()[2], np.uint8)[off[0] : off[-1]].view(kind)
    return data, (off - off[0]) // np.dtype(kind).itemsize


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n rows linked by pairs (a, b): the first row that each reaches."""
    up = np.arange(n)
    if not len(a):
        return up
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    while True:
        # Hang the larger root of each link on the smaller one, then shorten all ways.
        ra, rb = up[lo], up[hi]
        small, large = np.minimum(ra, rb), np.maximum(ra, rb)
        if (small == large).all():
            return up
        np.minimum.at(up, large, small)
        while True:
            nxt = up[up]
            if (nxt == up).all():
                break
            up = nxt


def run_units(
    units: DataFrame, compare: Callable[[pa.Table], Callable[[int, int, np.ndarray | None], tuple[np.ndarray, np.ndarray]]]
) -> DataFrame:
    """(uid, links, root): for every row of a unit that is linked there, the sum of its links' copies.

    ``units`` has uid and copies.  ``compare(table)`` returns a function that gives, for the rows from
    start to end and their sides (None: all against all), the linked pairs as two index arrays relative
    to start.  ``root`` is the uid of one
    row that all rows linked through each other in the unit share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in stream_units(batches):
            uid, copies = column(table, "uid"), column(table, "copies")
            side, whole = column(table, "side"), np.asarray(table["whole"])
            pairs = compare(table)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if end - start < 2:
                    continue
                if whole[start]:
                    a, b = pairs(start, end, None)
                else:
                    a, b = pairs(start, end, side[start:end])
                if not len(a):
                    continue
                n = end - start
                links = np.zeros(n, np.int64)
                np.add.at(links, a, copies[start:end][b])
                np.add.at(links, b, copies[start:end][a])
                up = roots(n, a, b)
                some = np.flatnonzero(links)
                out.append((uid[start:end][some], links[some], uid[start:end][up[some]]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["uid", "links", "root"]
                )
            del table, pairs, out
        # The worker serves later stages too: what Arrow keeps for itself goes back.
        pa.default_memory_pool().release_unused()

    return units.mapInArrow(run, "uid bigint, links bigint, root bigint")


def classes_of(marked: DataFrame, key: str) -> DataFrame:
    """One row per class of equal rows: uid and id (``key``) of its first row, and how many it has.

    ``marked`` has uid, ``key``, key1 and key2; rows without a class have a null key1.
    """
    first = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "uid"))
    return (
        marked.filter("key1 is not null")
        .groupBy("key1", "key2")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("key1", "key2", "copies", "first", F.col("first.uid").alias("uid"), F.col("first.id").alias("class_id"))
    )


def settle(marked: DataFrame, classes: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """(uid, ``key``, class_id, n_links, component_id, kept) for every marked row.

    ``found``: what run_units returns for the classes' uids, each linked pair in one unit only.  A row
    without a class is linked with nothing and kept.  Of a component, the row with the smallest id is kept.
    """
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("uid").alias("a"), F.col("root").alias("b"))
    reached = components(links.select(F.col("uid").alias("id")), edges, name).withColumnRenamed("id", "uid")
    linked = links.join(reached, "uid").join(classes.select("uid", "first"), "uid")
    low = linked.groupBy("component").agg(F.min("first").alias("lowest"))
    linked = kept(linked.join(low, "component").select("uid", "links", "lowest"), f"{name}-linked")
    named = classes.join(linked, "uid", "left").select(
        "key1", "key2", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("lowest", "first").alias("lowest"),
    )
    has = F.col("key1").isNotNull()
    out = marked.select("uid", key, "key1", "key2").join(named, ["key1", "key2"], "left")
    return out.select(
        "uid",
        key,
        F.when(has, F.col("class_id")).otherwise(F.col(key)).alias("class_id"),
        F.when(has, F.col("copies") - 1 + F.col("links")).otherwise(0).cast("bigint").alias("n_links"),
        F.when(has, F.col("lowest.id")).otherwise(F.col(key)).alias("component_id"),
        F.when(has, F.col("lowest.uid") == F.col("uid")).otherwise(True).alias("kept"),
    )
