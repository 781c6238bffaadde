"""Records of quoted reports, read by many tasks per file.

A quoted cell may hold line breaks, so whether a line starts a record depends on all quotes before it.
Each split is first read as if it began outside quotes and as if it began inside: its number of quotes,
and how many records start in it either way, are one small row.  A prefix pass over these rows says how
every split really begins and which record it begins in.  Then each split is read by its own task, which
glues the lines of a record; only a record that crosses a split border is put together by a shuffle, and
only such records take part in it.

Lines end with a line feed; a carriage return before the end of a record is dropped, inside a quoted cell
it is kept.  A quote is doubled inside a quoted cell and does not occur in others.  Blank lines are
records.  An open quote at the end of a file ends its record there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticketlake.operators.lookup import MAX_BROADCAST_ROWS, small_side
from ticketlake.operators.position import ORDER, PART
from ticketlake.session import written

BLOCK = "_block"


def runs_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """(file and block, start, end) of the rows of one split in a batch."""
    files, blocks = batch.column(PART), batch.column(BLOCK).to_numpy()
    same = np.asarray(pc.equal(files.slice(1), files.slice(0, len(files) - 1))) & (blocks[1:] == blocks[:-1])
    cuts = [0, *(np.flatnonzero(~same) + 1).tolist(), len(files)]
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        if end > start:
            yield (files[start].as_py(), int(blocks[start])), start, end


def tally(lines: DataFrame) -> DataFrame:
    """One row per split: its quotes, and the records that start in it if it begins outside or inside quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            quotes = batch.column("quotes").to_numpy()
            for name, start, end in runs_of(batch):
                seen = own.setdefault(name, [0, 0, 0])
                total = np.cumsum(quotes[start:end])
                before = seen[0] + total - quotes[start:end]
                inside = int((before % 2).sum())
                seen[0] += int(total[-1])
                seen[1] += end - start - inside
                seen[2] += inside
        columns = list(zip(*[(*name, *seen) for name, seen in own.items()], strict=True)) or [[]] * 5
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[PART, BLOCK, "quotes", "outside", "inside"]
        )

    quotes = (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).cast("bigint")
    return lines.select(PART, BLOCK, quotes.alias("quotes")).mapInArrow(
        run, f"{PART} string, {BLOCK} bigint, quotes bigint, outside bigint, inside bigint"
    )


def begun(splits: DataFrame) -> DataFrame:
    """(file, block, open, skip, broken): does a split begin inside quotes, the records begun before it, and
    whether a record crosses one of its borders.  A window of the few split rows of a file."""
    earlier = W.partitionBy(PART).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1
    marked = splits.withColumn("open", opened).withColumn("starts", F.when(F.col("open"), F.col("inside")).otherwise(F.col("outside")))
    return marked.select(
        PART,
        BLOCK,
        "open",
        F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("skip"),
        (F.col("open") | (F.col("open") != (F.col("quotes") % 2 == 1))).alias("broken"),
    )


def glued(lines: DataFrame) -> DataFrame:
    """(file, position, block, whole, line): the records of every split; a record that crosses a border comes in
    pieces that are not ``whole``.  ``lines`` has the split's ``open`` and ``skip``, in the order of the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rest = None, None  # the split that is read, and its unfinished record as (position, whole so far, text)
        parity = place = 0

        def flush() -> list[tuple]:
            return [(*name, rest[0], rest[1] and parity == 0, rest[2])] if rest is not None else []

        for batch in batches:
            if not batch.num_rows:
                continue
            text, quotes = batch.column("line"), batch.column("quotes").to_numpy()
            opened, skips = batch.column("open"), batch.column("skip").to_numpy()
            out: list[pa.RecordBatch] = []
            for split, start, end in runs_of(batch):
                ended = []
                if split != name:
                    ended = flush()
                    name, rest = split, None
                    parity, place = int(opened[start].as_py()), int(skips[start])
                if ended:
                    out.append(rows_of(ended))
                before = parity + np.cumsum(quotes[start:end]) - quotes[start:end]
                starts = np.flatnonzero(before % 2 == 0)
                parity = int(before[-1] + quotes[end - 1]) % 2
                # Records as slices of the lines; what comes before the first start belongs to the record before.
                cuts = np.concatenate([starts, [end - start]]).astype(np.int32)
                if cuts[0] > 0:
                    head = "\n".join(text.slice(start, int(cuts[0])).to_pylist())
                    rest = (place - 1, False, head) if rest is None else (rest[0], rest[1], f"{rest[2]}\n{head}")
                if not len(starts):
                    continue
                if rest is not None:
                    # The head ends it here, or the record before the first start was complete.
                    out.append(rows_of([(*name, *rest)]))
                lists = pa.ListArray.from_arrays(pa.array(cuts), text.slice(start, end - start))
                records = pc.binary_join(lists, "\n")
                n = len(records) - 1  # the last may go on
                rest = (place + n, True, records[n].as_py())
                if n:
                    out.append(
                        pa.RecordBatch.from_arrays(
                            [
                                pa.repeat(pa.scalar(name[0], pa.string()), n), pa.repeat(pa.scalar(name[1], pa.int64()), n),
                                pa.array(np.arange(place, place + n)), pa.repeat(pa.scalar(True), n), records.slice(0, n),
                            ],
                            names=[PART, BLOCK, ORDER, "whole", "line"],
                        )
                    )
                place += len(starts)
            yield from out
        if name is not None and rest is not None:
            yield rows_of(flush())

    return lines.mapInArrow(run, f"{PART} string, {BLOCK} bigint, {ORDER} bigint, whole boolean, line string")


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[PART, BLOCK, ORDER, "whole", "line"]
    )


def read_records(spark: SparkSession, paths: str | list[str], file: Column, glob: str | None = None) -> DataFrame:
    """Records as ``(src_file, row_idx, line)`` with a dense 0-based position per file."""
    options = {"recursiveFileLookup": "true", "lineSep": "\n"}
    if glob:
        options["pathGlobFilter"] = glob
    lines = (
        spark.read.options(**options)
        .text(paths)
        .select(
            file.alias(PART),
            F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias("_id"),
            F.col("value").alias("line"),
        )
    )
    splits = written(begun(tally(lines)), "splits")
    count = splits.limit(MAX_BROADCAST_ROWS + 1).count()
    quotes = (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).cast("bigint")

    def pieces(of: DataFrame) -> DataFrame:
        met = lines.join(small_side(of, count), [PART, BLOCK])
        if count > MAX_BROADCAST_ROWS:  # a shuffle join does not keep the order of the scan
            met = met.sortWithinPartitions(PART, BLOCK, "_id")
        return glued(met.select(PART, BLOCK, "open", "skip", "line", quotes.alias("quotes")))

    bare = F.regexp_replace("line", "\r$", "").alias("line")
    records = pieces(splits).filter("whole").select(PART, ORDER, bare)
    broken = splits.filter("broken")
    if broken.isEmpty():
        return records
    # Only splits with a broken border are read again for the records that cross it.
    crossing = pieces(broken).filter("not whole").groupBy(PART, ORDER)
    joined = crossing.agg(F.array_sort(F.collect_list(F.struct(BLOCK, "line"))).alias("pieces")).select(
        PART, ORDER, F.array_join("pieces.line", "\n").alias("line")
    )
    return records.unionByName(joined.select(PART, ORDER, bare))
