"""Vector codes: parts of a vector as indexes into learned codebooks, with per-dimension value dictionaries.

A component x is the integer floor(256 * x), and vectors are cut into ``PARTS`` consecutive parts.  Each
part has a codebook of up to ``ENTRIES`` entries: those of the smallest vec_ids at first, then ``ROUNDS``
rounds that give every part to its nearest entry (squared distance, ties to the lower index) and move
each entry to the floor of its parts' mean.

Distances come from dictionaries: the integers of a dimension repeat, so each batch finds the distinct
ones of every dimension, tabulates their squared differences to all entries, and a part's distances are
gathers of table rows by dictionary code, added over the part's dimensions.

Spark holds the integers in a written table, so every round and a lost executor read the same rows.  A
round sends one row per entry and dimension of a task's rows through the shuffle; codebooks (``ENTRIES``
times the dimensions) are all that the driver sees.

Defined results: vectors that are null, empty or hold null or non-finite components are dropped, as are
those of another length than the one with the smallest vec_id; components beyond +-``LARGEST`` / 256
count as that, so that sums stay exact in 64 bits; the first dim mod ``PARTS`` parts are one longer if
the parts cannot be equal; rows that repeat a vec_id each count, in the order of their components; null
vec_ids sort last; the sum of a label's errors stops at the largest long; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.operators.lookup import small_side

from .blocks import fixed
from .common import kept

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
LARGEST = 1 << 24
#: Rows whose distances are held at once.
SLICE = 2048
MAX_LONG = (1 << 63) - 1


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, value): the integers of every valid vector, as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            ends = np.asarray(lists.offsets).astype(np.int64)
            sizes = np.diff(ends)
            flat = lists.values
            bad = ~np.isfinite(flat.to_numpy(zero_copy_only=False).astype(np.float64))
            if flat.null_count:
                bad |= np.asarray(flat.is_null())
            some_bad = np.concatenate([[0], np.cumsum(bad)])
            fine = np.asarray(lists.is_valid()) & (sizes > 0) & (some_bad[ends[1:]] == some_bad[ends[:-1]])
            rows = np.flatnonzero(fine)
            x = np.floor(flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
            whole = np.nan_to_num(np.clip(x, -LARGEST, LARGEST)).astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    batch.column("label").take(pa.array(rows)),
                    pa.array(sizes[rows].astype(np.int32)),
                    pa.array([whole[ends[r] : ends[r + 1]].tobytes() for r in rows.tolist()], pa.binary()),
                ],
                names=["vec_id", "label", "dim", "value"],
            )

    label = vectors.schema["label"].dataType.simpleString()
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label").mapInArrow(
        run, f"vec_id bigint, label {label}, dim int, value binary"
    )


def bounds(dim: int, parts: int) -> np.ndarray:
    """Where each part begins, and the end."""
    return np.cumsum([0, *[dim // parts + (k < dim % parts) for k in range(parts)]])


def dictionary_distances(x: np.ndarray, books: np.ndarray, cuts: np.ndarray) -> Iterator[np.ndarray]:
    """For each part in turn, (rows, entries): squared distances of the rows' parts to its entries."""
    for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        total = np.zeros((len(x), len(books)), np.int64)
        for d in range(start, end):
            values, codes = np.unique(x[:, d], return_inverse=True)
            table = (values[:, None] - books[None, :, d]) ** 2
            total += table[codes]
        yield total


def nearest(x: np.ndarray, books: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, parts): the nearest entries and their squared distances."""
    code = np.zeros((len(x), len(cuts) - 1), np.int64)
    error = np.zeros_like(code)
    for start in range(0, len(x), SLICE):
        rows = x[start : start + SLICE]
        for part, distances in enumerate(dictionary_distances(rows, books, cuts)):
            best = distances.argmin(axis=1)
            code[start : start + SLICE, part] = best
            error[start : start + SLICE, part] = distances[np.arange(len(rows)), best]
    return code, error


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    return fixed(pa.Table.from_batches([batch]), "value", "<i4").astype(np.int64)


def moved(values: DataFrame, books: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all rows."""
    entries, dim = books.shape
    part_of = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((entries, dim), np.int64)
        counts = np.zeros((entries, len(cuts) - 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch)
            code, _ = nearest(x, books, cuts)
            for d in range(dim):
                np.add.at(sums[:, d], code[:, part_of[d]], x[:, d])
            for part in range(len(cuts) - 1):
                counts[:, part] += np.bincount(code[:, part], minlength=entries)
        entry, place = np.nonzero(counts[:, part_of])
        if len(entry):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(entry.astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array(sums[entry, place]),
                    pa.array(counts[entry, part_of[place]]),
                ],
                names=["entry", "place", "total", "n"],
            )

    found = (
        values.select("value")
        .mapInArrow(run, "entry int, place int, total bigint, n bigint")
        .groupBy("entry", "place")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .collect()  # at most entries x dimensions rows
    )
    out = books.copy()
    for row in found:
        out[row["entry"], row["place"]] = row["total"] // row["n"]
    return out


def learn(values: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(entries, dim) codebooks, and the bounds of the parts; ``values`` all have one dimension."""
    first = values.orderBy(F.col("vec_id").asc_nulls_last(), "value").limit(entries).select("value").collect()
    books = np.array([np.frombuffer(r["value"], "<i4") for r in first], np.int64)
    cuts = bounds(books.shape[1], parts)
    for _ in range(rounds):
        books = moved(values, books, cuts)
    return books, cuts


def digest(books: np.ndarray, cuts: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and place."""
    numbers = [books[:, s:e].ravel() for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
    return hashlib.sha256(",".join(map(str, np.concatenate(numbers).tolist())).encode()).hexdigest()


def encode(values: DataFrame, books: np.ndarray, cuts: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, error = nearest(matrix(batch), books, cuts)
            raw = code.astype(np.uint8).tobytes().hex()
            step = 2 * code.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    batch.column("label"),
                    pa.array([raw[i : i + step] for i in range(0, len(raw), step)], pa.string()),
                    pa.array(error.sum(axis=1)),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    label = values.schema["label"].dataType.simpleString()
    return values.select("vec_id", "label", "value").mapInArrow(
        run, f"vec_id bigint, label {label}, code string, error bigint"
    )


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every valid row of (vec_id, embedding, label)."""
    if entries > 256:
        raise ValueError("a code has two hex digits")
    values = kept(integers(vectors), "vector-integers")
    lowest = values.orderBy(F.col("vec_id").asc_nulls_last(), "value").select("dim").first()
    if lowest is None:
        return values.select(
            "vec_id",
            F.lit("").alias("code"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("error", "label_error")],
            F.lit("").alias("codebooks_sha256"),
        )
    values = values.filter(F.col("dim") == lowest["dim"])
    books, cuts = learn(values, parts, entries, rounds)
    coded = kept(encode(values, books, cuts), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy(F.col("label").alias("_label")).agg(
        F.least(total, F.lit(MAX_LONG).cast("decimal(38,0)")).cast("bigint").alias("label_error")
    )
    # One row per label: broadcast if they are few, else a join that adaptive execution splits for a hot label.
    sums = small_side(kept(sums, "label-errors"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books, cuts)).alias("codebooks_sha256")
    )
