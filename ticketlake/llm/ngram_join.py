"""Similarity join of texts on word n-grams, with Bayesian pruning of candidates.

Two texts are linked if the Jaccard similarity of their sets of five-word shingles (words without white
space, A-Z lower-cased) is at least 0.8.  A text of one to four words has one shingle, all its words; a
text without words is linked with nothing.

1. Texts with the same words are one class.  Classes get ``HASHES`` MinHash values, kept to a byte each,
   and ``BANDS`` band keys.
2. Classes that share a band key are candidates.  In each bucket, MinHash values are compared a few at a
   time; a pair is dropped once the posterior probability that its similarity reaches the threshold,
   given the agreements so far, falls below ``TOLERANCE``.  What survives ties classes into groups.
3. Inside the groups the same pruning runs over all pairs, and survivors are verified exactly on their
   shingles, which only classes in groups get.

Buckets and groups are compared in blocks, so none meets in one task, and no row is made per pair: the
result has one row per document with its class, the number of documents it is linked to (its
class's other copies included), and its component, the smallest doc_id that it reaches over links.

Defined results: null and empty texts are linked with nothing, not even each other; rows that repeat a
doc_id each count as a document, and one of a component's is kept; a null doc_id takes part, and sorts
last; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import classes_of, fixed, in_units, ragged, run_units, settle
from .common import components, kept
from .words import FOLD, Spans, buffers, mix, slices, text_array, windows

SHINGLE = 5
THRESHOLD = 0.8
ROWS, BANDS = 4, 24
HASHES = ROWS * BANDS
TOLERANCE = 1e-6
#: MinHash values compared between two looks at the posterior.
LOOK = 16
BUCKET_BLOCK = 512
GROUP_BLOCK = 512
#: Shingles of the rows of a block, on average over its group: 2 MB.
BLOCK_SHINGLES = 1 << 18
#: Rows of ids that may be broadcast: 16 MB.
BROADCAST_ROWS = 2_000_000

_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, hashes: int = HASHES, look: int = LOOK):
    """For each look: the least number of agreeing values with which a pair stays.

    Values are bytes, so two agree with probability s + (1 - s) / 256 at similarity s; the prior of s is uniform.
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    agree = s + (1 - s) / 256
    out = []
    for n in range(look, hashes + 1, look):
        for m in range(n + 1):
            like = m * np.log(agree) + (n - m) * np.log1p(-agree)
            like = np.exp(like - like.max())
            if like[s >= threshold].sum() / like.sum() >= tolerance:
                break
        out.append((n, m))
    return out


LEAST = least_agreements()


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of texts: first and last row, two class keys per text, shingle hashes and their bounds per text."""
    for start, end in slices(texts):
        data, off = buffers(texts.slice(start, end - start))
        spans = Spans(FOLD[data], off)
        ws, we, ranges = spans.words()
        hashes = spans.hashes(ws, we)
        n = np.diff(ranges)
        grams, at = windows(hashes, ranges, SHINGLE)
        holder = np.repeat(np.arange(end - start), n)
        count = np.bincount(holder[at], minlength=end - start) if len(at) else np.zeros(end - start, np.int64)
        # The class key: the hash of all words in order, twice.
        place = (np.arange(len(ws)) - np.repeat(ranges[:-1], n)).astype(np.uint64)
        keys = []
        for salt in (np.uint64(0x51ED270B), np.uint64(0xA24BAED4)):
            values = mix(hashes + mix(place + salt))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
            keys.append(mix(total[ranges[1:]] - total[ranges[:-1]] + n.astype(np.uint64)))
        # Short texts: the class key is their one shingle.
        few = (n > 0) & (n < SHINGLE)
        sizes = np.where(few, 1, count)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        every = np.empty(bounds[-1], np.uint64)
        mine = np.repeat(few, sizes)
        every[~mine] = grams
        every[mine] = keys[0][few]
        yield start, end, keys[0].view(np.int64), keys[1].view(np.int64), every, bounds


def signatures(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values of each text's shingles; a text without any has the highest values."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.full((len(bounds) - 1, HASHES), np.iinfo(np.uint64).max, np.uint64)
    if len(full):
        starts = bounds[:-1][full]
        buffer = np.empty_like(grams)
        for i in range(HASHES):
            np.multiply(grams, _FACTORS[i], out=buffer)
            np.bitwise_xor(buffer, buffer >> np.uint64(31), out=buffer)
            out[full, i] = np.minimum.reduceat(buffer, starts)
    return out


def marks(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, key1, key2, shingles, bands, sketch) of every document (uid, doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column("text"))
            for start, end, one, two, grams, bounds in shingle_sets(texts):
                found = mix(signatures(grams, bounds))
                bands = np.zeros((end - start, BANDS), np.uint64)
                for b in range(BANDS):
                    key = np.full(end - start, b + 1, np.uint64)
                    for r in range(ROWS):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + found[:, b * ROWS + r])
                    bands[:, b] = key
                sketch = np.ascontiguousarray((found >> np.uint64(56)).astype(np.uint8))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (end - start) * BANDS + 1, BANDS), pa.int32()),
                    pa.array(bands.view(np.int64).ravel()),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("uid").slice(start, end - start),
                        batch.column("doc_id").slice(start, end - start),
                        pa.array(one), pa.array(two), pa.array(np.diff(bounds).astype(np.int64)), lists,
                        pa.array([row.tobytes() for row in sketch], pa.binary()),
                    ],
                    names=["uid", "doc_id", "key1", "key2", "shingles", "bands", "sketch"],
                )

    schema = "uid bigint, doc_id bigint, key1 bigint, key2 bigint, shingles bigint, bands array<bigint>, sketch binary"
    return docs.select("uid", "doc_id", "text").mapInArrow(run, schema)


def shingles_of(docs: DataFrame) -> DataFrame:
    """(key1, key2, grams): the sorted different shingles of every document's class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, one, two, grams, bounds in shingle_sets(text_array(batch.column("text"))):
                sets = [np.unique(grams[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one), pa.array(two), pa.array(sets, pa.binary())], names=["key1", "key2", "grams"]
                )

    return docs.select("text").mapInArrow(run, "key1 bigint, key2 bigint, grams binary")


def surviving(sketch: np.ndarray, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a unit that the posterior does not drop, comparing LOOK values at a time."""
    if side is None:
        left = right = np.arange(len(sketch))
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    found_a, found_b = [], []
    step = max(1, 4_000_000 // (LOOK * max(1, len(right))))
    for s in range(0, len(left), step):
        rows = left[s : s + step]
        n, least = LEAST[0]
        agree = (sketch[rows][:, None, :n] == sketch[right][None, :, :n]).sum(2)
        a, b = np.nonzero(agree >= least)
        count = agree[a, b]
        a, b = rows[a], right[b]
        if side is None:
            keep = a < b
            a, b, count = a[keep], b[keep], count[keep]
        for before, (n, least) in zip(LEAST, LEAST[1:], strict=False):
            count = count + (sketch[a, before[0] : n] == sketch[b, before[0] : n]).sum(1)
            keep = count >= least
            a, b, count = a[keep], b[keep], count[keep]
        found_a.append(a)
        found_b.append(b)
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (none, none)


def candidates(table: pa.Table):
    sketch = fixed(table, "sketch", "u1")

    def pairs(start: int, end: int, side):
        return surviving(sketch[start:end], side)

    return pairs


def verified(table: pa.Table):
    sketch = fixed(table, "sketch", "u1")
    grams, bounds = ragged(table, "grams", "u8")

    def pairs(start: int, end: int, side):
        a, b = surviving(sketch[start:end], side)
        if not len(a):
            return a, b
        if side is None:
            # Each row once, against all its survivors behind it.
            order = np.argsort(a, kind="stable")
            a, b = a[order], b[order]
        used = np.unique(np.concatenate([a, b]))
        parts = [grams[bounds[start + i] : bounds[start + i + 1]] for i in used]
        sizes = np.array([len(p) for p in parts])
        _, number = np.unique(np.concatenate(parts), return_inverse=True)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        at = np.full(end - start, -1)
        at[used] = np.arange(len(used))
        present = np.zeros(int(number.max()) + 1, bool)
        keep = np.zeros(len(a), bool)
        firsts, where = np.unique(a, return_index=True)
        for i, s, e in zip(firsts, where, [*where[1:], len(a)], strict=True):
            own = number[begins[at[i]] : ends[at[i]]]
            present[own] = True
            other = at[b[s:e]]
            # Only the survivors' shingles are looked up.
            size = sizes[other]
            spots = np.repeat(begins[other] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            both = np.add.reduceat(present[number[spots]].astype(np.int64), np.cumsum(size) - size)
            present[own] = False
            # both / (own + size - both) >= threshold, in whole numbers
            keep[s:e] = both * 10 >= round(THRESHOLD * 10) * (len(own) + size - both)
        return a[keep], b[keep]

    return pairs


def link(docs: DataFrame, uid: str | None = None) -> DataFrame:
    """(uid, doc_id, class_id, n_links, component_id, kept) for every row of ``docs`` (doc_id, text).

    ``uid`` names a column with a different whole number in each row, if there is one.
    """
    some = F.col("shingles") > 0
    number = F.col(uid) if uid else F.monotonically_increasing_id()
    marked = marks(docs.select(number.alias("uid"), "doc_id", "text"))
    marked = marked.withColumn("key1", F.when(some, F.col("key1")))
    marked = kept(marked, "marks")
    classes = kept(classes_of(marked, "doc_id"), "classes")
    firsts = kept(classes.drop("first").join(marked.select("uid", "bands", "sketch", "shingles"), "uid"), "class-marks")

    keys = firsts.select("uid", F.explode("bands").alias("bucket"))
    live = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = keys.join(live, "bucket").join(firsts.select("uid", "sketch", "copies"), "uid")
    units = in_units(rows, [F.col("bucket")], F.col("n"), BUCKET_BLOCK).drop("bucket", "n")
    tied = run_units(units, candidates).select(F.col("uid").alias("a"), F.col("root").alias("b")).filter("a != b")
    tied = kept(tied.distinct(), "tied")
    ids = tied.select(F.col("a").alias("id")).union(tied.select(F.col("b").alias("id"))).distinct()
    groups = kept(components(ids, tied, "groups").withColumnRenamed("id", "uid"), "groups")

    # As many blocks as rows or shingles ask for: a row of a large group is sent once per block of it.
    blocks = F.greatest(F.count(F.lit(1)) / GROUP_BLOCK, F.sum("shingles") / BLOCK_SHINGLES)
    sizes = groups.join(firsts.select("uid", "shingles"), "uid").groupBy("component").agg(blocks.alias("n"))
    members = kept(groups.join(sizes, "component").join(firsts.drop("bands", "shingles"), "uid"), "members")
    wanted = members.select(F.col("class_id").alias("wanted")).distinct()
    if members.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    sets = shingles_of(texts).groupBy("key1", "key2").agg(F.first("grams").alias("grams"))
    full = members.join(sets, ["key1", "key2"]).select("uid", "copies", "sketch", "grams", "component", "n")
    units = in_units(full, [F.col("component")], F.col("n"), 1).drop("component", "n")
    found = kept(run_units(units, verified), "links")
    return settle(marked, classes, found, "doc_id", "linked")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each group of linked documents, with its columns."""
    given = kept(docs.withColumn("__uid", F.monotonically_increasing_id()), "given")
    gone = kept(link(given, "__uid").filter("not kept").select(F.col("uid").alias("__uid")), "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return given.join(gone, "__uid", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])
