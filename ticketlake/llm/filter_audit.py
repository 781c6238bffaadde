"""What each filter removes under every order of the filters, by min-plus removal ranks.

A document is a mask of the filters that it fails, so an order of the filters need not see documents,
only the masks and how many documents have each.  The mask matrix holds 0 where a mask fails a filter
and infinity elsewhere; the position matrix, the inverse permutation of every order, holds the step at
which an order applies a filter.  Their min-plus product is the step at which each order removes each
mask (infinity: never).  Weighted scatters over that step give all counts of all orders at once, and a
mask that fails a filter later than its own step is redundant there.

Spark marks the documents and counts them by part and mask: at most 2**5 rows a part.  One row per part
then becomes its rows of the audit.

The filters, on whole texts (null: empty; words ``[^\\x20\\x09-\\x0D]+``, case-sensitive):
A under ``MIN_WORDS`` words; B distinct words below a share of the words; C capital letters above a share
of the code points; D holds a symbol of ``SYMBOLS``; E the text is also that of a smaller doc_id,
table-wide.

Defined results: a null part is the empty string; a null doc_id sorts after all others, rows that share
a text's smallest doc_id all stay; a document with several labels is good or toxic if one label says so,
one without a label is neither; labels of no document and those with a null doc_id count for nothing; an
empty table gives an empty audit; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_CAPITALS = 2
# The symbols that filter D looks for.
SYMBOLS = "#$%&*|"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: A text is known by this digest.
DIGEST = 256


def own_failures(text: Column) -> dict[str, Column]:
    """The conditions that a text meets or fails by itself."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n_words < MIN_WORDS,
        "B": F.lit(100) * n_distinct < F.lit(MIN_DISTINCT) * n_words,
        "C": F.lit(100) * F.regexp_count(text, F.lit("[A-Z]")) > F.lit(MAX_CAPITALS) * F.char_length(text),
        "D": text.rlike(f"[{SYMBOLS}]"),
    }


def mask_of(failures: dict[str, Column], filters: str = FILTERS) -> Column:
    """Bit k is set where the k-th filter fails."""
    total = F.lit(0)
    for name, fails in failures.items():
        total = total + F.when(fails, F.lit(1 << filters.index(name))).otherwise(0)
    return total.cast("int")


def masks(documents: DataFrame, part: str = "source") -> DataFrame:
    """(doc_id, digest, part, mask) of every document of (doc_id, text, ``part``).

    The table of digests is written, so texts are read once; it meets the first doc_id of each text on
    digest and doc_id together, so the copies of one text do not meet in one task.
    """
    text = F.coalesce("text", F.lit(""))
    marked = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        mask_of(own_failures(text)).alias("own"),
        F.unhex(F.sha2(text.cast("binary"), DIGEST)).alias("digest"),
    )
    marked = kept(marked, "filter-masks")
    # min skips nulls: a text whose doc_ids are all null has a null first one.
    firsts = marked.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    met = marked.alias("m").join(
        firsts.alias("f"),
        (F.col("m.digest") == F.col("f.digest")) & F.col("m.doc_id").eqNullSafe(F.col("f.doc_id")),
        "left",
    )
    later = F.when(F.col("first").isNull(), F.lit(1 << FILTERS.index("E"))).otherwise(0)
    return met.select("m.doc_id", "m.digest", "part", (F.col("own") + later).cast("int").alias("mask"))


def weights(marked: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): how many documents of each part have each mask."""
    said = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )

    def total(name: str) -> Column:
        return F.sum(F.coalesce(name, F.lit(0)).cast("bigint")).alias(name)

    # Null doc_ids meet no label; their digests keep them from one task.
    salted = marked.withColumn("__salt", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    said = said.filter("doc_id is not null").withColumn("__salt", F.lit(0).cast("bigint"))
    return (
        salted.join(said, ["doc_id", "__salt"], "left")
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("docs"), total("good"), total("toxic"))
    )


def mask_matrix(n: int) -> np.ndarray:
    """(masks, filters): 0 where the mask fails the filter, infinity elsewhere."""
    bits = (np.arange(1 << n)[:, None] >> np.arange(n)[None, :]) & 1
    return np.where(bits == 1, 0.0, np.inf)


def position_matrix(n: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of n filters, and (orders, filters): the step (from 1) at which each applies each."""
    orders = list(permutations(range(n)))
    return orders, np.argsort(np.array(orders), axis=1).astype(float) + 1


def removal_ranks(fails: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The min-plus product: (masks, orders), the first step that removes a mask, infinity if none does."""
    ranks = np.full((len(fails), len(steps)), np.inf)
    for k in range(fails.shape[1]):
        np.minimum(ranks, fails[:, k, None] + steps[None, :, k], out=ranks)
    return ranks


def audit_of(docs: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """Counts as (orders, steps) matrices from the weights of all masks."""
    n = len(filters)
    fails = mask_matrix(n)
    orders, steps = position_matrix(n)
    ranks = removal_ranks(fails, steps)
    gone = np.isfinite(ranks)
    mask, order = np.nonzero(gone)
    at = ranks[gone].astype(np.int64) - 1

    def scatter(weight: np.ndarray) -> np.ndarray:
        out = np.zeros((len(orders), n), np.int64)
        np.add.at(out, (order, at), weight[mask])
        return out

    removed = scatter(docs)
    failing = docs @ (fails == 0).astype(np.int64)  # by filter
    alone = docs[1 << np.arange(n)]
    which = np.array(orders)  # the filter of each step
    shapley = np.zeros(n, np.int64)
    np.add.at(shapley, which, removed)
    return {
        "kept": docs.sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": failing[which] - removed,
        "unique_fails": alone[which],
        "good_lost": scatter(good),
        "toxic_lost": scatter(toxic),
        "shapley": shapley[which],
    }


def audit(documents: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """(part, filter_order, step, counts) for every part, order and step."""
    rows = weights(masks(documents, part), labels)
    # At most one entry per mask.
    parts = rows.groupBy("part").agg(F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("masks"))
    names = ["".join(FILTERS[k] for k in o) for o in permutations(range(len(FILTERS)))]
    n = len(FILTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, found in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist(), strict=True):
                weight = np.zeros((3, 1 << n), np.int64)
                for entry in found:
                    weight[:, entry["mask"]] = entry["docs"], entry["good"], entry["toxic"]
                counts = audit_of(*weight)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * (len(names) * n), pa.string()),
                        pa.array(np.repeat(names, n), pa.string()),
                        pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(names))),
                        *[pa.array(counts[c].ravel()) for c in COUNTS],
                    ],
                    names=["part", "filter_order", "step", *COUNTS],
                )

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return parts.mapInArrow(run, schema)
