"""Quality rules with adaptive thresholds.

Each text gets counts (words, code points, symbols, repeated lines and words).  The measures derived
from them are whole numbers per thousand.  For every language and source a quantile sketch of each
measure is kept: a histogram whose cells are exact below 128 and 64 to an octave above, so that
sketches merge by adding counts, in any order, with a relative error below 1/64.  The thresholds are
read off the sketches' medians and upper percentiles, and one join with them filters the documents.

Groups with fewer than ``MIN_GROUP`` documents use the merged sketch of their language, languages with
fewer the merged sketch of all documents.

Defined results: a null or empty text has no word and fails the base rule; null language or source is a
group of its own; repeated rows count and return each; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, kept
from .words import Spans, buffers, per_text, repeated, slices, text_array, windows

MIN_WORDS = 50
MIN_GROUP = 200
# Characters that count as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

COUNTS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"
)
#: measure: (numerator, denominator, upper percentile, multiple, least distance), per thousand; four more lines
#: keep one repeated line of a short text from counting as much.  A value may lie the multiple of the distance
#: between median and upper percentile above that percentile.  Only where that distance is zero, so that the
#: sketch says nothing about the spread, the least distance takes its place.
MEASURES = {
    "symbol_rate": ("n_symbols", "n_words", 90, 5, 150),
    "word_length": ("word_chars", "n_words", 75, 10, 1000),
    "line_repeat": ("n_dup_lines", "n_lines + 4", 95, 4, 300),
    "word_repeat": ("n_repeat_words", "n_words", 90, 6, 250),
}


def count_texts(texts: pa.Array) -> list[np.ndarray]:
    """The columns of COUNTS for a large_string array."""
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    for start, end in slices(texts):
        data, off = buffers(texts.slice(start, end - start))
        spans = Spans(data, off)
        ws, we, ranges = spans.words()
        n_words = np.diff(ranges)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])
        ls, le, lines = spans.lines()
        full = np.searchsorted(ws, le) > np.searchsorted(ws, ls)
        owner = np.repeat(np.arange(end - start), np.diff(lines))
        later, _ = repeated(owner[full], spans.hashes(ls[full], le[full]))
        dup = np.zeros(len(ls), np.int64)
        dup[full] = later
        grams, at = windows(spans.hashes(ws, we), ranges, 3)
        holder = np.repeat(np.arange(end - start), n_words)
        _, twice = repeated(holder[at], grams)
        inside = np.zeros(len(ws), np.int64)
        for k in range(3):
            inside[at[twice] + k] = 1
        for column, values in zip(
            out,
            (
                n_words,
                per_text(points[we] - points[ws], ranges),
                symbols[off[1:]] - symbols[off[:-1]],
                per_text(full.astype(np.int64), lines),
                per_text(dup, lines),
                per_text(inside, ranges),
            ),
            strict=True,
        ):
            column.append(values)
    return [np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in out]


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of COUNTS."""

    def work():
        def each(batch):
            return [pa.array(c) for c in count_texts(text_array(batch.column("text")))]

        return each

    return add_columns(docs, COUNTS, work)


def rates() -> dict[str, Column]:
    return {
        name: F.expr(f"coalesce((1000 * {top}) div nullif({under}, 0), 0)")  # no words: 0
        for name, (top, under, *_) in MEASURES.items()
    }


def cell(value: Column) -> Column:
    """Lower end of the sketch cell that holds a whole number from 0 up."""
    shift = F.greatest(F.length(F.bin(value)) - F.lit(7), F.lit(0))
    scale = F.pow(F.lit(2), shift).cast("bigint")
    return value - F.pmod(value, scale)


def sketch(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, cell, n): the quantile sketches; they merge by adding n."""
    values = F.array(*[F.struct(F.lit(k).alias("measure"), v.alias("value")) for k, v in rates().items()])
    rows = counted.filter("n_words > 0").select("lang", "source", F.inline(values))
    return (
        rows.withColumn("cell", cell(F.col("value")))
        .groupBy("lang", "source", "measure", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def of_measure(place: int) -> Column:
    """A parameter of the row's measure."""
    return F.create_map(*[F.lit(x) for k, v in MEASURES.items() for x in (k, v[place])])[F.col("measure")].cast("bigint")


def quantiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Documents, median and upper percentile of each merged sketch."""
    merged = cells.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))
    # One sketch has a bounded number of cells, so this list does too.
    sorted_cells = F.array_sort(F.collect_list(F.struct("cell", "n")))
    lists = merged.groupBy(*keys, "measure").agg(sorted_cells.alias("cells"), F.sum("n").alias("docs"))
    lists = lists.withColumn("percent", of_measure(2))

    def at(rank: str) -> str:
        return (
            "aggregate(cells, struct(0L as seen, -1L as got), (a, c) -> struct(a.seen + c.n as seen, "
            f"if(a.got < 0 and a.seen + c.n >= {rank}, c.cell, a.got) as got), a -> a.got)"
        )

    return lists.select(
        *keys,
        "measure",
        "docs",
        F.expr(at("(docs + 1) div 2")).alias("mid"),
        F.expr(at("(docs * percent + 99) div 100")).alias("high"),
    )


def thresholds(cells: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per language and source with the greatest value that each measure may take."""
    groups = cells.select("lang", "source").distinct()
    names = F.array(*[F.lit(m) for m in MEASURES])
    wanted = groups.select("lang", "source", F.explode(names).alias("measure"))
    by_source = quantiles(cells, ["lang", "source"])
    by_lang = quantiles(cells, ["lang"]).withColumnsRenamed({"docs": "docs_l", "mid": "mid_l", "high": "high_l"})
    overall = quantiles(cells, []).withColumnsRenamed({"docs": "docs_a", "mid": "mid_a", "high": "high_a"})
    a, b = by_source.alias("a"), by_lang.alias("b")
    w = wanted.alias("w")
    rows = (
        w.join(a, F.expr("w.lang <=> a.lang and w.source <=> a.source and w.measure = a.measure"), "left")
        .join(b, F.expr("w.lang <=> b.lang and w.measure = b.measure"), "left")
        .join(overall.alias("c"), F.expr("w.measure = c.measure"), "left")
        .select("w.lang", "w.source", "w.measure", "docs", "mid", "high", "docs_l", "mid_l", "high_l", "mid_a", "high_a")
    )

    def level(name: str) -> Column:
        return F.expr(
            f"case when docs >= {min_group} then {name} when docs_l >= {min_group} then {name}_l else {name}_a end"
        )

    rows = rows.withColumns({"me": level("mid"), "hi": level("high")})
    spread = F.col("hi") - F.col("me")
    rows = rows.withColumn("most", F.col("hi") + F.when(spread > 0, of_measure(3) * spread).otherwise(of_measure(4)))
    return rows.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == m, F.col("most"))).alias(f"most_{m}") for m in MEASURES]
    )


def judge(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """(doc_id, counts, base_failed, thresholds, kept) for every row of ``docs`` (doc_id, text, lang, source)."""
    counted = kept(measure(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality-counts")
    limits = kept(thresholds(sketch(counted), min_group), "quality-limits")
    d, t = counted.alias("d"), limits.alias("t")
    joined = d.join(t, F.expr("d.lang <=> t.lang and d.source <=> t.source"), "left")
    failed = F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words")
    fine = F.lit(True)
    for name, rate in rates().items():
        fine = fine & (rate <= F.coalesce(F.col(f"most_{name}"), rate))
    counts = [c.split()[0] for c in COUNTS.split(", ")]
    return joined.select(
        "doc_id",
        *counts,
        *[f"most_{m}" for m in MEASURES],
        failed.alias("base_failed"),
        (~failed & fine).alias("kept"),
    )
