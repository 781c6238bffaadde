"""Operators over row position inside a report file.

Row position is a dense 0-based ``row_idx`` per ``src_file``.  One file may hold a third of all
rows, so no window spans a whole file: rows are cut into fixed chunks of positions, windows run
inside a chunk, and what crosses a chunk border travels in a summary with one row per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PART, ORDER = "src_file", "row_idx"
CHUNK_ROWS = 100_000
_CHUNK = "_chunk"


def _chunk(order: str, rows: int) -> Column:
    return F.floor(F.col(order) / F.lit(rows)).cast("long")


def _before(part: list[str]) -> W:
    return W.partitionBy(*part).orderBy(_CHUNK).rowsBetween(W.unboundedPreceding, -1)


def _inside(part: list[str], order: str) -> W:
    return W.partitionBy(*part, _CHUNK).orderBy(order)


def scan(
    df: DataFrame,
    fills: dict[str, Column] | None = None,
    above: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
    least: dict[str, Column] | None = None,
    greatest: dict[str, Column] | None = None,
    part: str | list[str] = PART,
    order: str = ORDER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Several fills and running totals in file order, with one shuffle and one summary of the chunks.

    Each output column is the last non-NULL value of an expression up to the row (``fills``) or before
    it (``above``), an expression's total up to the row (``sums``), or its least or greatest value in
    the whole file (``least``, ``greatest``).  What belongs to a whole file reaches its rows through the
    summary, so a hot file is never one task's.
    """
    part = [part] if isinstance(part, str) else part
    fills, above, sums, least, greatest = (x or {} for x in (fills, above, sums, least, greatest))
    last = {**fills, **above}
    whole = {**{k: F.min for k in least}, **{k: F.max for k in greatest}}
    given = {f"_v_{k}": v for k, v in {**last, **sums, **least, **greatest}.items()}
    chunked = df.withColumns({_CHUNK: _chunk(order, chunk_rows), **given})

    def value(k: str) -> Column:
        return F.col(f"`_v_{k}`")

    newest = [F.max_by(value(k), F.when(value(k).isNotNull(), F.col(order))).alias(f"_c_{k}") for k in last]
    totals = [F.sum(value(k)).alias(f"_c_{k}") for k in sums]
    carried = (
        chunked.groupBy(*part, _CHUNK)
        .agg(*newest, *totals, *[merge(value(k)).alias(f"_c_{k}") for k, merge in whole.items()])
        .withColumns(
            {
                **{f"_c_{k}": merge(f"`_c_{k}`").over(W.partitionBy(*part)) for k, merge in whole.items()},
                **{f"_c_{k}": F.last(f"`_c_{k}`", True).over(_before(part)) for k in last},
                **{f"_c_{k}": F.coalesce(F.sum(f"`_c_{k}`").over(_before(part)), F.lit(0)) for k in sums},
            }
        )
    )
    to_here = _inside(part, order).rowsBetween(W.unboundedPreceding, 0)
    to_above = _inside(part, order).rowsBetween(W.unboundedPreceding, -1)
    inside = {
        **{f"_v_{k}": F.last(value(k), True).over(to_here) for k in fills},
        **{f"_v_{k}": F.last(value(k), True).over(to_above) for k in above},
        **{f"_v_{k}": F.sum(value(k)).over(to_here) for k in sums},
    }
    # A summary has one row per chunk.
    joined = chunked.withColumns(inside).join(carried, [*part, _CHUNK], "left")
    out = {
        **{k: F.coalesce(value(k), F.col(f"`_c_{k}`")) for k in last},
        **{k: value(k) + F.col(f"`_c_{k}`") for k in sums},
        **{k: F.col(f"`_c_{k}`") for k in whole},
    }
    names = [*df.columns, *[k for k in out if k not in df.columns]]
    return joined.withColumns(out).select([F.col(f"`{c}`") for c in names])


def locf(
    df: DataFrame,
    cols: list[str],
    part: str | list[str] = PART,
    order: str = ORDER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Fill each column down from the last non-NULL value above it in the same file."""
    return scan(df, fills={c: F.col(c) for c in cols}, part=part, order=order, chunk_rows=chunk_rows)


def running_sum(
    df: DataFrame,
    value: Column,
    out: str,
    part: str | list[str] = PART,
    order: str = ORDER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Inclusive running total of a numeric expression in file order."""
    return scan(df, sums={out: value}, part=part, order=order, chunk_rows=chunk_rows)


def shift(
    df: DataFrame,
    cols: dict[str, str],
    offset: int,
    part: str | list[str] = PART,
    order: str = ORDER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Value of a column ``offset`` rows below (or above, when negative) in a dense file.

    ``cols`` maps source column to output column.  Rows near a chunk border are copied to the
    neighbour chunk, so one shuffle is enough.
    """
    part = [part] if isinstance(part, str) else part
    home, reach = _chunk(order, chunk_rows), abs(offset)
    if reach > chunk_rows:
        raise ValueError("offset must fit in one chunk")
    # Rows a window in the neighbour chunk must be able to see.
    if offset > 0:
        neighbour, edge = home - 1, F.pmod(F.col(order), F.lit(chunk_rows)) < reach
    else:
        neighbour, edge = home + 1, F.pmod(F.col(order), F.lit(chunk_rows)) >= chunk_rows - reach
    homes = F.when(edge, F.array(home, neighbour)).otherwise(F.array(home))
    step = F.lead if offset > 0 else F.lag
    win = _inside(part, order)
    return (
        df.withColumn(_CHUNK, F.explode(homes))
        .withColumns({out: step(c, reach).over(win) for c, out in cols.items()})
        .filter(F.col(_CHUNK) == home)
        .drop(_CHUNK)
    )


def densify(
    df: DataFrame, part: str | list[str] = PART, order: str = ORDER, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Renumber the rows left after a filter 0, 1, 2, ... in file order."""
    ranked = running_sum(df, F.lit(1).cast("long"), "_rank", part, order, chunk_rows)
    return ranked.withColumn(order, F.col("_rank") - 1).drop("_rank")


def block_number(
    df: DataFrame,
    is_end: Column,
    out: str = "block",
    part: str | list[str] = PART,
    order: str = ORDER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """1-based block of each row, where a block ends one row after its end marker.

    The rows must be dense in ``order``.
    """
    marked = df.withColumn("_end", F.coalesce(is_end, F.lit(False)).cast("long"))
    ahead = shift(marked, {"_end": "_prev"}, -1, part, order, chunk_rows)
    counted = running_sum(ahead, F.col("_end"), "_ends", part, order, chunk_rows)
    # Markers strictly above the previous row.
    before = F.col("_ends") - F.col("_end") - F.coalesce(F.col("_prev"), F.lit(0))
    return counted.withColumn(out, (before + 1).cast("long")).select(*df.columns, out)


def numbered(
    df: DataFrame,
    keep: Column,
    out: str = "block",
    part: str | list[str] = PART,
    order: str = ORDER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Only the rows that satisfy ``keep``, numbered 1, 2, ... in file order."""
    kept = df.filter(keep)
    ranked = running_sum(kept, F.lit(1).cast("long"), out, part, order, chunk_rows)
    return ranked.select(*df.columns, out)


def drop_first(
    df: DataFrame, part: str | list[str] = PART, order: str = ORDER, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """All rows but the first one of each file."""
    marked = scan(df, least={"_first": F.col(order)}, part=part, order=order, chunk_rows=chunk_rows)
    return marked.filter(F.col(order) > F.col("_first")).drop("_first")


def attach(
    df: DataFrame, per_file: DataFrame, part: str = PART, order: str = ORDER, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Join a per-file table to the rows of each file, through the files' chunks.

    The table meets one row per chunk on the file; rows meet it on file and chunk.
    """
    chunked = df.withColumn(_CHUNK, _chunk(order, chunk_rows))
    chunks = chunked.select(part, _CHUNK).distinct().join(per_file, part)
    joined = chunked.join(chunks, [part, _CHUNK], "left")
    return joined.select(*df.columns, *[c for c in per_file.columns if c != part])


def section_header(
    df: DataFrame,
    header: Column,
    out: str,
    keep: Column,
    part: str | list[str] = PART,
    order: str = ORDER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rows under section headers: carry the header's value down, then keep the body rows."""
    tagged = df.withColumn(out, header)
    body = tagged.filter(F.coalesce(keep, F.lit(False)) | F.col(out).isNotNull())
    return locf(body, [out], part, order, chunk_rows)
