"""Readers: every source column arrives as text, with its file and row position.

Spreadsheets come as one exported CSV (or text) file per sheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlake.functions.dates import month_day
from ticketlake.functions.text import capture
from ticketlake.operators.lookup import small_side
from ticketlake.operators.position import ORDER, PART, attach, numbered, scan

from .records import read_records

Paths = str | list[str]


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(
    spark: SparkSession, paths: Paths, names: list[str], header: bool = True, **options
) -> DataFrame:
    """All-text CSV scan of one or many files with a declared column list.

    Columns are matched to the header by position, so a changed file fails loudly
    (``enforceSchema`` is off) instead of shifting values.
    """
    return (
        spark.read.schema(text_schema(names))
        .options(header=header, enforceSchema=not header, **options)
        .csv(paths)
    )


def file_path() -> Column:
    """Path of the scanned file as plain text (the scan reports it percent-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_accounts(
    spark: SparkSession, paths: dict[str, Paths], names: list[str], **options
) -> DataFrame:
    """Exports of several accounts as one table with an ``account`` column."""
    parts = [
        read_csv(spark, p, names, **options).withColumn("account", F.lit(account))
        for account, p in paths.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_source(df: DataFrame) -> DataFrame:
    """Add the path of the file each row came from."""
    return df.withColumn(PART, file_path())


def read_folder(
    spark: SparkSession, folder: str, names: list[str], glob: str = "*.csv", **options
) -> DataFrame:
    """All files of a folder that match a name pattern, with their path."""
    return with_source(
        read_csv(spark, folder, names, pathGlobFilter=glob, recursiveFileLookup=True, **options)
    )


def split_by_name(df: DataFrame, marker: str) -> tuple[DataFrame, DataFrame]:
    """Rows of files whose name contains ``marker``, and the rest."""
    hit = F.element_at(F.split(PART, "/"), -1).contains(marker)
    return df.filter(hit), df.filter(~hit)


def read_lines(spark: SparkSession, paths: Paths, glob: str | None = None) -> DataFrame:
    """Text lines as ``(src_file, row_idx, line)`` with a dense 0-based position per file.

    A large file is read by many tasks.  Within one split the row ids of the scan rise by one;
    the lines before the split are known from one count per split.
    """
    options = {"recursiveFileLookup": "true"}
    if glob:
        options["pathGlobFilter"] = glob
    lines = (
        spark.read.options(**options)
        .text(paths)
        .select(
            file_path().alias(PART),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
            F.col("value").alias("line"),
        )
    )
    earlier = W.partitionBy(PART).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    splits = (
        lines.groupBy(PART, "_block")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_skip", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    return lines.join(splits, [PART, "_block"]).select(
        PART, (F.col("_skip") + F.col("_id") - F.col("_first")).alias(ORDER), "line"
    )


def read_grid(
    spark: SparkSession,
    paths: Paths,
    width: int,
    sep: str = ",",
    glob: str | None = None,
    quoted_breaks: bool = False,
) -> DataFrame:
    """A headerless report as ``(src_file, row_idx, c1..cn)``; empty cells are NULL.

    With ``quoted_breaks`` a quoted cell may hold line breaks, and quotes in it are doubled.  Both kinds of
    report are read by as many tasks as they have splits.
    """
    lines = read_records(spark, paths, file_path(), glob) if quoted_breaks else read_lines(spark, paths, glob)
    return to_grid(lines, width, sep, {"escape": '"'} if quoted_breaks else {})


def to_grid(lines: DataFrame, width: int, sep: str = ",", options: dict[str, str] | None = None) -> DataFrame:
    names = [f"c{i}" for i in range(1, width + 1)]
    parsed = F.from_csv("line", ", ".join(f"{n} STRING" for n in names), {"sep": sep, **(options or {})})
    return lines.select(PART, ORDER, parsed.alias("_g")).select(
        PART, ORDER, *[F.nullif(F.trim(f"_g.{n}"), F.lit("")).alias(n) for n in names]
    )


def grid_columns(grid: DataFrame) -> list[str]:
    return [c for c in grid.columns if c not in (PART, ORDER)]


def text_columns(df: DataFrame) -> DataFrame:
    """Only the text columns (and the position)."""
    keep = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) or f.name in (PART, ORDER)
    ]
    return df.select(keep)


def pick(grid: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Columns by 1-based index, renamed."""
    cells = grid_columns(grid)
    return grid.select(
        PART, ORDER, *[F.col(cells[i - 1]).alias(name) for name, i in columns.items()]
    )


def rows_between(grid: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """0-based inclusive slice of every file."""
    cond = F.col(ORDER) >= first
    return grid.filter(cond & (F.col(ORDER) <= last) if last is not None else cond)


def promote_header(grid: DataFrame, names: list[str], header_row: int) -> DataFrame:
    """Give the columns their declared names and drop everything down to the header row."""
    cells = grid_columns(grid)
    return rows_between(grid, header_row + 1).select(
        PART, ORDER, *[F.col(c).alias(n) for c, n in zip(cells, names)]
    )


def header_mismatch(grid: DataFrame, names: list[str], header_row: int) -> DataFrame:
    """Files whose header row is not the declared one."""
    cells = F.array(*[F.col(c) for c in grid_columns(grid)[: len(names)]])
    want = F.array(*[F.lit(n) for n in names])
    return grid.filter((F.col(ORDER) == header_row) & ~cells.eqNullSafe(want)).select(
        PART, cells.alias("found")
    )


def preamble(
    grid: DataFrame, cells: dict[str, tuple[int, int]], skip_rows: int, files: int | None = None
) -> DataFrame:
    """Fixed cells (0-based row, 1-based column) of each file become columns of its body rows.

    With a known number of files the cells are joined, broadcast when that is small; otherwise they
    travel in the chunk summary.
    """
    cols = grid_columns(grid)
    found = {name: F.when(F.col(ORDER) == r, F.col(cols[c - 1])) for name, (r, c) in cells.items()}
    if files is None:
        return rows_between(scan(grid, greatest=found), skip_rows)
    head = (
        grid.filter(F.col(ORDER) < skip_rows).groupBy(PART).agg(*[F.max(c).alias(n) for n, c in found.items()])
    )
    return attach_to_source(rows_between(grid, skip_rows), head, files)


def by_layout(
    grid: DataFrame, layouts: list[tuple[str, dict[str, int]]], default: dict[str, int]
) -> DataFrame:
    """Columns by index where the indexes depend on the file name (first pattern that fits)."""
    cells = grid_columns(grid)
    out = []
    for name, idx in default.items():
        expr = F.col(cells[idx - 1])
        for pattern, layout in reversed(layouts):
            expr = F.when(F.col(PART).rlike(pattern), F.col(cells[layout[name] - 1])).otherwise(expr)
        out.append(expr.alias(name))
    return grid.select(PART, ORDER, *out)


def file_date(pattern: str, year: int | None = None) -> Column:
    """Report day taken from ``MM-DD`` in the file name."""
    return month_day(capture(PART, pattern, 1), year)


def find_columns(
    grid: DataFrame, header_cell: str, wanted: dict[str, tuple[int, str]]
) -> DataFrame:
    """Per file, the 1-based index of the column whose n-th header row contains a text.

    Header rows are those whose first cell is ``header_cell``; ``wanted`` maps an output name to
    (n, text).
    """
    cells = grid_columns(grid)
    heads = numbered(grid, F.col(cells[0]) == header_cell, "_nth")
    last = max(n for n, _ in wanted.values())
    found = heads.filter(F.col("_nth") <= last).select(
        PART, "_nth", F.posexplode(F.array(*[F.col(c) for c in cells])).alias("_pos", "_cell")
    )
    return found.groupBy(PART).agg(
        *[
            F.min(
                F.when((F.col("_nth") == n) & F.col("_cell").contains(text), F.col("_pos") + 1)
            ).alias(name)
            for name, (n, text) in wanted.items()
        ]
    )


def pick_found(
    grid: DataFrame, found: DataFrame, names: list[str], files: int | None = None
) -> DataFrame:
    """Read each file's own columns, as located by :func:`find_columns`."""
    columns = grid_columns(grid)
    cells = F.array(*[F.col(c) for c in columns])
    return attach_to_source(grid, found, files).select(
        PART,
        ORDER,
        F.col(columns[0]).alias("c1"),
        *[F.get(cells, F.col(n) - 1).alias(n) for n in names],
    )


def read_sheets(
    spark: SparkSession, root: str, sheets: dict[str, list[str]], no_header: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """One exported folder per sheet under ``root``, keyed by folder name."""
    return {
        key: read_csv(spark, f"{root}/{key}", names, header=key not in no_header)
        for key, names in sheets.items()
    }


def sheet_name() -> Column:
    """Name of the sheet (folder) a row came from."""
    return F.element_at(F.split(PART, "/"), -2)


def attach_to_source(df: DataFrame, per_file: DataFrame, files: int | None = None) -> DataFrame:
    """Join a per-file table to the rows of each file.

    With a known number of files the table is broadcast when that is small; otherwise it reaches the
    rows through the chunks of their file, so one file may be of any size.
    """
    if files is None:
        return attach(df, per_file)
    return df.join(small_side(per_file, files), PART, "left")
