"""Date and time parsing.

All times are wall-clock times, held as TIMESTAMP_NTZ, so no session time zone can shift them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import ColumnOrName, as_col
from .numbers import as_number
from .text import capture

# Prefix of a publishing date.
PUBLISHED_PREFIX = "发布于 "
# Date, optionally with a time, once separators are unified.
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{2}(:\d{2})?)?$"
# Weekday names, Monday first.
WEEKDAYS = ("周一", "周二", "周三", "周四", "周五", "周六", "周日")

DAY_SECONDS = 86400


def ntz(value) -> Column:
    """Literal or text as a wall-clock time."""
    c = value if isinstance(value, Column) else F.lit(str(value))
    return c.cast("timestamp_ntz")


def parse_ts(c: ColumnOrName) -> Column:
    """Any accepted date or time text, else NULL.

    Accepted are ``yyyy-MM-dd``, ``yyyy/M/d``, ``yyyyMMdd`` and ``yyyy年M月d日``, each with an optional
    ``HH:mm[:ss]``.  The text is brought to one form and cast once: a cast that fails costs nothing,
    while every failed format would raise and catch an error per row.
    """
    c = as_col(c)
    t = F.regexp_replace(c, "^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    t = F.regexp_replace(F.translate(t, "/年月", "---"), "日", "")
    # The common form needs no rewriting.
    return F.when(c.rlike(_ISO), c.try_cast("timestamp_ntz")).when(
        t.rlike(_ISO), t.try_cast("timestamp_ntz")
    )


def parse_published(c: ColumnOrName) -> Column:
    """``发布于 2024-01-30`` to a time."""
    c = as_col(c)
    return F.when(c.startswith(PUBLISHED_PREFIX), parse_ts(F.replace(c, F.lit(PUBLISHED_PREFIX), F.lit(""))))


def ts_text(c: ColumnOrName) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd HH:mm:ss")


def excel_serial(c: ColumnOrName) -> Column:
    """Spreadsheet serial day, number or text, to a time (44927 is 2023-01-01)."""
    seconds = F.round((as_number(c) - F.lit(44927)) * DAY_SECONDS, 3).cast("decimal(18,6)")
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.lit("2023-01-01 00:00:00").cast("timestamp_ntz") + step


def make_ts(year: Column, month: Column, day: Column) -> Column:
    """Midnight of a date given in parts; impossible parts become NULL."""
    text = F.concat(
        F.lpad(year.cast("string"), 4, "0"),
        F.lit("-"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lit("-"),
        F.lpad(day.cast("string"), 2, "0"),
    )
    return text.try_cast("timestamp_ntz")


def season_year(month: Column, last_early_month: int = 3, base: int = 2023) -> Column:
    """Year of a season that starts in ``base``: late months are that year, early ones the next."""
    return F.when(month > last_early_month, F.lit(base)).otherwise(F.lit(base + 1))


def dot_date(c: ColumnOrName, ref_year: int | None = None) -> Column:
    """``MM.DD`` (or ``M.D``) to a date, with a given year or the season year."""
    pattern = r"(\d+)\.(\d+)"
    month, day = capture(c, pattern, 1).cast("int"), capture(c, pattern, 2).cast("int")
    year = F.lit(ref_year) if ref_year else season_year(month)
    return make_ts(year, month, day)


def month_day(c: ColumnOrName, year: int | None = None) -> Column:
    """``MM-DD`` to a date, with a given year or the season year."""
    pattern = r"^(\d{2})-(\d{2})$"
    month, day = capture(c, pattern, 1).cast("int"), capture(c, pattern, 2).cast("int")
    return make_ts(F.lit(year) if year else season_year(month), month, day)


def zh_minute(c: ColumnOrName) -> Column:
    """``2024年3月22日 20:00`` to a time."""
    return parse_ts(c)


def session_from(c: ColumnOrName, pattern: str) -> Column:
    """Session time from captures (date, hour, minute) or (date, hour:minute) of a pattern.

    One replacement rewrites the text; captures taken one by one would match it again each time.
    """
    c = as_col(c)
    groups = pattern.replace(r"\(", "").count("(")
    clock = ":".join(f"${g}" for g in range(2, groups + 1))
    text = F.regexp_replace(c, f"^(?s:.*?){pattern}(?s:.*)$", f"$1 {clock}")
    return F.when(c.rlike(pattern), text.try_cast("timestamp_ntz"))


def normalize_session(c: ColumnOrName) -> Column:
    """Any accepted session text as ``yyyy-MM-dd HH:mm:ss``."""
    return ts_text(parse_ts(c))


def last_monday(c: ColumnOrName) -> Column:
    """The Monday on or before a date."""
    return F.date_sub(F.next_day(as_col(c).cast("date"), "Mon"), 7)


def this_sunday(c: ColumnOrName) -> Column:
    """The Sunday on or after a date."""
    return F.next_day(F.date_sub(as_col(c).cast("date"), 1), "Sun")


def zh_weekday(c: ColumnOrName) -> Column:
    names = F.array(*[F.lit(w) for w in WEEKDAYS])
    return F.element_at(names, F.weekday(as_col(c)) + 1)


def between(c: ColumnOrName, start=None, end=None) -> Column:
    """Half-open window ``[start, end)``; a missing bound is open.

    The bounds are literals of the column's own type so that the filter reaches the scan.
    """
    c = as_col(c)
    cond = c.isNotNull()
    if start is not None:
        cond = cond & (c >= ntz(start))
    if end is not None:
        cond = cond & (c < ntz(end))
    return cond


def day_window(c: ColumnOrName, day: str) -> Column:
    """The whole of one day."""
    start = ntz(day)
    return (as_col(c) >= start) & (as_col(c) < start + F.expr("INTERVAL 1 DAY"))
