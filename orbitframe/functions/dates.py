"""Seasons, windows and dates as column expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def clamped_date(year: Column, month: Column, day: Column) -> Column:
    """The date, with a day beyond the month's end taken back to it."""
    first = F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
    return F.make_date(year.cast("int"), month.cast("int"), F.least(day.cast("int"), F.dayofmonth(F.last_day(first))))


def month_day(date: Column) -> Column:
    return F.month(date) * 100 + F.dayofmonth(date)


def in_season(date: Column, start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Whether a date lies in a yearly window of (month, day), both ends included; it may run over New Year."""
    s, e, md = start[0] * 100 + start[1], end[0] * 100 + end[1], month_day(date)
    return md.between(s, e) if e >= s else (md >= s) | (md <= e)


def in_years(date: Column, years: list[int]) -> Column:
    """Whether a date's year is listed; without a list all are."""
    return F.year(date).isin(*years) if years else F.lit(True)


def in_windows(ts: Column, years: list[int], start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Years' seasons as plain ranges of ts, which Parquet scans can skip row groups by."""
    out = F.lit(False)
    for a, b in season_windows(years, start, end):
        out = out | ts.between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"))
    return out


def window_id(ts: Column, years: list[int], start: tuple[int, int], end: tuple[int, int]) -> Column:
    """The number, from 0, of the year's season that ts lies in, null if it is in none."""
    out = F.lit(None).cast("int")
    for k, (a, b) in reversed(list(enumerate(season_windows(years, start, end)))):
        out = F.when(ts.between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz")), k).otherwise(out)
    return out


def clamp(year: int, month: int, day: int) -> dt.date:
    """clamped_date() for the driver."""
    while True:
        try:
            return dt.date(year, month, day)
        except ValueError:
            if not 28 < day <= 31:
                raise
            day -= 1


def season_windows(years: list[int], start: tuple[int, int], end: tuple[int, int]) -> list[tuple[str, str]]:
    """First and last instant (to the millisecond) of the season in each year."""
    out = []
    for y in sorted(set(years)):
        a, b = clamp(y, *start), clamp(y, *end)
        if b < a:
            raise ValueError("a window's end comes before its start")
        out.append((f"{a}T00:00:00.000", f"{b}T23:59:59.999"))
    return out


def window_table(spark: SparkSession, years: list[int], start: tuple[int, int], end: tuple[int, int]) -> DataFrame:
    """window_id, year, start_ts and end_ts; as many rows as years."""
    rows = [(i, int(a[:4]), a, b) for i, (a, b) in enumerate(season_windows(years, start, end))]
    table = spark.createDataFrame(rows, "window_id int, year int, start_ts string, end_ts string")
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_ts", "end_ts")})


def season_ranges(first_year: Column, last_year: Column, start: tuple[int, int], end: tuple[int, int]) -> Column:
    """An array of (year, start, end), ISO instants of each year's season; impossible days are errors."""
    return F.transform(
        F.sequence(first_year.cast("int"), last_year.cast("int")),
        lambda y: F.struct(
            y.alias("year"),
            F.concat(F.make_date(y, F.lit(start[0]), F.lit(start[1])).cast("string"), F.lit("T00:00:00Z")).alias("start"),
            F.concat(F.make_date(y, F.lit(end[0]), F.lit(end[1])).cast("string"), F.lit("T23:59:59Z")).alias("end"),
        ),
    )


def parse_years(text: str) -> list[int]:
    """Years in a list with commas or spaces, sorted and distinct, each from 1 to 9999."""
    years = sorted({int(x) for x in re.split(r"[,\s]+", text.strip()) if x})
    if any(not 1 <= y <= 9999 for y in years):
        raise ValueError("years go from 1 to 9999")
    return years


# How a day of the year can be written, tried in this order.
MONTH_DAY_FORMATS = ("%m-%d", "%m/%d", "%m %d", "%b-%d", "%b %d", "%B-%d", "%B %d")


def parse_month_day(text: str) -> tuple[int, int]:
    """A month and day; 29 February is refused, as it isn't in every year."""
    for f in MONTH_DAY_FORMATS:
        try:
            d = dt.datetime.strptime("1900 " + text.strip(), "%Y " + f)
            return d.month, d.day
        except ValueError:
            continue
    raise ValueError(f"not a month and day: {text!r}")
