"""Calendar expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def elapsed_seconds(col: str | Column) -> Column:
    """Seconds since 1970-01-01 of the wall-clock time."""
    c = _c(col)
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def date_fields(col: str | Column, time: bool = False) -> dict[str, Column]:
    """The calendar fields by name; weeks are ISO weeks, Monday is day 0."""
    c = _c(col)
    d = c.cast("date")
    month, day = F.month(d), F.dayofmonth(d)
    month_end = d == F.last_day(d)
    # The names of the calendar fields.
    fields = {
        "Year": F.year(d), "Month": month, "Week": F.weekofyear(d), "Day": day,
        "Dayofweek": F.weekday(d), "Dayofyear": F.dayofyear(d),
        "Is_month_end": month_end, "Is_month_start": day == 1,
        "Is_quarter_end": month_end & (month % 3 == 0),
        "Is_quarter_start": (day == 1) & (month % 3 == 1),
        "Is_year_end": (month == 12) & (day == 31), "Is_year_start": (month == 1) & (day == 1),
    }
    if time:
        fields |= {"Hour": F.hour(c), "Minute": F.minute(c), "Second": F.second(c)}
    fields["Elapsed"] = elapsed_seconds(c)
    return fields


def add_datepart(df: DataFrame, fld: str, drop: bool = True, time: bool = False) -> DataFrame:
    """Replace a date column by its calendar fields, named after it without a final ``Date``."""
    prefix = re.sub("[Dd]ate$", "", fld)
    out = df.withColumns({prefix + n: c for n, c in date_fields(fld, time).items()})
    return out.drop(fld) if drop else out


def combine_date(years, months=1, days=1, weeks=None, hours=None, minutes=None, seconds=None,
                 milliseconds=None, microseconds=None, nanoseconds=None) -> Column:
    """Timestamp from parts; parts beyond their usual range carry over."""
    def col(v, default=0):
        return F.lit(default) if v is None else (v if isinstance(v, Column) else F.lit(v))

    micros = (col(seconds).cast("long") * 1_000_000 + col(milliseconds).cast("long") * 1_000
              + col(microseconds).cast("long") + F.floor(col(nanoseconds) / 1000))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (start
            + F.make_ym_interval((col(years) - 1970).cast("int"), (col(months) - 1).cast("int"))
            + F.make_dt_interval((col(days) - 1 + col(weeks) * 7).cast("int"), col(hours).cast("int"),
                                 col(minutes).cast("int"),
                                 (micros / F.lit(1_000_000)).cast("decimal(18,6)")))


def days_between(a: str | Column, b: str | Column) -> Column:
    """Whole days from ``b`` to ``a``."""
    return F.datediff(_c(a).cast("date"), _c(b).cast("date"))


def date_from_parts(year: Column, month: Column, day: int = 15) -> Column:
    return F.make_date(year, month, F.lit(day))


def iso_week_monday(year: Column, week: Column) -> Column:
    """Monday of the ISO week: the week that holds 4 January is week 1."""
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    return F.date_add(first, ((week - 1) * 7).cast("int"))


def parse_date(col: str | Column, formats: Sequence[str]) -> Column:
    """Timestamp by the first format that fits; null if none does."""
    c = _c(col)
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")
