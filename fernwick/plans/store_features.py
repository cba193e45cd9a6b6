"""Feature table of store days: joins, calendar fields, days open, promotion windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernwick.functions import dates as D
from fernwick.operators import relational as R
from fernwick.operators import windows as W

# Fillers of unknown opening dates, the first plausible year, and the caps.
UNKNOWN_YEAR, UNKNOWN_PART, FIRST_YEAR, MONTHS_CAP, WEEKS_CAP = 1900, 1, 1990, 24, 25


def open_days(date: Column, since: Column, since_year: Column) -> Column:
    """Days since the opening; 0 before it and where the year is not plausible."""
    days = D.days_between(date, since)
    return F.when((days < 0) | (since_year < FIRST_YEAR), 0).otherwise(days)


def store_features(days: DataFrame, stores: DataFrame) -> DataFrame:
    """``days`` is ``(store, date, sales, promo)`` with one row per store and day; ``stores`` is
    ``(store, name, region, open_year, open_month, promo_year, promo_week)``.

    One sort per store serves all four window features.
    """
    chunked = W.needs_chunks(days, ["store"])
    flagged = days.withColumn("promo_n", F.col("promo").cast("int"))
    promo = F.col("promo")
    out = W.days_since_last(flagged, promo, ["store"], "date", "date", "after_promo", chunked=chunked)
    out = W.days_until_next(out, promo, ["store"], "date", "date", "before_promo", chunked=chunked)
    out = W.rolling_sum_trailing(out, ["promo_n"], ["store"], ["date"], chunked=chunked)
    out = W.rolling_sum_leading(out, ["promo_n"], ["store"], ["date"], chunked=chunked)
    joined = R.join_df(out, stores, "store")
    filled = joined.withColumns({
        **{c: R.fill_constant(c, UNKNOWN_YEAR) for c in ("open_year", "promo_year")},
        **{c: R.fill_constant(c, UNKNOWN_PART) for c in ("open_month", "promo_week")}})
    date = F.col("date")
    opened = open_days(date, D.date_from_parts(F.col("open_year"), F.col("open_month")), F.col("open_year"))
    promoted = open_days(date, D.iso_week_monday(F.col("promo_year"), F.col("promo_week")), F.col("promo_year"))
    aged = filled.withColumns({"days_open": opened, "promo_days": promoted}).withColumns({
        "months_open": R.bucket_and_cap(F.col("days_open"), 30, MONTHS_CAP),
        "promo_weeks": R.bucket_and_cap(F.col("promo_days"), 7, WEEKS_CAP)})
    return R.filter_rows(D.add_datepart(aged, "date", drop=False), F.col("sales") != 0)
