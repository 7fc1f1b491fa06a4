"""Generated calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import as_moment


def _day_rows(bounds: DataFrame, start: Column, end: Column) -> DataFrame:
    return bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias("date"))


def calendar_days(events: DataFrame, score_cutoff: str, start: str | None = None) -> DataFrame:
    """date, year, month, year_month from the first event (or ``start``) to the day before scoring."""
    bounds = events.agg(F.to_date(F.min("event_time")).alias("first_day"))
    first = F.lit(str(as_moment(start).date())).cast("date") if start else F.col("first_day")
    last = F.date_sub(F.lit(str(as_moment(score_cutoff).date())).cast("date"), 1)
    return _day_rows(bounds, first, last).select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
    )


def calendar_hierarchy(dates: DataFrame, column: str) -> DataFrame:
    """Whole years around the dates with year, quarter, month and day levels."""
    bounds = dates.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    start = F.trunc("lo", "YEAR")
    end = F.date_sub(F.add_months(F.trunc("hi", "YEAR"), 12), 1)
    rows = _day_rows(bounds, start, end)
    return rows.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month_no"),
        F.date_format("date", "MMMM").alias("month"),
        F.quarter("date").alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter("date").cast("string")).alias("quarter"),
        F.dayofmonth("date").alias("day"),
    )
