"""Day arithmetic on zone-less timestamps."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def moment(value: str | date | datetime) -> Column:
    """Literal zone-less timestamp; a plain date means its midnight."""
    parsed = datetime.fromisoformat(str(value))
    return F.expr(f"TIMESTAMP_NTZ'{parsed.isoformat(sep=' ')}'")


def days(count: int) -> Column:
    return F.expr(f"INTERVAL '{int(count)}' DAY")


def days_between(start: Column, end: Column) -> Column:
    """Fractional days."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(float(MICROS_PER_DAY))


def month_number(when: Column) -> Column:
    """Months since year 0, so that differences are ages in months."""
    return (F.year(when) * 12 + F.month(when) - 1).cast("int")


def month_text(number: Column) -> Column:
    """Inverse of :func:`month_number` as ``yyyy-MM``."""
    year = F.floor(number / 12).cast("int")
    return F.format_string("%04d-%02d", year, (number % 12 + 1).cast("int"))


def year_month(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM")
