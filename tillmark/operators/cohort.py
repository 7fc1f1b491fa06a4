"""Cohort retention by month of first sale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import as_moment
from ..functions.dates import moment, month_number, month_text


def cohort_retention(events: DataFrame, cutoff: str) -> DataFrame:
    """Active customers per cohort and age, dense over complete months only.

    Age runs to the month before the cutoff's month; an empty cell inside that
    span is 0, later cells are absent. A customer's sale months are a set of at
    most one entry per calendar month, so one shuffle by customer is enough.
    """
    end = as_moment(cutoff)
    last_complete = end.year * 12 + end.month - 2
    sale_months = (
        events.where((F.col("event_type") == "sale") & (F.col("event_time") < moment(cutoff)))
        .groupBy("customer_id")
        .agg(F.collect_set(month_number(F.col("event_time"))).alias("months"))
        .select(F.array_min("months").alias("cohort_month"), "months")
    )
    counts = (
        sale_months.select("cohort_month", F.explode("months").alias("month"))
        .groupBy("cohort_month", (F.col("month") - F.col("cohort_month")).alias("month_index"))
        .agg(F.count("*").alias("active"))
    )
    # Everybody is active at age 0, so that cell is the cohort size. From here on
    # there is one row per pair of calendar months.
    per_cohort = counts.groupBy("cohort_month").agg(
        F.max(F.when(F.col("month_index") == 0, F.col("active"))).alias("cohort_size"),
        F.map_from_entries(F.collect_list(F.struct("month_index", "active"))).alias("cells"),
    )
    age = F.explode(F.sequence(F.lit(0), F.lit(last_complete) - F.col("cohort_month"))).alias("month_index")
    dense = per_cohort.where(F.col("cohort_month") <= last_complete).select("cohort_month", "cohort_size", "cells", age)
    active = F.coalesce(F.try_element_at("cells", F.col("month_index")), F.lit(0)).cast("bigint")
    return dense.select(
        month_text(F.col("cohort_month")).alias("cohort"),
        "month_index",
        "cohort_size",
        active.alias("active_customers"),
        (active / F.col("cohort_size")).alias("retention_rate"),
    )


def calendar_ages(start: str, cutoff: str) -> range:
    """All ages that a cohort from ``start`` on can have in complete months before the cutoff's month."""
    first, end = as_moment(start), as_moment(cutoff)
    return range(max(0, (end.year - first.year) * 12 + end.month - first.month))


def cohort_matrix(retention: DataFrame, ages: Sequence[int] | None = None) -> DataFrame:
    """Cohorts as rows, ages as columns ``age_n``; cells that do not exist stay null.

    Without ``ages`` every age from 0 to the largest in the table gets a column.
    """
    if ages is None:
        oldest = retention.agg(F.max("month_index")).first()[0]
        ages = range(0 if oldest is None else oldest + 1)
    wide = retention.groupBy("cohort").pivot("month_index", list(ages)).agg(F.max("retention_rate"))
    return wide.select("cohort", *[F.col(str(age)).alias(f"age_{age}") for age in ages])
