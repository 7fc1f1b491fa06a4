"""Exact-duplicate removal as aggregations, so copies collapse before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(df: DataFrame, copies: str | None = None) -> DataFrame:
    """Whole-row duplicates; the survivor is immaterial. ``copies`` names a column for the number of equal rows."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(copies)) if copies else df.distinct()


def keep_first(df: DataFrame, subset: Sequence[str], position: str, copies: str | None = None) -> DataFrame:
    """The row with the lowest ``position`` among rows equal on ``subset``; nulls equal each other.

    ``copies`` names a column for the number of equal rows.
    """
    rest = [c for c in df.columns if c not in subset and c != position]
    first = [F.min(position).alias(position)]
    if copies:
        first.append(F.count("*").alias(copies))
    if rest:
        first.append(F.min_by(F.struct(*rest), F.col(position)).alias("_rest"))
    kept = df.groupBy(*subset).agg(*first)
    return kept.select(*subset, position, *([copies] if copies else []), *[F.col("_rest")[c].alias(c) for c in rest])
