"""Recency, frequency and money scores with rule-based segments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import rows_at_ranks

# Segment names of the margin track, in rule order, then the default.
FIXED_SEGMENTS = (
    "Şampiyon", "Geri kazanım adayı", "Yeni müşteri", "Sadık müşteri", "İlgi gerekiyor", "Gelişen müşteri",
)
# Segment names of the revenue track, in rule order, then the default.
QUINTILE_SEGMENTS = (
    "Champions", "Win-back candidates", "New customers", "Loyal customers", "Needs attention",
    "Developing customers",
)


@dataclass(frozen=True)
class Thresholds:
    """Limits for the scores 5, 4, 3 and 2; anything else scores 1."""

    recency: Sequence[float] = (15, 30, 60, 90)
    frequency: Sequence[float] = (18, 10, 5, 2)
    money: Sequence[float] = (25000, 12000, 6000, 1500)


def _graded(tests: Sequence[Column]) -> Column:
    score = F.when(tests[0], 5)
    for points, test in zip((4, 3, 2), tests[1:]):
        score = score.when(test, points)
    return score.otherwise(1)


def _named(rules: Sequence[Column], names: Sequence[str]) -> Column:
    label = F.when(rules[0], names[0])
    for rule, name in zip(rules[1:], names[1:]):
        label = label.when(rule, name)
    return label.otherwise(names[-1])


def _rfm_text() -> Column:
    return F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")])


def fixed_segments(features: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Scores by fixed limits, comparable across runs."""
    recency, frequency, money = F.col("recency_days"), F.col("frequency_365"), F.col("net_revenue_365")
    scored = (
        features.withColumn("r_score", _graded([recency <= x for x in limits.recency]))
        .withColumn("f_score", _graded([frequency >= x for x in limits.frequency]))
        .withColumn("m_score", _graded([money >= x for x in limits.money]))
        .withColumn("rfm_score", _rfm_text())
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    rules = [
        (r >= 4) & (f >= 4) & (m >= 4),
        (recency > 90) & (f >= 3),
        (F.col("tenure_days") <= 60) & (frequency <= 2),
        (f >= 4) & (recency <= 90),
        recency > 60,
    ]
    return scored.withColumn("segment", _named(rules, FIXED_SEGMENTS))


def quintile(df: DataFrame, value: str, key: str = "customer_id", reverse: bool = False) -> Column:
    """Score 1..5 by rank of ``value``, ties in ``key`` order, as a plain expression.

    Only the four rows at the bucket limits are looked up (by a distributed
    rank over the two narrow columns); scoring is then a comparison with
    literals and needs neither a join nor an order.
    """

    def limits(rows: int) -> list[int]:
        return [1 + k * (rows - 1) // 5 for k in range(1, 5)] if rows >= 5 else []

    total, found = rows_at_ranks(df.select(value, key), [F.col(value), F.col(key)], limits)
    if total < 5:
        return F.lit(3)
    score = F.lit(1)
    for rank in limits(total):
        bound, bound_key = F.lit(found[rank][value]), F.lit(found[rank][key])
        above = (F.col(value) > bound) | ((F.col(value) == bound) & (F.col(key) > bound_key))
        score = score + above.cast("int")
    return F.lit(6) - score if reverse else score


def quintile_segments(features: DataFrame) -> DataFrame:
    """Scores by quintile within one snapshot, then rule segments."""
    scored = features.withColumns(
        {
            "r_score": quintile(features, "recency_days", reverse=True),
            "f_score": quintile(features, "frequency_365"),
            "m_score": quintile(features, "net_revenue_365"),
        }
    ).withColumn("rfm_score", _rfm_text())
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    rules = [
        (r >= 4) & (f >= 4) & (m >= 4),
        (r <= 2) & (f >= 4),
        (F.col("tenure_days") <= 90) & (F.col("frequency_365") <= 2),
        (f >= 4) & (r >= 3),
        r <= 2,
    ]
    return scored.withColumn("segment", _named(rules, QUINTILE_SEGMENTS))
