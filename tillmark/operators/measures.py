"""Business measures: named aggregates usable under any grouping.

A measure is a ``Column`` to put into ``groupBy(...).agg(...)``. Sales measures
read a fact table with ``event_type``, ``order_id``, ``customer_id`` and
whole-number money; score measures read a score table. Filters on scores never
reach the fact table: the two are aggregated apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import from_minor, ratio, sum_minor


def _is(kind: str) -> Column:
    return F.col("event_type") == kind


def net_revenue(digits: int = 2) -> Column:
    return from_minor(sum_minor(F.col("net_minor")), digits)


def gross_margin() -> Column:
    return from_minor(sum_minor(F.col("margin_minor")))


def margin_rate() -> Column:
    return ratio(sum_minor(F.col("margin_minor")), sum_minor(F.col("net_minor")))


def sale_orders() -> Column:
    return F.count_distinct(F.when(_is("sale"), F.col("order_id")))


def purchasing_customers() -> Column:
    return F.count_distinct(F.when(_is("sale"), F.col("customer_id")))


def net_average_order_value(digits: int = 2) -> Column:
    return ratio(net_revenue(digits), sale_orders())


def return_value(digits: int = 2) -> Column:
    return from_minor(-sum_minor(F.col("net_minor"), _is("return")), digits)


def gross_sale_value(digits: int = 2) -> Column:
    return from_minor(sum_minor(F.col("net_minor"), _is("sale")), digits)


def return_value_rate() -> Column:
    return ratio(-sum_minor(F.col("net_minor"), _is("return")), sum_minor(F.col("net_minor"), _is("sale")))


def single_snapshot(measure: Column) -> Column:
    """Blank unless the rows belong to exactly one snapshot date."""
    return F.when(F.count_distinct("snapshot_date") == 1, measure)


def scored_customers() -> Column:
    return single_snapshot(F.count_distinct("customer_id"))


def average_risk() -> Column:
    return single_snapshot(F.avg("inactive_risk90"))


def expected_value(column: str = "expected_margin90") -> Column:
    return single_snapshot(F.sum(column))


def ltv_total() -> Column:
    return single_snapshot(F.sum("ltv_3year_scenario"))


def high_risk_customers(limit: float = 0.5) -> Column:
    return single_snapshot(F.count_distinct(F.when(F.col("inactive_risk90") >= limit, F.col("customer_id"))))


def average_recency() -> Column:
    return single_snapshot(F.avg("recency_days"))


def activation_eligible_customers() -> Column:
    return F.count_distinct(F.when(F.col("activation_eligible"), F.col("customer_id")))


def metric_value(metric: str, column: str = "value") -> Column:
    """A value of a long metric table (model or quality mart)."""
    return F.max(F.when(F.col("metric") == metric, F.col(column)))


def mae_improvement(metric: str = "revenue_mae") -> Column:
    model, baseline = metric_value(metric), metric_value(metric, "baseline")
    return ratio(baseline - model, baseline)


def repeat_purchase_rate(facts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Buyers with at least two sale orders over all buyers, counted per customer.

    Orders are made distinct first and customers second; both steps combine
    before their shuffle.
    """
    per_customer = (
        facts.where(_is("sale"))
        .groupBy(*by, "customer_id")
        .agg(F.count_distinct("order_id").alias("orders"))
    )
    repeat = F.count(F.when(F.col("orders") >= 2, 1))
    return per_customer.groupBy(*by).agg(
        F.count("*").alias("buyers"),
        repeat.alias("repeat_buyers"),
        ratio(repeat, F.count("*")).alias("repeat_purchase_rate"),
    )


# Display names of the report contract, revenue track (money in 4 digits).
REVENUE_MEASURES = {
    "Net Revenue": lambda: net_revenue(4),
    "Sale Orders": sale_orders,
    "Purchasing Customers": purchasing_customers,
    "Net Average Order Value": lambda: net_average_order_value(4),
    "Return Value": lambda: return_value(4),
    "Gross Sale Value": lambda: gross_sale_value(4),
    "Return Value Rate": return_value_rate,
    "Scored Customers": scored_customers,
    "Average 90D Inactivity Risk": average_risk,
    "Expected 90D Revenue": lambda: expected_value("expected_revenue90"),
    "High-Risk Customers": high_risk_customers,
    "Average Customer Recency": average_recency,
    "Activation-Eligible Customers": activation_eligible_customers,
    "Held-out Average Precision": lambda: metric_value("average_precision"),
    "Held-out ROC-AUC": lambda: metric_value("roc_auc"),
    "Held-out Top-20% Lift": lambda: metric_value("lift_at_20pct"),
    "Held-out Revenue MAE": lambda: metric_value("revenue_mae"),
    "Revenue MAE Improvement": mae_improvement,
    "Accepted Transaction Rows": lambda: metric_value("accepted_rows"),
    "Quarantined Transaction Rows": lambda: metric_value("quarantined_rows"),
    "Data Reconciliation Passed": lambda: metric_value("reconciled"),
}
# Display names of the margin track; the repeat rate is a table function above.
MARGIN_MEASURES = {
    "Net Ciro": net_revenue,
    "Brut Kar": gross_margin,
    "Brut Kar Orani": margin_rate,
    "Satis Siparisi": sale_orders,
    "Alisveris Yapan Musteri": purchasing_customers,
    "Net Ortalama Sepet": net_average_order_value,
    "Iade Tutari": return_value,
    "Satis Tutari": gross_sale_value,
    "Iade Tutar Orani": return_value_rate,
    "Skorlanan Musteri": scored_customers,
    "Ortalama 90 Gun Risk": average_risk,
    "Beklenen 90 Gun Brut Kar": expected_value,
    "LTV 3 Yil Senaryosu": ltv_total,
    "Yuksek Risk Musteri": high_risk_customers,
}
