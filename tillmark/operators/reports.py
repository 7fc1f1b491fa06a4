"""Report queries over the fact, score and cohort tables.

Where a report groups by a product attribute, lines are summed per product
first, so the product join sees one row per product and not one per line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import moment, month_number, month_text
from ..functions.money import from_minor, ratio, wide_sum
from . import measures as m


def _period(start: str, end: str) -> Column:
    return (F.col("event_time") >= moment(start)) & (F.col("event_time") < moment(end))


def monthly_performance(events: DataFrame, by_channel: bool = False) -> DataFrame:
    """Net revenue, margin, sale orders and buyers per month (and channel).

    Returns count in the month they happen.
    """
    keys = ["channel"] if by_channel else []
    # Grouping by a month number; the text is made once per result row.
    per_month = events.groupBy(month_number(F.col("event_time")).alias("_month"), *keys).agg(
        m.net_revenue().alias("net_revenue"),
        m.gross_margin().alias("gross_margin"),
        m.sale_orders().alias("sale_orders"),
        m.purchasing_customers().alias("purchasing_customers"),
    )
    return per_month.select(month_text(F.col("_month")).alias("year_month"), *per_month.columns[1:])


def monthly_revenue(events: DataFrame) -> DataFrame:
    per_month = events.groupBy(month_number(F.col("event_time")).alias("_month")).agg(
        m.net_revenue().alias("net_revenue"), m.gross_margin().alias("gross_margin")
    )
    return per_month.select(month_text(F.col("_month")).alias("month"), "net_revenue", "gross_margin")


def by_product_attribute(events: DataFrame, products: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Net revenue and margin per product attribute combination, best first."""
    per_product = events.groupBy("product_id").agg(
        wide_sum(F.col("net_minor")).alias("net_minor"), wide_sum(F.col("margin_minor")).alias("margin_minor")
    )
    joined = per_product.join(products.select("product_id", *attributes), "product_id")
    return (
        joined.groupBy(*attributes)
        .agg(
            from_minor(F.sum("net_minor")).alias("net_revenue"),
            from_minor(F.sum("margin_minor")).alias("gross_margin"),
        )
        .orderBy(F.desc("net_revenue"), *attributes)
    )


def top_products(events: DataFrame, products: DataFrame, count: int = 8) -> DataFrame:
    """Products of highest net revenue in that order, lowest id first on ties; unknown products have no name."""
    per_product = events.groupBy("product_id").agg(wide_sum(F.col("net_minor")).alias("net_minor"))
    best = per_product.orderBy(F.desc("net_minor"), "product_id").limit(count)
    named = best.join(products.select("product_id", "product_name"), "product_id", "left").orderBy(F.desc("net_minor"), "product_id")
    return named.select("product_id", "product_name", from_minor(F.col("net_minor")).alias("net_revenue"))


def portfolio_totals(events: DataFrame) -> DataFrame:
    """Net revenue, margin, sale orders and lines of the whole table."""
    per_order = events.groupBy("order_id").agg(
        F.sum("net_minor").alias("net_minor"),
        F.sum("margin_minor").alias("margin_minor"),
        F.max(F.when(F.col("event_type") == "sale", 1).otherwise(0)).alias("sold"),
        F.count("*").alias("lines"),
    )
    return per_order.agg(
        (wide_sum(F.col("net_minor")).cast("double") / 100).alias("net_revenue"),
        (wide_sum(F.col("margin_minor")).cast("double") / 100).alias("gross_margin"),
        F.sum("sold").alias("sale_orders"),
        F.sum("lines").alias("event_lines"),
    )


def repeat_customer_share(events: DataFrame, start: str, end: str) -> DataFrame:
    """Customers with two or more sale orders in the period."""
    rated = m.repeat_purchase_rate(events.where(_period(start, end)))
    return rated.select(
        F.col("buyers").alias("purchasing_customers"),
        F.col("repeat_buyers").alias("repeat_customers"),
        F.col("repeat_purchase_rate").alias("repeat_share"),
    )


def omnichannel_buyers(events: DataFrame, start: str, end: str, channels: int = 2) -> DataFrame:
    """Customers who bought through that many channels in the period."""
    per_customer = (
        events.where(_period(start, end) & (F.col("event_type") == "sale"))
        .groupBy("customer_id")
        .agg(F.count_distinct("channel").alias("channels"))
    )
    return per_customer.agg(
        F.count("*").alias("buyers"),
        F.count(F.when(F.col("channels") == channels, 1)).alias("omnichannel_buyers"),
    )


def sales_star(events: DataFrame, customers: DataFrame, products: DataFrame, calendar: DataFrame) -> DataFrame:
    """Facts with their customer, product and calendar columns (many-to-one, one direction)."""
    return (
        events.withColumn("event_date", F.to_date("event_time"))
        .join(customers, "customer_id")
        .join(products, "product_id")
        .join(calendar.withColumnRenamed("date", "event_date"), "event_date")
    )


def segment_counts(scores: DataFrame) -> DataFrame:
    return scores.groupBy("segment").agg(m.scored_customers().alias("customers")).orderBy(F.desc("customers"), "segment")


def latest_snapshot(scores: DataFrame) -> DataFrame:
    """Rows of the most recent snapshot date, found by a scalar subquery.

    Values of different snapshot dates are never added up.
    """
    newest = scores.agg(F.max("snapshot_date")).scalar()
    return scores.where(F.col("snapshot_date") == newest)


def at_snapshot(scores: DataFrame, date: str | None = None) -> DataFrame:
    """The slicer of the score pages: rows of one snapshot date, the most recent one unless named."""
    return latest_snapshot(scores) if date is None else scores.where(F.col("snapshot_date") == F.lit(date).cast("date"))


def headline_cards(events: DataFrame) -> DataFrame:
    """The four cards over all channels: revenue, sale orders, purchasing customers, return rate.

    Orders and customers are told apart in aggregates of their own keys, so no line is copied for a distinct count.
    """
    sale, net = F.col("event_type") == "sale", F.col("net_minor")
    returned, sold = F.when(F.col("event_type") == "return", -net).otherwise(0), F.when(sale, net).otherwise(0)
    per_order = events.groupBy("order_id", "customer_id").agg(
        F.sum("net_minor").alias("net"), F.sum(returned).alias("returned"), F.sum(sold).alias("sold"),
        F.max(F.when(sale, 1).otherwise(0)).alias("bought"),
    )
    sums = [wide_sum(F.col(c)).alias(c) for c in ("net", "returned", "sold")]
    orders = per_order.groupBy("order_id").agg(*sums, F.max("bought").alias("bought"))
    buyers = per_order.where("bought = 1").select("customer_id").distinct().agg(F.count("customer_id").alias("purchasing_customers"))
    totals = orders.agg(*sums, F.sum("bought").alias("sale_orders"))
    both = totals.unionByName(buyers, allowMissingColumns=True)
    whole = both.agg(*[F.sum(c).alias(c) for c in both.columns])
    return whole.select(
        from_minor(F.col("net")).alias("net_revenue"), "sale_orders", "purchasing_customers",
        ratio(F.col("returned"), F.col("sold")).alias("return_value_rate"),
    )


def metric_labels(mart: DataFrame) -> DataFrame:
    """Value and baseline per label of the model mart, by label."""
    return mart.groupBy("label").agg(F.sum("value").alias("value"), F.sum("baseline").alias("baseline")).orderBy("label")


def quality_labels(mart: DataFrame) -> DataFrame:
    """Value per label of the quality mart, largest first."""
    return mart.groupBy("label").agg(F.sum("value").alias("value")).orderBy(F.desc("value"), "label")


def segment_value_latest(scores: DataFrame, value: str = "expected_margin90") -> DataFrame:
    return (
        latest_snapshot(scores)
        .groupBy("segment")
        .agg(
            F.count("*").alias("customers"),
            F.avg("inactive_risk90").alias("average_risk"),
            F.sum(value).alias(value),
        )
        .orderBy(F.desc(value), "segment")
    )


def customer_360(scores: DataFrame, customers: DataFrame) -> DataFrame:
    """Score rows with the customer dimension."""
    return scores.join(customers, "customer_id")


def customer_search(scores: DataFrame, segment: str | None = None, text: str = "", min_risk: float = 0.0) -> DataFrame:
    """Customers of a segment whose id contains ``text`` (any case), riskiest first."""
    found = scores.where(F.col("inactive_risk90") >= min_risk)
    if segment:
        found = found.where(F.col("segment") == segment)
    needle = text.strip().lower()
    if needle:
        found = found.where(F.lower(F.col("customer_id").cast("string")).contains(needle))
    return found.orderBy(F.desc("inactive_risk90"), "customer_id")


def top_risk_customers(scores: DataFrame, count: int = 200) -> DataFrame:
    return scores.orderBy(F.desc("inactive_risk90"), "customer_id").limit(count)


def customer_detail(scores: DataFrame) -> DataFrame:
    """Per customer and segment sums of recency, orders, revenue and risk."""
    return scores.groupBy("customer_id", "segment").agg(
        F.sum("recency_days").alias("recency_days"),
        F.sum("frequency_365").alias("frequency_365"),
        F.sum("net_revenue_365").alias("net_revenue_365"),
        F.sum("inactive_risk90").alias("inactive_risk90"),
    ).orderBy(F.desc("inactive_risk90"), "customer_id", "segment")


def scatter(scores: DataFrame, x: str, y: str, size: str | None = None, color: str | None = None, by: str | None = None) -> DataFrame:
    """One point per customer (and value of ``by``): summed axes and size, average color, lowest segment name."""
    columns = [F.min("segment").alias("segment"), F.sum(x).alias(x), F.sum(y).alias(y)]
    if size:
        columns.append(F.sum(size).alias(size))
    if color:
        columns.append(F.avg(color).alias(color))
    return scores.groupBy("customer_id", *([by] if by else [])).agg(*columns)


def campaign_group_counts(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("experiment_group").agg(F.count("*").alias("customers"))
