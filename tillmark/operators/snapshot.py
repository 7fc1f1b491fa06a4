"""Leakage-safe customer snapshots and forward labels, all cutoffs together.

Features of a cutoff see ``[cutoff - 365 d, cutoff)`` and labels see
``[cutoff, cutoff + 90 d)``. Every event is copied to the few cutoffs whose
windows hold it. A sale outside all windows gives one lifetime row that only
serves the date of the first purchase, so the copies stay bounded however long
the history is.

Copies are summed per (cutoff, customer, order) first, with the set of what the
order sold. Where the events come out of a join on the order key, this step keeps
the join's partitioning. The orders are written once and read twice: their sums
are added up per customer, and their distinct products per customer are joined
with the product table to count categories and brands. So lines are read and moved
once, never by product; what moves by product is one row per cutoff, customer and
product.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    ACTIVE_DAYS,
    HISTORY_DAYS,
    HORIZON_DAYS,
    RECENT_DAYS,
    as_moment,
    require_complete_follow_up,
)
from ..functions.dates import days, days_between, moment
from ..functions.money import from_minor, ratio
from ..session import stored

_LIFETIME = "0001-01-01"
_SHARED = [
    "recency_days", "tenure_days", "frequency_365", "frequency_90", "frequency_previous90",
    "net_revenue_365", "net_revenue_90",
]


@dataclass(frozen=True)
class Track:
    """What differs between margin data and revenue-only data."""

    name: str
    digits: int
    features: tuple[str, ...]
    value_column: str
    value_label: str


MARGIN = Track(
    "margin", 2,
    (*_SHARED, "gross_margin_365", "average_order_value", "category_count", "brand_count",
     "online_share", "discount_share", "return_unit_rate", "order_trend"),
    "margin_minor", "margin_next90",
)
REVENUE = Track(
    "revenue", 4,
    (*_SHARED, "average_order_value", "product_count", "units_365", "return_value_rate", "order_trend"),
    "net_minor", "revenue_next90",
)
INACTIVE_LABEL = "inactive_next90"


def _by_cutoff(events: DataFrame, cutoffs: Sequence[str], before: int, after: int, lifetime: bool) -> DataFrame:
    """One row per event and cutoff with the event in ``[cutoff - before, cutoff + after)`` days."""
    time = F.col("event_time")
    windows = [(time >= moment(c) - days(before)) & (time < moment(c) + days(after)) for c in cutoffs]
    copies = [F.when(window, moment(c)) for window, c in zip(windows, cutoffs)]
    first, last = min(cutoffs, key=as_moment), max(cutoffs, key=as_moment)
    # Plain bounds as well: they reach the scan, the copies do not.
    events = events.where(time < moment(last) + days(after))
    if lifetime:
        outside = ~reduce(Column.__or__, windows)
        copies.append(F.when(outside & (F.col("event_type") == "sale"), moment(_LIFETIME)))
    else:
        events = events.where(time >= moment(first) - days(before))
    return events.withColumn("cutoff", F.explode(F.array(*copies))).where(F.col("cutoff").isNotNull())


def _variety(orders: DataFrame, facets: dict[str, str], products: DataFrame | None) -> DataFrame:
    """Distinct values of each facet column among what the orders of the history window sold.

    Facets of ``products`` are looked up after a customer's products are distinct.
    The sets are as long as there are categories or brands, and a product counts itself.
    """
    sold = orders.select("cutoff", "customer_id", F.explode("sold").alias("sold")).select("cutoff", "customer_id", "sold.*").distinct()
    if products is not None:
        sold = sold.join(products.select("product_id", *facets.values()), "product_id", "left")
    counts = {
        name: F.count(column) if column == "product_id" else F.size(F.collect_set(column)) for name, column in facets.items()
    }
    return sold.groupBy("cutoff", "customer_id").agg(*[count.cast("bigint").alias(name) for name, count in counts.items()])


def snapshot_panel(
    events: DataFrame,
    cutoffs: Sequence[str],
    track: Track = MARGIN,
    labelled: bool = False,
    observed_until: str | None = None,
    history_days: int = HISTORY_DAYS,
    active_days: int = ACTIVE_DAYS,
    horizon_days: int = HORIZON_DAYS,
    products: DataFrame | None = None,
) -> DataFrame:
    """Customer features at each cutoff, with forward labels when ``labelled``.

    The population is every customer with a sale in the history window whose
    last one is at most ``active_days`` old. ``products`` (product_id, category,
    brand) is for events that do not carry these columns themselves.
    """
    if labelled:
        if observed_until is None:
            raise ValueError("Labels need the exclusive end of observation.")
        require_complete_follow_up(cutoffs, horizon_days, observed_until)

    rows = _by_cutoff(events, cutoffs, history_days, horizon_days if labelled else 0, lifetime=True)
    time, cutoff = F.col("event_time"), F.col("cutoff")
    is_sale, is_return = F.col("event_type") == "sale", F.col("event_type") == "return"
    windowed = cutoff != moment(_LIFETIME)
    past, future = windowed & (time < cutoff), windowed & (time >= cutoff)
    recent = past & (time >= cutoff - days(RECENT_DAYS))
    previous = past & (time >= cutoff - days(2 * RECENT_DAYS)) & (time < cutoff - days(RECENT_DAYS))
    sold = past & is_sale

    def units(column: str, only: Column) -> Column:
        return F.sum(F.when(only, F.col(column)).otherwise(0))

    def lines(only: Column) -> Column:
        return F.sum(F.when(only, 1).otherwise(0))

    def seen(only: Column) -> Column:
        return F.max(F.when(only, 1).otherwise(0))

    # Per order: flags add up to distinct orders, sums add up to sums.
    sums = {
        "frequency_365": seen(sold),
        "frequency_90": seen(recent & is_sale),
        "frequency_previous90": seen(previous & is_sale),
        "net_365": units("net_minor", past),
        "net_90": units("net_minor", recent),
        "gross_365": units("net_minor", sold),
    }
    if track is MARGIN:
        facets = {"category_count": "category", "brand_count": "brand"}
        sums |= {
            "margin_365": units("margin_minor", past),
            "sale_lines": lines(sold),
            "online_lines": lines(sold & (F.col("channel") == "online")),
            "discount_lines": lines(sold & (F.col("discount_rate") > 0)),
            "sold_units": units("quantity", sold),
            "returned_units": units("quantity", past & is_return),
        }
    else:
        facets = {"product_count": "product_id"}
        sums |= {"units_365": units("signed_quantity", sold), "returned_minor": -units("net_minor", past & is_return)}
    if labelled:
        sums |= {"purchases_next": seen(future & is_sale), "value_next": units(track.value_column, future)}

    carried = ["product_id"] if products is not None else list(facets.values())
    per_order = stored(
        rows.groupBy("cutoff", "customer_id", "order_id").agg(
            F.min(F.when(is_sale, time)).alias("first_sale"),
            F.max(F.when(sold, time)).alias("last_sale"),
            F.collect_set(F.when(sold, F.struct(*carried))).alias("sold"),
            *[expression.alias(name) for name, expression in sums.items()],
        )
    )
    per_customer = per_order.groupBy("cutoff", "customer_id").agg(
        F.min("first_sale").alias("first_sale"),
        F.max("last_sale").alias("last_sale"),
        *[F.sum(name).alias(name) for name in sums],
    )
    # One row per cutoff (and lifetime) and customer takes part here. A customer of
    # a snapshot has a sale before its cutoff, so the first of all is before it too.
    first_ever = F.min("first_sale").over(Window.partitionBy("customer_id"))
    recency = days_between(F.col("last_sale"), cutoff)
    eligible = (
        per_customer.withColumn("first_sale", first_ever)
        .where(windowed & F.col("last_sale").isNotNull() & (recency <= active_days))
    )
    features = eligible.join(_variety(per_order, facets, products), ["cutoff", "customer_id"], "left")

    derived = {
        "recency_days": recency,
        "tenure_days": days_between(F.col("first_sale"), cutoff),
        "net_revenue_365": from_minor(F.col("net_365"), track.digits),
        "net_revenue_90": from_minor(F.col("net_90"), track.digits),
        "average_order_value": from_minor(F.col("gross_365"), track.digits) / F.col("frequency_365"),
        "order_trend": (F.col("frequency_90") + 1) / (F.col("frequency_previous90") + 1),
    }
    if track is MARGIN:
        derived |= {
            "gross_margin_365": from_minor(F.col("margin_365"), track.digits),
            "online_share": F.col("online_lines") / F.col("sale_lines"),
            "discount_share": F.col("discount_lines") / F.col("sale_lines"),
            "return_unit_rate": F.coalesce(ratio(F.col("returned_units"), F.col("sold_units")), F.lit(0.0)),
        }
    else:
        rate = ratio(F.col("returned_minor"), F.col("gross_365"))
        derived["return_value_rate"] = F.greatest(F.coalesce(rate, F.lit(0.0)), F.lit(0.0))
    columns = [F.col("customer_id"), F.to_date("cutoff").alias("snapshot_date")]
    columns += [derived.get(name, F.col(name)).alias(name) for name in track.features]
    if labelled:
        columns += [
            F.when(F.col("purchases_next") == 0, 1).otherwise(0).alias(INACTIVE_LABEL),
            from_minor(F.col("value_next"), track.digits).alias(track.value_label),
        ]
    return features.select(*columns)


def require_sales_history(features: DataFrame, cutoffs: Sequence[str]) -> None:
    """Raise when a cutoff has no customer with a sale in its history window."""
    present = {str(row["snapshot_date"]) for row in features.select("snapshot_date").distinct().collect()}
    missing = [c for c in cutoffs if str(as_moment(c).date()) not in present]
    if missing:
        raise ValueError(f"Nobody has bought before the cutoffs {missing}.")
