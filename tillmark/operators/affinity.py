"""Favourite category, brand and product of each customer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HISTORY_DAYS
from ..functions.dates import days, moment


def _recent_sales(events: DataFrame, cutoff: str) -> DataFrame:
    time = F.col("event_time")
    return events.where(
        (F.col("event_type") == "sale") & (time >= moment(cutoff) - days(HISTORY_DAYS)) & (time < moment(cutoff))
    )


def _best(value: Column, revenue: Column, tie: Column, only: Column | None = None) -> Column:
    """Value with the highest revenue, lowest ``tie`` first among equals."""
    order = F.struct(-revenue, tie)
    return F.min_by(value, order if only is None else F.when(only, order))


def customer_affinity(
    events: DataFrame, cutoff: str, products: DataFrame | None = None,
    facets: Sequence[str] = ("category", "brand", "product_id"),
) -> DataFrame:
    """Top category, brand and product by revenue over the year before the cutoff.

    Revenue is first summed per customer and product; product attributes are
    joined to that shorter table when ``products`` is given. The facets are
    then stacked, so all favourites come out of one more aggregation.
    """
    sales = _recent_sales(events, cutoff)
    if products is None:
        summed = sales.groupBy("customer_id", *facets).agg(F.sum("net_minor").alias("revenue"))
    else:
        summed = sales.groupBy("customer_id", "product_id").agg(F.sum("net_minor").alias("revenue"))
        attributes = [c for c in facets if c != "product_id"]
        summed = summed.join(products.select("product_id", *attributes), "product_id")
    stacked = summed.select(
        "customer_id", "revenue",
        F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("key")) for f in facets])).alias("item"),
    ).select("customer_id", "revenue", "item.*")
    per_key = (
        stacked.where(F.col("key").isNotNull())
        .groupBy("customer_id", "facet", "key")
        .agg(F.sum("revenue").alias("revenue"))
    )
    favourites = [
        _best(F.col("key"), F.col("revenue"), F.col("key"), F.col("facet") == f).alias(f"top_{f}") for f in facets
    ]
    best = per_key.groupBy("customer_id").agg(*favourites)
    # A customer without any value for a facet is left out, as in an inner join of the facets.
    return best.dropna(subset=[f"top_{f}" for f in facets])


def top_product(events: DataFrame, cutoff: str) -> DataFrame:
    """Best-selling product of each customer over the year before the cutoff, with its name."""
    summed = (
        _recent_sales(events, cutoff)
        .where(F.col("product_name").isNotNull())
        .groupBy("customer_id", "product_id", "product_name")
        .agg(F.sum("net_minor").alias("revenue"))
    )
    tie = F.struct(F.col("product_id").cast("string"), F.col("product_name"))
    pick = F.struct(F.col("product_id").cast("string").alias("id"), F.col("product_name").alias("name"))
    best = summed.groupBy("customer_id").agg(_best(pick, F.col("revenue"), tie).alias("top"))
    return best.select(
        "customer_id", F.col("top.id").alias("top_product_id"), F.col("top.name").alias("top_product_name")
    )
