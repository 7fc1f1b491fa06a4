"""Conservative one-hop identity linkage with an audit trail.

Only verified attributes are evidence. A loyalty id identifies; a verified
e-mail and phone *together* link records; one shared attribute never does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import bare_phone, fold, quoted, surrogate_key, truth
from .constraints import assert_unique


def identity_audit(customers: DataFrame, check_keys: bool = True) -> DataFrame:
    """One row per source record: its customer, the rule that decided, and the review flag.

    A pair with exactly one known loyalty id takes it over. A pair with several
    stays apart and all its records are flagged.
    """
    if check_keys:
        assert_unique(customers, ["record_id"], "Duplicate record_id; reconcile the source before linkage.")
    empty = F.lit("")
    records = customers.select(
        "record_id",
        F.when(truth(F.col("email_verified")), fold(F.col("email"))).otherwise(empty).alias("email"),
        F.when(truth(F.col("phone_verified")), bare_phone(fold(F.col("phone")))).otherwise(empty).alias("phone"),
        F.when(truth(F.col("loyalty_verified")), fold(F.col("loyalty_id"))).otherwise(empty).alias("loyalty"),
        "city",
        truth(F.col("marketing_consent")).alias("marketing_consent"),
    )
    has_pair = (F.col("email") != "") & (F.col("phone") != "")
    pair = F.concat(F.lit("pair:("), quoted(F.col("email")), F.lit(", "), quoted(F.col("phone")), F.lit(")"))
    alone = F.concat(F.lit("record:"), F.col("record_id"))
    # A record without a pair gets a key of its own, which spreads these records over the join.
    records = records.withColumns({"has_pair": has_pair, "link": F.when(has_pair, pair).otherwise(alone)})
    known = F.when(F.col("loyalty") != "", F.col("loyalty"))
    # Lowest and highest id tell none, one and several apart without collecting them.
    pairs = (
        records.where("has_pair")
        .groupBy("link")
        .agg(F.min(known).alias("lowest"), F.max(known).alias("highest"))
        .where(F.col("lowest").isNotNull())
    )
    linked = records.join(pairs, "link", "left")
    conflict = F.coalesce(F.col("lowest") != F.col("highest"), F.lit(False))
    one_id = F.col("has_pair") & F.col("lowest").isNotNull() & ~conflict
    own = F.col("loyalty") != ""
    key = (
        F.when(own, F.concat(F.lit("loyalty:"), F.col("loyalty")))
        .when(one_id, F.concat(F.lit("loyalty:"), F.col("lowest")))
        .when(F.col("has_pair") & ~conflict, F.col("link"))
        .otherwise(alone)
    )
    rule = (
        F.when(own, "verified_loyalty")
        .when(one_id, "verified_pair_to_loyalty")
        .when(F.col("has_pair") & ~conflict, "verified_email_and_phone")
        .otherwise("unmerged_record")
    )
    return linked.select(
        "record_id",
        surrogate_key("C", key).alias("customer_id"),
        rule.alias("match_rule"),
        conflict.alias("identity_review_required"),
        "city",
        "marketing_consent",
    )


def unified_customers(audit: DataFrame) -> DataFrame:
    """Customer dimension: first city by record, opt-out wins, review if any record needs it."""
    known_city = F.when(F.col("city").isNotNull(), F.col("record_id"))
    return audit.groupBy("customer_id").agg(
        F.min_by("city", known_city).alias("city"),
        F.bool_and("marketing_consent").alias("marketing_consent"),
        F.bool_or("identity_review_required").alias("identity_review_required"),
        F.count("*").alias("source_records"),
    )


def identity_stats(dimension: DataFrame) -> DataFrame:
    """Record and customer counts, and how many records linkage collapsed."""
    return dimension.agg(
        F.sum("source_records").alias("raw_customer_records"),
        F.count("*").alias("unified_customers"),
        (F.sum("source_records") - F.count("*")).alias("collapsed_records"),
        F.count(F.when(F.col("identity_review_required"), 1)).alias("identity_review_customers"),
    )
