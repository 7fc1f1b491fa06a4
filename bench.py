"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query
runs to the end into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from tillmark.plans.registry import QUERIES
from tillmark.session import build_session

HEADLINE = (
    "segment_overview", "snapshot_features", "snapshot_features_revenue", "labeled_snapshots", "snapshot_labels",
    "rfm_fixed_segments", "rfm_quintile_segments", "cohort_retention", "cohort_matrix", "customer_affinity",
    "top_product", "campaign_candidates", "customer_scores", "monthly_channel_performance", "monthly_performance",
    "category_brand_contribution", "portfolio_totals", "top_products", "repeat_customer_share", "omnichannel_buyers",
    "sales_star", "measures_revenue", "measures_returns", "repeat_purchase_rate", "dedup_exact", "dedup_keep_first",
    "scan_union_provenance", "quarantine_events", "enrich_events", "quality_report", "return_reference_check",
    "type_and_key_lines", "data_quality_metrics", "identity_audit", "dim_customer", "pk_violations", "fk_violations",
    "check_violations", "mart_fact_sales", "segment_value_latest", "measures_scores", "classification_metrics",
    "regression_metrics", "model_metrics", "logistic_regression", "feature_importance", "gradient_boosting",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["identity_stats"](spark, root).collect()  # start the JVM's code paths
    seconds = {}
    for name in only:
        started = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_wall_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": root}))
    spark.stop()


if __name__ == "__main__":
    main()
