"""Every operator as a named query over the test star.

Settings fit the test tables (1995 to mid 2001). Risk and value come from a
deterministic scorer where a query needs scores but no trained model, so that
SQL can state the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import RunConfig, as_moment, validate_split_plan
from ..functions import dates, values
from ..functions.money import round_cents
from ..operators import affinity, campaign, cohort, constraints, identity, marts, metrics, modelling, quality, rfm
from ..operators import measures as m
from ..operators import reports, returns
from ..operators.dedup import drop_exact_duplicates
from ..operators.snapshot import INACTIVE_LABEL, MARGIN, REVENUE, snapshot_panel
from ..session import checkpoint, scratch_folder
from ..sources import calendar, files, tables

CONFIG = RunConfig(
    train_cutoffs=("1999-01-01", "1999-07-01"),
    validation_cutoff="2000-01-01",
    test_cutoff="2000-07-01",
    score_cutoff="2001-08-02",
    observed_until="2001-08-02",
    start="1995-01-01",
)
LIMITS = rfm.Thresholds(frequency=(4, 3, 2, 1), money=(400000, 250000, 150000, 50000))
PERIOD = ("2000-01-01", "2001-01-01")
RETURN_FIELDS = ("customer_record_id", "order_id")
Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ------------------------------------------------------------------ shared inputs


def margin_panel(spark: SparkSession, root: str, cutoffs: list[str], **settings) -> DataFrame:
    """Margin snapshots; categories and brands are looked up per customer and product, not per line."""
    return snapshot_panel(tables.sales_events(spark, root), cutoffs, products=tables.products(spark, root), **settings)


def labelled_panel(spark: SparkSession, root: str) -> DataFrame:
    panel = margin_panel(
        spark, root, CONFIG.labelled_cutoffs, labelled=True, observed_until=CONFIG.observed_until
    )
    return with_split(panel)


def with_split(panel: DataFrame) -> DataFrame:
    split = F.lit(None).cast("string")
    for cutoff, name in CONFIG.splits.items():
        split = F.when(F.col("snapshot_date") == F.lit(cutoff).cast("date"), name).otherwise(split)
    return panel.withColumn("split", split)


def held_out(spark: SparkSession, root: str) -> DataFrame:
    """Labelled test snapshot with the deterministic risk and value scores."""
    panel = margin_panel(
        spark, root, [CONFIG.test_cutoff], labelled=True, observed_until=CONFIG.observed_until
    )
    return with_simple_scores(panel)


def with_simple_scores(features: DataFrame) -> DataFrame:
    """Risk grows with recency, expected value is a quarter of last year's margin."""
    quarter = F.col("gross_margin_365") * 90 / 365
    return features.withColumns(
        {"inactive_risk90": F.col("recency_days") / 180, "expected_margin90": round_cents(quarter)}
    )


def portfolio(spark: SparkSession, root: str, cutoffs: tuple[str, ...] = (CONFIG.score_cutoff,)) -> DataFrame:
    """Segmented and scored customers at the given cutoffs."""
    features = margin_panel(spark, root, cutoffs)
    scored = with_simple_scores(rfm.fixed_segments(features, LIMITS))
    return scored.withColumn("ltv_3year_scenario", round_cents(campaign.ltv_scenario(F.col("expected_margin90"))))


def customer_profiles(spark: SparkSession, root: str) -> DataFrame:
    """City, consent and review flag per customer key, taken from the identity audit."""
    audit = identity.identity_audit(tables.customer_records(spark, root), check_keys=False)
    return audit.select(
        F.col("record_id").cast("bigint").alias("customer_id"), "city", "marketing_consent", "identity_review_required"
    )


def scores_with_profile(spark: SparkSession, root: str) -> DataFrame:
    favourites = affinity.customer_affinity(
        tables.sales_events(spark, root), CONFIG.score_cutoff, tables.products(spark, root)
    )
    return (
        portfolio(spark, root)
        .join(customer_profiles(spark, root), "customer_id")
        .join(favourites, "customer_id", "left")
    )


def revenue_portfolio(spark: SparkSession, root: str) -> DataFrame:
    """Quintile-segmented revenue-track customers with simple scores and their top product."""
    events = tables.revenue_events(spark, root, ("product_name",))
    features = checkpoint(snapshot_panel(events, [CONFIG.score_cutoff], REVENUE))
    scored = rfm.quintile_segments(features).withColumns(
        {
            "inactive_risk90": F.col("recency_days") / 180,
            "expected_revenue90": round_cents(F.col("net_revenue_365") * 90 / 365),
        }
    )
    top = affinity.top_product(events, CONFIG.score_cutoff)
    return campaign.analysis_priority(scored.join(top, "customer_id", "left"))


def cleaned_events(spark: SparkSession, root: str) -> quality.Cleaned:
    mapping = identity.identity_audit(tables.customer_records(spark, root), check_keys=False)
    return quality.clean_events(
        tables.raw_events(spark, root), tables.raw_products(spark, root), mapping, CONFIG.observed_until, RETURN_FIELDS
    )


def cleaned_lines(spark: SparkSession, root: str) -> quality.Cleaned:
    return quality.clean_lines(tables.raw_line_parts(spark, root), tables.LINE_ORDER)


def lines_report(cleaned: quality.Cleaned) -> tuple[DataFrame, DataFrame]:
    report = quality.quality_report(cleaned, quality.revenue_quality_columns())
    return report, quality.reason_counts(cleaned.quarantine, "quarantine_reason")


# -------------------------------------------------------------- sources and sinks


def scan_union_provenance(spark, root):
    rows = quality.union_with_provenance(tables.raw_line_parts(spark, root), tables.LINE_ORDER)
    return rows.select("source_sheet", "source_row", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def scan_csv_roundtrip(spark, root):
    path = f"{scratch_folder(spark)}/customers"
    files.write_delimited(tables.customer_records(spark, root), path)
    return files.read_delimited(spark, path, files.INPUT_COLUMNS["customers"])


def input_manifest(spark, root):
    return files.input_manifest(spark, root, "*.parquet")


def dim_date(spark, root):
    return calendar.calendar_days(_order_times(spark, root), CONFIG.score_cutoff)


def _order_times(spark, root):
    return tables.read_table(spark, root, "orders").select(F.col("o_orderdate").alias("event_time"))


def calendar_hierarchy(spark, root):
    shipped = tables.read_table(spark, root, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return calendar.calendar_hierarchy(shipped, "day")


def _published(spark, df: DataFrame, name: str, contract) -> DataFrame:
    """Write a mart under its contract and read it back through the typed scan."""
    folder = scratch_folder(spark)
    marts.write_mart(marts.conform(df, contract[name]), folder, name)
    return marts.read_mart(spark, folder, name, contract)


def mart_fact_sales(spark, root):
    events = tables.sales_events(spark, root).withColumn("event_date", F.to_date("event_time"))
    return _published(spark, events, "fact_sales", marts.MARGIN_CONTRACT)


def mart_fact_sales_revenue(spark, root):
    events = tables.revenue_events(spark, root).withColumn("event_date", F.to_date("event_time"))
    return _published(spark, events, "fact_sales", marts.REVENUE_CONTRACT)


def _as_text(spark, df: DataFrame, name: str, contract) -> DataFrame:
    """Write a mart as delimited text and read it back through the typed scan."""
    folder = scratch_folder(spark)
    marts.write_mart(marts.conform(df, contract[name]), folder, name, ("csv",))
    return marts.read_delimited_mart(spark, folder, name, contract)


def text_mart_fact_sales(spark, root):
    events = tables.sales_events(spark, root).withColumn("event_date", F.to_date("event_time"))
    return _as_text(spark, events, "fact_sales", marts.MARGIN_CONTRACT)


def text_mart_customer_scores(spark, root):
    return _as_text(spark, scores_with_profile(spark, root), "customer_scores", marts.MARGIN_CONTRACT)


def text_mart_dim_customer(spark, root):
    return _as_text(spark, dim_customer(spark, root), "dim_customer", marts.MARGIN_CONTRACT)


def text_mart_dim_product(spark, root):
    return _as_text(spark, tables.products(spark, root), "dim_product", marts.MARGIN_CONTRACT)


def text_mart_dim_date(spark, root):
    return _as_text(spark, dim_date(spark, root), "dim_date", marts.MARGIN_CONTRACT)


def sorted_event_sink(spark, root):
    """Events written in the order of time and id: rows, and rows that stand before their predecessor in the files."""
    path = f"{scratch_folder(spark)}/events"
    marts.write_in_order(tables.sales_events(spark, root).select("event_time", "event_id", "order_id"), path)
    place = F.struct("event_time", "event_id")
    rows = spark.read.parquet(path).select(
        place.alias("place"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    inside = Window.partitionBy("file").orderBy("row")
    per_file = rows.withColumn("last", F.lag("place").over(inside)).groupBy("file").agg(
        F.count("*").alias("rows"), F.count_if(F.col("last") > F.col("place")).alias("backwards"),
        F.min("place").alias("first"), F.max("place").alias("until"),
    )
    # one row per file from here on
    files_ = per_file.agg(F.array_sort(F.collect_list(F.struct("file", "rows", "backwards", "first", "until"))).alias("files"))
    pairs = F.zip_with(F.slice("files", 1, F.size("files") - 1), F.slice("files", 2, F.size("files")), lambda a, b: (a["until"] > b["first"]).cast("bigint"))
    return files_.select(
        F.aggregate("files", F.lit(0).cast("bigint"), lambda n, f: n + f["rows"]).alias("event_rows"),
        (F.aggregate("files", F.lit(0).cast("bigint"), lambda n, f: n + f["backwards"])
         + F.aggregate(pairs, F.lit(0).cast("bigint"), lambda n, x: n + F.coalesce(x, F.lit(0).cast("bigint")))).alias("rows_out_of_order"),
    )


def mart_dim_customer(spark, root):
    return _published(spark, dim_customer(spark, root), "dim_customer", marts.MARGIN_CONTRACT)


def mart_dim_product(spark, root):
    return _published(spark, tables.products(spark, root), "dim_product", marts.MARGIN_CONTRACT)


def mart_dim_date(spark, root):
    return _published(spark, dim_date(spark, root), "dim_date", marts.MARGIN_CONTRACT)


def mart_customer_scores(spark, root):
    return _published(spark, scores_with_profile(spark, root), "customer_scores", marts.MARGIN_CONTRACT)


def mart_customer_scores_revenue(spark, root):
    return _published(spark, revenue_portfolio(spark, root), "customer_scores", marts.REVENUE_CONTRACT)


def mart_cohort_retention(spark, root):
    return _published(spark, cohort_retention(spark, root), "cohort_retention", marts.MARGIN_CONTRACT)


def load_reconcile(spark, root):
    events = tables.sales_events(spark, root)
    sent = {
        "dim_product": tables.products(spark, root),
        "dim_date": dim_date(spark, root),
        "fact_sales": marts.fact_sales(events, marts.MARGIN_CONTRACT),
    }
    return marts.load_tables(spark, sent, marts.MARGIN_CONTRACT, scratch_folder(spark))


def export_escaped(spark, root):
    mark = F.element_at(F.lit(["", "=", "+", "@", "-"]), (F.col("product_id") % 5 + 1).cast("int"))
    listed = tables.products(spark, root).select(
        "product_id", F.concat(mark, F.col("product_name")).alias("product_name"), "list_price"
    )
    path = f"{scratch_folder(spark)}/export"
    marts.write_export(listed, path)
    return files.read_delimited(spark, path, listed.columns, sep=";")


def export_customers(spark, root):
    """The customers a search has left, exported with every cell as safe text and read back."""
    found = reports.customer_search(portfolio(spark, root), rfm.FIXED_SEGMENTS[3], " 1 ", 0.1)
    listed = found.select("customer_id", "segment", "rfm_score", "frequency_365")
    path = f"{scratch_folder(spark)}/export"
    marts.write_export(listed, path)
    return files.read_delimited(spark, path, listed.columns, sep=";")


# ------------------------------------------------------------------- plain reports


def headline_cards(spark, root):
    return rounded(reports.headline_cards(tables.sales_events(spark, root)), "return_value_rate")


def monthly_channel_performance(spark, root):
    return reports.monthly_performance(tables.sales_events(spark, root), by_channel=True)


def monthly_performance(spark, root):
    return reports.monthly_performance(tables.sales_events(spark, root))


def monthly_revenue(spark, root):
    return reports.monthly_revenue(tables.sales_events(spark, root)).orderBy("month")


def category_revenue(spark, root):
    return reports.by_product_attribute(
        tables.sales_events(spark, root), tables.products(spark, root), ["category"]
    ).select("category", "net_revenue")


def category_brand_contribution(spark, root):
    return reports.by_product_attribute(
        tables.sales_events(spark, root), tables.products(spark, root), ["category", "brand"]
    )


def portfolio_totals(spark, root):
    return reports.portfolio_totals(tables.sales_events(spark, root))


def top_products(spark, root):
    return reports.top_products(tables.sales_events(spark, root), tables.products(spark, root))


def repeat_customer_share(spark, root):
    return rounded(reports.repeat_customer_share(tables.sales_events(spark, root), *PERIOD), "repeat_share")


def omnichannel_buyers(spark, root):
    return reports.omnichannel_buyers(tables.sales_events(spark, root), *PERIOD)


def sales_star(spark, root):
    star = reports.sales_star(
        tables.sales_events(spark, root),
        tables.customer_countries(spark, root),
        tables.products(spark, root).select("product_id", "category", "brand"),
        dim_date(spark, root),
    )
    return star.select(
        "event_id", "event_date", "year_month", "country", "category", "brand", "event_type", "net_revenue", "gross_margin"
    )


def measures_revenue(spark, root):
    return rounded(
        tables.sales_events(spark, root)
        .groupBy("channel")
        .agg(
            m.net_revenue().alias("net_revenue"),
            m.gross_margin().alias("gross_margin"),
            m.margin_rate().alias("margin_rate"),
            m.sale_orders().alias("sale_orders"),
            m.purchasing_customers().alias("purchasing_customers"),
            m.net_average_order_value().alias("net_average_order_value"),
        ),
        "margin_rate", "net_average_order_value",
    )


def measures_returns(spark, root):
    return rounded(
        tables.sales_events(spark, root)
        .groupBy("channel")
        .agg(
            m.return_value().alias("return_value"),
            m.gross_sale_value().alias("gross_sale_value"),
            m.return_value_rate().alias("return_value_rate"),
        ),
        "return_value_rate",
    )


def repeat_purchase_rate(spark, root):
    return rounded(m.repeat_purchase_rate(tables.sales_events(spark, root), ["channel"]), "repeat_purchase_rate")


# -------------------------------------------------------------- quality and identity


def dedup_exact(spark, root):
    return drop_exact_duplicates(tables.raw_events(spark, root)).select(
        "event_id", "order_id", "event_type", "event_time", "quantity", "unit_price"
    )


def dedup_keep_first(spark, root):
    parts = tables.raw_line_parts(spark, root)
    raw = quality.union_with_provenance(parts, tables.LINE_ORDER)
    return quality.first_lines(raw, list(parts)).select("source_sheet", "source_row", "Invoice", "StockCode", "Quantity")


def quarantine_events(spark, root):
    return cleaned_events(spark, root).quarantine.select("event_id", "rejection_reason")


def quarantine_reason_counts(spark, root):
    return quality.reason_counts(cleaned_events(spark, root).quarantine)


def enrich_events(spark, root):
    return cleaned_events(spark, root).accepted.select(
        "event_id", "customer_id", "category", "brand", "event_type", "signed_quantity", "net_revenue", "gross_margin"
    )


def quality_report(spark, root):
    return quality.quality_report(cleaned_events(spark, root))


def return_reference_check(spark, root):
    """Every return of an order against that order's first sale line."""
    events = tables.sales_events(spark, root)
    first_sale = (
        events.where(F.col("event_type") == "sale").groupBy("order_id").agg(F.min("event_id").alias("origin_event_id"))
    )
    linked = checkpoint(events.join(first_sale, "order_id").select(
        "event_id", "event_time", "event_type", "quantity", "order_id", "customer_id", "origin_event_id"
    ))
    passed = returns.accepted_returns(linked, ["order_id", "customer_id"]).withColumn("accepted", F.lit(True))
    return (
        linked.where(F.col("event_type") == "return")
        .join(passed, "event_id", "left")
        .select("event_id", "origin_event_id", "quantity", F.coalesce("accepted", F.lit(False)).alias("accepted"))
    )


def quarantine_lines(spark, root):
    return cleaned_lines(spark, root).quarantine.select("source_sheet", "source_row", "quarantine_reason")


def type_and_key_lines(spark, root):
    return cleaned_lines(spark, root).accepted.drop("net_minor")


def dim_customer_mode(spark, root):
    return quality.most_frequent(cleaned_lines(spark, root).accepted, "customer_id", "country")


def dim_product_mode(spark, root):
    return quality.most_frequent(cleaned_lines(spark, root).accepted, "product_id", "product_name")


def data_quality_metrics(spark, root):
    return quality.quality_metrics_mart(*lines_report(cleaned_lines(spark, root)))


def measures_quality(spark, root):
    mart = data_quality_metrics(spark, root)
    return mart.agg(
        m.metric_value("accepted_rows").alias("accepted_rows"),
        m.metric_value("quarantined_rows").alias("quarantined_rows"),
        m.metric_value("reconciled").alias("reconciliation_passed"),
    )


def identity_resolution(spark, root):
    audit = identity.identity_audit(tables.customer_records(spark, root), check_keys=False)
    return audit.groupBy("customer_id", "match_rule").agg(
        F.count("*").alias("records"), F.min("record_id").alias("first_record")
    )


def identity_audit(spark, root):
    return identity.identity_audit(tables.customer_records(spark, root))


def dim_customer(spark, root):
    return identity.unified_customers(identity_audit(spark, root))


def identity_stats(spark, root):
    return identity.identity_stats(dim_customer(spark, root))


def pk_violations(spark, root):
    lines = tables.sales_events(spark, root).select("event_id")
    numbered = tables.read_table(spark, root, "lineitem").select("l_orderkey", "l_linenumber")
    return constraints.pk_violations(
        {
            "dim_customer": (tables.read_table(spark, root, "customer"), ["c_custkey"]),
            "dim_product": (tables.products(spark, root), ["product_id"]),
            "dim_date": (dim_date(spark, root), ["date"]),
            "fact_sales": (lines, ["event_id"]),
            "line_numbers": (numbered, ["l_orderkey", "l_linenumber"]),
        }
    )


def fk_violations(spark, root):
    events = tables.raw_events(spark, root).withColumn("event_date", F.to_date(values.lenient_timestamp(F.col("event_time"))))
    return constraints.fk_violations(
        [
            ("events.customer_record_id", events, "customer_record_id", tables.customer_records(spark, root), "record_id"),
            ("events.product_id", events, "product_id", tables.raw_products(spark, root), "product_id"),
            ("events.event_date", events, "event_date", dim_date(spark, root), "date"),
        ]
    )


def check_violations(spark, root):
    raw = tables.raw_events(spark, root)
    number = values.lenient_number
    return constraints.check_violations(
        raw,
        {
            "event_type_domain": F.col("event_type").isin(*quality.EVENT_TYPES),
            "channel_domain": F.col("channel").isin(*quality.CHANNELS),
            "discount_between_0_and_1": number(F.col("discount_rate")).between(0, 1),
            "quantity_positive": number(F.col("quantity")) > 0,
            "quantity_present": number(F.col("quantity")).isNotNull(),
            "price_positive": number(F.col("unit_price")) > 0,
            "event_time_present": values.lenient_timestamp(F.col("event_time")).isNotNull(),
        },
    )


def contract_report(spark, root):
    contract = marts.MARGIN_CONTRACT
    built = {
        "dim_product": tables.products(spark, root),
        "dim_date": dim_date(spark, root),
        "fact_sales": marts.fact_sales(tables.sales_events(spark, root), contract),
        "cohort_retention": cohort_retention(spark, root),
        # Deliberately not in contract order.
        "dim_customer": dim_customer(spark, root).select("city", "customer_id"),
    }
    return marts.contract_report(built, contract)


# ------------------------------------------------------------------------ functions


def string_normalise(spark, root):
    return tables.customer_records(spark, root).select(
        "record_id",
        values.fold(F.col("email")).alias("email"),
        values.bare_phone(values.fold(F.col("phone"))).alias("phone"),
        values.truth(F.col("loyalty_verified")).alias("loyalty_verified"),
        values.truth(F.col("marketing_consent")).alias("marketing_consent"),
        values.surrogate_key("C", F.concat(F.lit("record:"), F.col("record_id"))).alias("surrogate"),
        F.regexp_extract("phone", r"(\d+)", 1).alias("phone_digits"),
    )


def lenient_casts(spark, root):
    number = values.lenient_number
    cells = [number(F.col(c)) for c in ("quantity", "unit_price", "discount_rate")]
    return tables.raw_events(spark, root).select(
        "event_id",
        cells[0].alias("quantity"),
        cells[1].alias("unit_price"),
        values.lenient_timestamp(F.col("event_time")).alias("event_time"),
        values.is_finite(*cells).alias("all_finite"),
        F.coalesce(values.is_whole(cells[0]), F.lit(False)).alias("whole_quantity"),
    )


def date_parts(spark, root):
    lines = tables.read_table(spark, root, "lineitem")
    orders = tables.read_table(spark, root, "orders")
    ordered, shipped = F.col("o_orderdate"), F.col("l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.year(ordered).alias("year"),
        F.month(ordered).alias("month"),
        dates.year_month(ordered).alias("year_month"),
        F.to_date(shipped).alias("ship_day"),
        (dates.month_number(shipped) - dates.month_number(ordered)).alias("months_to_ship"),
        dates.days_between(ordered, shipped).alias("days_to_ship"),
    )


# ---------------------------------------------------------------- customer analytics


def snapshot_features(spark, root):
    return margin_panel(spark, root, [CONFIG.test_cutoff])


def snapshot_features_revenue(spark, root):
    return snapshot_panel(tables.revenue_events(spark, root), [CONFIG.test_cutoff], REVENUE)


def snapshot_labels(spark, root):
    return held_out(spark, root).select("customer_id", "snapshot_date", INACTIVE_LABEL, MARGIN.value_label)


def snapshot_labels_revenue(spark, root):
    panel = snapshot_panel(
        tables.revenue_events(spark, root), [CONFIG.test_cutoff], REVENUE, True, CONFIG.observed_until
    )
    return panel.select("customer_id", "snapshot_date", INACTIVE_LABEL, REVENUE.value_label)


def labeled_snapshots(spark, root):
    return labelled_panel(spark, root)


def split_plan(spark, root):
    """Events in the history and outcome window of every cutoff."""
    validate_split_plan(CONFIG)
    time = F.col("o_orderdate")
    counts = []
    for cutoff in CONFIG.splits:
        at = dates.moment(cutoff)
        counts += [
            F.count(F.when((time >= at - dates.days(365)) & (time < at), 1)).alias(f"h_{cutoff}"),
            F.count(F.when((time >= at) & (time < at + dates.days(90)), 1)).alias(f"o_{cutoff}"),
        ]
    wide = tables.read_table(spark, root, "orders").agg(F.max(time).alias("last"), *counts)
    rows = [
        F.struct(
            F.lit(as_moment(cutoff).date()).alias("cutoff"),
            F.lit(name).alias("split"),
            F.col(f"`h_{cutoff}`").alias("history_orders"),
            F.col(f"`o_{cutoff}`").alias("outcome_orders"),
            (F.col("last") < dates.moment(CONFIG.observed_until)).alias("data_before_end"),
        )
        for cutoff, name in CONFIG.splits.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def rfm_fixed_segments(spark, root):
    features = margin_panel(spark, root, [CONFIG.test_cutoff])
    return rfm.fixed_segments(features, LIMITS).select(
        "customer_id", "snapshot_date", "r_score", "f_score", "m_score", "rfm_score", "segment"
    )


def _quintiles(spark, root):
    features = checkpoint(snapshot_panel(tables.revenue_events(spark, root), [CONFIG.test_cutoff], REVENUE))
    return rfm.quintile_segments(features)


def rfm_quintiles(spark, root):
    return _quintiles(spark, root).select("customer_id", "r_score", "f_score", "m_score")


def rfm_quintile_segments(spark, root):
    return _quintiles(spark, root).select("customer_id", "snapshot_date", "rfm_score", "segment")


def cohort_retention(spark, root):
    return cohort.cohort_retention(tables.sales_events(spark, root), CONFIG.score_cutoff)


def cohort_matrix(spark, root):
    """Ages run over the whole calendar of the configuration, so the columns do not depend on the data."""
    matrix = cohort.cohort_matrix(cohort_retention(spark, root), cohort.calendar_ages(CONFIG.start, CONFIG.score_cutoff))
    return rounded(matrix, *[c for c in matrix.columns if c != "cohort"])


def customer_affinity(spark, root):
    return affinity.customer_affinity(
        tables.sales_events(spark, root), CONFIG.score_cutoff, tables.products(spark, root)
    )


def top_product(spark, root):
    return affinity.top_product(tables.revenue_events(spark, root, ("product_name",)), CONFIG.score_cutoff)


def ltv_scenario(spark, root):
    return portfolio(spark, root).select("customer_id", "expected_margin90", "ltv_3year_scenario")


def mean_ltv(spark, root):
    return rounded(campaign.mean_ltv(portfolio(spark, root)), "mean_ltv", digits=4)


def campaign_candidates(spark, root):
    chosen = campaign.campaign_candidates(
        scores_with_profile(spark, root), CONFIG.campaign_capacity, CONFIG.control_fraction, CONFIG.seed
    )
    return rounded(chosen, "inactive_risk90", "priority_score")


def campaign_group_counts(spark, root):
    return reports.campaign_group_counts(campaign_candidates(spark, root))


def analysis_priority(spark, root):
    scores = revenue_portfolio(spark, root)
    return rounded(
        scores.select(
            "customer_id", "inactive_risk90", "expected_revenue90", "activation_eligible",
            "activation_exclusion_reason", "analysis_priority",
        ),
        "inactive_risk90", "analysis_priority",
    )


def customer_scores(spark, root):
    scores = scores_with_profile(spark, root).select(*marts.contract_columns(marts.MARGIN_CONTRACT["customer_scores"]))
    return rounded(scores, "inactive_risk90")


# ------------------------------------------------------------- score table reports


def segment_counts(spark, root):
    return reports.segment_counts(portfolio(spark, root))


def segment_value_latest(spark, root):
    scores = portfolio(spark, root, (CONFIG.test_cutoff, CONFIG.score_cutoff))
    report = reports.segment_value_latest(checkpoint(scores.select("snapshot_date", "segment", "inactive_risk90", "expected_margin90")))
    return rounded(rounded(report, "average_risk"), "expected_margin90", digits=2)


def customer_360(spark, root):
    joined = reports.customer_360(portfolio(spark, root), customer_profiles(spark, root))
    return joined.select(
        "customer_id", "snapshot_date", "segment", "rfm_score", "recency_days", "net_revenue_365",
        "city", "marketing_consent", "identity_review_required",
    )


def customer_search(spark, root):
    found = reports.customer_search(portfolio(spark, root), rfm.FIXED_SEGMENTS[3], " 1 ", 0.1)
    return rounded(found.select("customer_id", "segment", "inactive_risk90"), "inactive_risk90")


def top_risk_customers(spark, root):
    top = reports.top_risk_customers(portfolio(spark, root))
    return rounded(top.select("customer_id", "segment", "recency_days", "inactive_risk90"), "inactive_risk90")


def _sliced(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """Scores of one snapshot date out of several."""
    return reports.at_snapshot(portfolio(spark, root, (CONFIG.test_cutoff, CONFIG.score_cutoff)), date)


def _detail(scores: DataFrame) -> DataFrame:
    return rounded(rounded(reports.customer_detail(scores), "inactive_risk90"), "net_revenue_365", digits=2)


def customer_detail(spark, root):
    """The most recent snapshot."""
    return _detail(_sliced(spark, root))


def customer_detail_at(spark, root):
    """A snapshot chosen with the slicer."""
    return _detail(_sliced(spark, root, CONFIG.test_cutoff))


def _recency_value(scores: DataFrame, by: str | None = None) -> DataFrame:
    points = reports.scatter(scores, "recency_days", "net_revenue_365", color="inactive_risk90", by=by)
    return rounded(rounded(points, "inactive_risk90"), "net_revenue_365", digits=2)


def scatter_recency_value(spark, root):
    """Every snapshot, each with its own points: what the slicer shows of any date."""
    return _recency_value(portfolio(spark, root, (CONFIG.test_cutoff, CONFIG.score_cutoff)), "snapshot_date")


def scatter_recency_value_at(spark, root):
    """A snapshot chosen with the slicer."""
    return _recency_value(_sliced(spark, root, CONFIG.test_cutoff))


def model_metric_labels(spark, root):
    return rounded(reports.metric_labels(model_metrics(spark, root)), "value", "baseline", digits=4)


def quality_metric_labels(spark, root):
    return reports.quality_labels(data_quality_metrics(spark, root))


def scatter_risk_value(spark, root):
    points = reports.scatter(
        revenue_portfolio(spark, root), "inactive_risk90", "expected_revenue90", size="analysis_priority"
    )
    return rounded(points, "inactive_risk90", "expected_revenue90", "analysis_priority", digits=4)


def measures_scores(spark, root):
    scores = portfolio(spark, root, (CONFIG.test_cutoff, CONFIG.score_cutoff))
    scores = scores.withColumn("activation_eligible", F.lit(False))
    aggregates = [
        m.scored_customers().alias("scored_customers"),
        m.average_risk().alias("average_risk"),
        m.expected_value().alias("expected_margin90"),
        m.ltv_total().alias("ltv_total"),
        m.high_risk_customers().alias("high_risk_customers"),
        m.average_recency().alias("average_recency"),
        m.activation_eligible_customers().alias("activation_eligible_customers"),
    ]
    # The total over both dates shows the blanks, the dates show the values.
    both = scores.cube("snapshot_date").agg(*aggregates).where(F.col("snapshot_date").isNotNull())
    report = both.unionByName(scores.agg(F.lit(None).cast("date").alias("snapshot_date"), *aggregates))
    return rounded(rounded(report, "average_risk", "average_recency"), "expected_margin90", "ltv_total", digits=2)


# ----------------------------------------------------------------------- evaluation


def split_population(spark, root):
    return metrics.split_population(labelled_panel(spark, root), INACTIVE_LABEL)


def baseline_predictions(spark, root):
    panel = checkpoint(labelled_panel(spark, root).select("customer_id", "split", INACTIVE_LABEL, "margin_next90"))
    prior, mean = metrics.fit_baselines(
        panel.where(F.col("split").isin("train", "validation")), INACTIVE_LABEL, "margin_next90"
    )
    predicted = panel.where(F.col("split") == "test").withColumns(
        {"prior_risk": F.lit(prior), "mean_margin90": F.lit(mean)}
    )
    return rounded(rounded(predicted.drop("split"), "prior_risk"), "mean_margin90", digits=4)


def classification_metrics(spark, root):
    table = metrics.classification_metrics(held_out(spark, root), INACTIVE_LABEL, "inactive_risk90")
    return rounded(table, *table.columns[1:])


def classification_metrics_by_group(spark, root):
    """A second two-class table: document labels against a length score, per language."""
    docs = tables.read_table(spark, root, "documents").select("doc_id", "lang", "n_chars")
    labels = tables.read_table(spark, root, "labels")
    scored = labels.join(docs, "doc_id").withColumn("length_score", F.col("n_chars") / (F.col("n_chars") + 1000))
    table = metrics.classification_metrics(scored, "quality", "length_score", ["lang"], ["doc_id"])
    return rounded(table, *table.columns[2:])


def average_precision(spark, root):
    return classification_metrics(spark, root).select("n", "average_precision")


def roc_auc(spark, root):
    return classification_metrics(spark, root).select("n", "roc_auc")


def lift_at_20pct(spark, root):
    return classification_metrics(spark, root).select("n", "prevalence", "precision_at_20pct", "lift_at_20pct")


def recency_ranking(spark, root):
    table = modelling.recency_ranking(held_out(spark, root))
    return rounded(table, *table.columns)


def regression_metrics(spark, root):
    table = metrics.regression_metrics(held_out(spark, root), "margin_next90", "expected_margin90")
    return rounded(rounded(table, "wape", "r2", "bias"), "mae", "actual_sum", "predicted_sum", digits=2)


def model_metrics(spark, root):
    """The metric mart of the deterministic scorer against the fitted baselines."""
    panel = checkpoint(with_simple_scores(labelled_panel(spark, root)).select(
        "customer_id", "snapshot_date", "split", INACTIVE_LABEL, "margin_next90", "recency_days",
        "inactive_risk90", "expected_margin90",
    ))
    test = panel.where(F.col("split") == "test")
    prior, mean = metrics.fit_baselines(
        panel.where(F.col("split").isin("train", "validation")), INACTIVE_LABEL, "margin_next90"
    )
    ranked = checkpoint(
        metrics.scorer_metrics(
            test, INACTIVE_LABEL,
            {"model": F.col("inactive_risk90"), "prior": F.lit(prior), "recency": F.col("recency_days")},
        )
    )
    model, baseline, recency = (ranked.where(F.col("scorer") == name) for name in ("model", "prior", "recency"))
    mart = metrics.model_metrics_mart(
        model, baseline, recency,
        metrics.regression_metrics(test, "margin_next90", "expected_margin90"),
        metrics.regression_metrics(test.withColumn("mean", F.lit(mean)), "margin_next90", "mean"),
    )
    return rounded(mart, "value", "baseline", digits=4)


def measures_model(spark, root):
    mart = checkpoint(model_metrics(spark, root))
    return rounded(
        mart.agg(
            m.metric_value("average_precision").alias("average_precision"),
            m.metric_value("roc_auc").alias("roc_auc"),
            m.metric_value("lift_at_20pct").alias("lift_at_20pct"),
            m.metric_value("revenue_mae").alias("mae"),
            m.mae_improvement().alias("mae_improvement"),
        ),
        "mae_improvement",
    )


# ------------------------------------------------------------------- trained models


def _models(spark: SparkSession, root: str) -> modelling.ModelRun:
    """Candidates of the labelled panel; queries of one session or cluster fit each of them once."""
    return modelling.ModelRun(labelled_panel(spark, root), MARGIN, seed=CONFIG.seed)


def logistic_regression(spark, root):
    """Standardised logistic regression on train, risk for every validation customer."""
    run = _models(spark, root)
    scored = run.classifier("logistic_regression", "train").predict(run.rows("validation"), "predicted_risk")
    return scored.select("customer_id", "snapshot_date", INACTIVE_LABEL, "predicted_risk")


def gradient_boosting(spark, root):
    """Boosted value model on train and validation, prediction for every test customer."""
    run = _models(spark, root)
    scored = run.value_model("gradient_boosting", "development").predict(run.rows("test"), "predicted_margin90")
    return scored.select("customer_id", "snapshot_date", MARGIN.value_label, "predicted_margin90")


def model_selection(spark, root):
    """Validation metrics of every candidate and which one is selected."""
    run = _models(spark, root)
    risk = run.risk_table().select(F.lit("risk").alias("task"), "model", F.col("average_precision").alias("validation_metric"))
    value = run.value_table().select(F.lit("value").alias("task"), "model", F.col("mae").alias("validation_metric"))
    chosen = ((F.col("task") == "risk") & (F.col("model") == run.risk_name())) | (
        (F.col("task") == "value") & (F.col("model") == run.value_name())
    )
    return risk.unionByName(value).withColumn("selected", chosen)


def selection_candidates(spark, root):
    """Candidates of each task, whether their metric is a number, and how many are selected."""
    found = model_selection(spark, root)
    selected = found.groupBy("task").agg(F.count_if("selected").alias("selected_of_task"))
    return found.join(selected, "task").select("task", "model", F.col("validation_metric").isNotNull().alias("measured"), "selected_of_task")


def score_customers(spark, root):
    """Selected models, refitted on all labelled customers, applied to the scoring snapshot."""
    run = _models(spark, root)
    scoring = margin_panel(spark, root, [CONFIG.score_cutoff])
    classifier, value_model = run.classifier(run.risk_name(), "all"), run.value_model(run.value_name(), "all")
    scored = value_model.predict(classifier.predict(scoring, "inactive_risk90"), "expected_margin90")
    return scored.select("customer_id", "snapshot_date", "inactive_risk90", "expected_margin90")


def scored_keys(spark, root):
    """Customers that ``score_customers`` scores, and whether their scores are possible ones."""
    return score_customers(spark, root).select(
        "customer_id", "snapshot_date", F.col("inactive_risk90").between(0, 1).alias("risk_in_range"),
        F.col("expected_margin90").isNotNull().alias("value_given"),
    )


def feature_importance(spark, root):
    """AP lost on the test split when one feature of the selected risk model is shuffled."""
    run = _models(spark, root)
    model = run.classifier(run.risk_name(), "development")
    return modelling.permutation_importance(model, run.rows("test"), MARGIN.features, INACTIVE_LABEL)


def test_predictions(spark, root):
    """Truth next to the selected models' predictions for every test customer."""
    run = _models(spark, root)
    model, value = run.classifier(run.risk_name(), "development"), run.value_model(run.value_name(), "development")
    scored = value.predict(model.predict(run.rows("test"), "predicted_risk"), "predicted_margin90")
    return scored.select(
        "customer_id", "snapshot_date", INACTIVE_LABEL, MARGIN.value_label, "predicted_risk", "predicted_margin90"
    )


def test_prediction_labels(spark, root):
    """Keys and truth of ``test_predictions``, and whether the predictions are possible ones."""
    return rounded(test_predictions(spark, root), MARGIN.value_label, digits=2).select(
        "customer_id", "snapshot_date", INACTIVE_LABEL, MARGIN.value_label,
        F.col("predicted_risk").between(0, 1).alias("risk_in_range"), F.col("predicted_margin90").isNotNull().alias("value_given"),
    )


def segment_overview(spark: SparkSession, root: str) -> DataFrame:
    """Flagship: customers, revenue and average recency per fixed-threshold segment."""
    features = margin_panel(spark, root, [CONFIG.test_cutoff])
    report = (
        rfm.fixed_segments(features, LIMITS)
        .groupBy("segment")
        .agg(
            F.count("*").alias("customers"),
            F.sum("net_revenue_365").alias("net_revenue_365"),
            F.avg("recency_days").alias("average_recency"),
        )
    )
    return rounded(rounded(report, "average_recency"), "net_revenue_365", digits=2)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        segment_overview,
        scan_union_provenance, scan_csv_roundtrip, input_manifest, dim_date, calendar_hierarchy,
        mart_fact_sales, mart_fact_sales_revenue, mart_dim_customer, mart_dim_product, mart_dim_date,
        mart_customer_scores, mart_customer_scores_revenue, mart_cohort_retention, load_reconcile, export_escaped,
        text_mart_fact_sales, text_mart_customer_scores, text_mart_dim_customer, text_mart_dim_product, text_mart_dim_date,
        sorted_event_sink, export_customers, headline_cards,
        monthly_channel_performance, monthly_performance, monthly_revenue, category_revenue,
        category_brand_contribution, portfolio_totals, top_products, repeat_customer_share, omnichannel_buyers,
        sales_star, measures_revenue, measures_returns, repeat_purchase_rate,
        dedup_exact, dedup_keep_first, quarantine_events, quarantine_reason_counts, enrich_events, quality_report,
        return_reference_check, quarantine_lines, type_and_key_lines, dim_customer_mode, dim_product_mode,
        data_quality_metrics, measures_quality,
        identity_resolution, identity_audit, dim_customer, identity_stats,
        pk_violations, fk_violations, check_violations, contract_report,
        string_normalise, lenient_casts, date_parts,
        snapshot_features, snapshot_features_revenue, snapshot_labels, snapshot_labels_revenue, labeled_snapshots,
        split_plan, rfm_fixed_segments, rfm_quintiles, rfm_quintile_segments, cohort_retention, cohort_matrix,
        customer_affinity, top_product, ltv_scenario, mean_ltv, campaign_candidates, campaign_group_counts,
        analysis_priority, customer_scores,
        segment_counts, segment_value_latest, customer_360, customer_search, top_risk_customers, customer_detail,
        customer_detail_at, scatter_recency_value, scatter_recency_value_at, model_metric_labels, quality_metric_labels,
        scatter_risk_value, measures_scores,
        split_population, baseline_predictions, classification_metrics, classification_metrics_by_group,
        average_precision, roc_auc, lift_at_20pct, recency_ranking, regression_metrics, model_metrics, measures_model,
        logistic_regression, gradient_boosting, model_selection, selection_candidates, score_customers, scored_keys,
        feature_importance, test_predictions, test_prediction_labels,
    )
}
