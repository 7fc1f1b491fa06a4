"""Published tables: contracts, writers, reconciled load and exports."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.values import spreadsheet_safe
from ..sources.files import Folder, read_typed, write_delimited
from .constraints import contract_findings

# Ordered columns and types of the revenue-track report contract.
REVENUE_CONTRACT = {
    "dim_customer": "customer_id string, country string",
    "dim_product": "product_id string, product_name string",
    "dim_date": "date date, year int, month int, year_month string",
    "fact_sales": "event_id string, order_id string, customer_id string, product_id string, event_type string, "
    "signed_quantity bigint, unit_price decimal(18,4), net_revenue decimal(18,4), event_date date",
    "customer_scores": "customer_id string, snapshot_date date, segment string, rfm_score string, r_score int, "
    "f_score int, m_score int, recency_days double, frequency_365 bigint, net_revenue_365 decimal(18,4), "
    "inactive_risk90 double, expected_revenue90 decimal(18,4), top_product_id string, top_product_name string, "
    "activation_eligible boolean, activation_exclusion_reason string, analysis_priority decimal(18,4)",
    "cohort_retention": "cohort string, month_index int, cohort_size bigint, active_customers bigint, "
    "retention_rate double",
    "data_quality_metrics": "metric string, label string, value bigint, unit string, status string",
    "model_metrics": "metric string, label string, value double, baseline double, unit string, split string",
}
# Ordered columns and types of the margin-track marts.
MARGIN_CONTRACT = {
    "dim_customer": "customer_id string, city string, marketing_consent boolean, "
    "identity_review_required boolean, source_records bigint",
    "identity_audit": "record_id string, customer_id string, match_rule string, "
    "identity_review_required boolean, city string, marketing_consent boolean",
    "dim_product": "product_id string, product_name string, category string, brand string, "
    "list_price decimal(18,2), unit_cost decimal(18,2)",
    "dim_date": "date date, year int, month int, year_month string",
    "fact_sales": "event_id string, order_id string, customer_id string, product_id string, event_type string, "
    "channel string, signed_quantity bigint, net_revenue decimal(18,2), gross_margin decimal(18,2), event_date date",
    "customer_scores": "customer_id string, snapshot_date date, segment string, rfm_score string, r_score int, "
    "f_score int, m_score int, recency_days double, frequency_365 bigint, net_revenue_365 decimal(18,2), "
    "gross_margin_365 decimal(18,2), inactive_risk90 double, expected_margin90 decimal(18,2), "
    "ltv_3year_scenario decimal(18,2), top_category string, top_brand string, top_product_id string",
    "campaign_candidates": "customer_id string, snapshot_date date, segment string, city string, "
    "top_category string, top_brand string, recency_days double, inactive_risk90 double, "
    "expected_margin90 decimal(18,2), priority_score double, experiment_group string, business_reason string, "
    "suggested_action string",
    "cohort_retention": "cohort string, month_index int, cohort_size bigint, active_customers bigint, "
    "retention_rate double",
}
# Many-to-one relationships of the star.
RELATIONSHIPS = (
    ("fact_sales.customer_id", "dim_customer.customer_id"),
    ("fact_sales.product_id", "dim_product.product_id"),
    ("fact_sales.event_date", "dim_date.date"),
    ("customer_scores.customer_id", "dim_customer.customer_id"),
)
# Keys that must be unique and not null.
PRIMARY_KEYS = {
    "dim_customer": ("customer_id",),
    "dim_product": ("product_id",),
    "dim_date": ("date",),
    "fact_sales": ("event_id",),
    "customer_scores": ("customer_id", "snapshot_date"),
}


def contract_columns(ddl: str) -> list[str]:
    """Column names of a contract in order."""
    return [column.split()[0] for column in ddl.split(", ")]


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select the contract's columns in order and cast them to its types."""
    typed = [column.split(maxsplit=1) for column in ddl.split(", ")]
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in typed])


def fact_sales(events: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Fact mart: event lines with decimal money and the event date."""
    return conform(events.withColumn("event_date", F.to_date("event_time")), contract["fact_sales"])


def write_mart(df: DataFrame, root: str, name: str, formats: Sequence[str] = ("parquet",)) -> None:
    """Write one mart; refuses to touch an existing one.

    The fact table is partitioned by month and sorted by customer inside its
    files, which serves period filters and customer lookups.
    """
    for kind in formats:
        path = f"{root}/{kind}/{name}"
        if kind == "csv":
            write_delimited(df, path)
        elif name == "fact_sales":
            by_month = df.withColumn("year_month", F.date_format("event_date", "yyyy-MM"))
            # Adaptive rebalancing splits a month that is too large and joins small ones.
            by_month = by_month.hint("rebalance", "year_month")
            by_month.sortWithinPartitions("year_month", "customer_id", "event_date").write.mode(
                "errorifexists"
            ).partitionBy("year_month").parquet(path)
        else:
            df.write.mode("errorifexists").parquet(path)


def read_mart(spark: SparkSession, root: str, name: str, contract: Mapping[str, str]) -> DataFrame:
    """Typed scan of a parquet mart with the contract's schema."""
    ddl = contract[name] + (", year_month string" if name == "fact_sales" else "")
    return spark.read.schema(ddl).parquet(f"{root}/parquet/{name}")


def read_delimited_mart(spark: SparkSession, root: str, name: str, contract: Mapping[str, str]) -> DataFrame:
    """Typed scan of a delimited mart; stops at the first row that is not of the contract's types."""
    rows = read_typed(spark, f"{root}/csv/{name}", contract[name])
    columns = contract_columns(contract[name])
    # A data column takes part in the message, since the text of a row cannot be read without the row's cells.
    first = F.coalesce(F.col(columns[0]).cast("string"), F.lit("?"))
    broken = F.raise_error(F.concat(F.lit(f"Row of {name} breaks its contract, {columns[0]} "), first, F.lit(": "), F.col("_rejected")))
    return rows.where(F.when(F.col("_rejected").isNotNull(), broken.cast("boolean")).otherwise(F.lit(True))).select(*columns)


def write_in_order(df: DataFrame, path: str, order: Sequence[str] = ("event_time", "event_id")) -> None:
    """Parquet files whose names and rows follow ``order``, for readers that need the sequence of events."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)


def require_no_nan(df: DataFrame) -> None:
    """A document must not hold NaN or an infinite number."""
    numbers = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")]
    bad = F.lit(False)
    for name in numbers:
        bad = bad | F.isnan(name) | (F.abs(F.col(name)) == float("inf"))
    if numbers and not df.where(bad).isEmpty():
        raise ValueError("NaN or infinite values cannot be written as JSON.")


def write_json(df: DataFrame, path: str) -> None:
    require_no_nan(df)
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def load_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], contract: Mapping[str, str], root: str
) -> DataFrame:
    """Publish tables under the contract and reconcile row counts.

    Headers must match the contract, a target must not exist, empty text becomes
    null. Tables are written to a staging folder beside the targets while their rows
    are counted on the way, then counted again as read back; only when all agree are
    they moved to their places, and the manifest comes last. If anything fails, no
    table of the set stays visible. Returns table_name, rows_sent, rows_loaded.
    """
    actual = {name: df.columns for name, df in tables.items()}
    expected = {name: contract_columns(contract[name]) for name in tables}
    wrong = [name for name in tables if len(set(actual[name])) != len(actual[name]) or set(actual[name]) != set(expected[name])]
    if wrong:
        raise ValueError(f"Column mismatch in {wrong}.")
    files, staging = Folder(spark, root), f"{root}/_staging-{uuid.uuid4().hex}"
    places = {name: f"{root}/parquet/{name}" for name in tables}
    taken = sorted(name for name, place in places.items() if files.has(place))
    if taken:
        raise ValueError(f"A target already exists: {taken}.")
    moved = []
    try:
        sent = {}
        for name, df in tables.items():
            texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
            blank_free = df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in df.columns])
            seen = Observation()
            write_mart(conform(blank_free, contract[name]).observe(seen, F.count(F.lit(1)).alias("rows")), staging, name)
            sent[name] = seen.get["rows"]
        loaded = {name: read_mart(spark, staging, name, contract).count() for name in tables}
        unequal = sorted(name for name in tables if sent[name] != loaded[name])
        if unequal:
            raise ValueError(f"Row count mismatch in {unequal}.")
        files.make(f"{root}/parquet")
        for name, place in places.items():
            if not files.rename(f"{staging}/parquet/{name}", place):
                raise ValueError(f"Table {name} could not be moved to its place.")
            moved.append(place)
        manifest = json.dumps({"tables": loaded}, sort_keys=True)
        spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.text(f"{root}/manifest")
    except Exception:
        for place in moved:
            files.remove(place)
        raise
    finally:
        files.remove(staging)
    rows = [(name, sent[name], loaded[name]) for name in tables]
    return spark.createDataFrame(rows, "table_name string, rows_sent bigint, rows_loaded bigint")


def escaped_export(df: DataFrame) -> DataFrame:
    """All columns as text that a spreadsheet will not run as formulas."""
    return df.select(*[spreadsheet_safe(F.col(c)).alias(c) for c in df.columns])


def write_export(df: DataFrame, path: str) -> None:
    write_delimited(escaped_export(df), path, sep=";", quote_all=True)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Batched insert into an empty table of a relational database."""
    df.write.mode("append").option("batchsize", 1000).jdbc(url, table, properties=dict(properties))


def contract_report(tables: Mapping[str, DataFrame], contract: Mapping[str, str]) -> DataFrame:
    """Per mart: rows, null cells in key columns and whether the header equals the contract."""
    report = None
    for name, df in tables.items():
        header = not contract_findings({name: contract_columns(contract[name])}, actual={name: df.columns})
        keys = [c for c in PRIMARY_KEYS.get(name, ()) if c in df.columns]
        nulls = [F.count(F.when(F.col(k).isNull(), 1)) for k in keys]
        total = F.lit(0).cast("bigint")
        for count in nulls:
            total = total + count
        row = df.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"), total.alias("null_keys"),
            F.lit(header).alias("header_matches"),
        )
        report = row if report is None else report.unionByName(row)
    return report
