"""End-to-end runs: raw tables in, published marts, reports and models out."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig, as_moment, validate_split_plan
from ..functions.money import wide_sum
from ..operators import affinity, campaign, cohort, identity, marts, metrics, modelling, quality, rfm
from ..operators.constraints import assert_unique
from ..operators.snapshot import MARGIN, REVENUE, Track, require_sales_history, snapshot_panel
from ..session import checkpoint
from ..sources import calendar, files


@dataclass(frozen=True)
class Run:
    """What a run published, for the caller to look at."""

    marts: dict[str, DataFrame]
    evaluation: modelling.Evaluation
    quality: DataFrame
    summary: dict


def _panel(events: DataFrame, config: RunConfig, track: Track) -> DataFrame:
    panel = snapshot_panel(
        events, config.labelled_cutoffs, track, True, config.observed_until,
        config.history_days, config.active_days, config.horizon_days,
    )
    split = F.lit(None).cast("string")
    for cutoff, name in config.splits.items():
        split = F.when(F.col("snapshot_date") == F.lit(str(as_moment(cutoff).date())).cast("date"), name).otherwise(split)
    return panel.withColumn("split", split)


def _scoring(events: DataFrame, config: RunConfig, track: Track) -> DataFrame:
    return snapshot_panel(
        events, [config.score_cutoff], track, history_days=config.history_days, active_days=config.active_days
    )


def _require_data_before_end(events: DataFrame, config: RunConfig) -> None:
    last = events.agg(F.max("event_time")).first()[0]
    if last is not None and last >= as_moment(config.score_cutoff):
        raise ValueError("The scoring cutoff must be after the latest event.")


def _publish(tables: Mapping[str, DataFrame], contract: Mapping[str, str], out: str) -> None:
    """Write every mart under its contract as parquet and headed text."""
    for name, df in tables.items():
        shaped = marts.conform(df, contract[name]) if name in contract else df
        marts.write_mart(shaped, out, name, ("parquet", "csv"))


def _metric_rows(evaluation: modelling.Evaluation) -> DataFrame:
    """All metric tables in long form: section, model, metric, value."""
    sections = {
        "validation_classification": evaluation.validation_risk,
        "validation_value": evaluation.validation_value,
        "test_classification": evaluation.test_risk,
        "test_classification_baseline": evaluation.test_risk_baseline,
        "test_recency_ranking": evaluation.test_recency,
        "test_value": evaluation.test_value,
        "test_value_baseline": evaluation.test_value_baseline,
    }
    rows = None
    for section, table in sections.items():
        if "model" not in table.columns:
            table = table.withColumn("model", F.lit(None).cast("string"))
        names = [c for c in table.columns if c != "model"]
        wide = table.select("model", *[F.col(c).cast("double").alias(c) for c in names])
        long = wide.unpivot(["model"], names, "metric", "value").withColumn("section", F.lit(section))
        rows = long if rows is None else rows.unionByName(long)
    return rows.select("section", "model", "metric", "value")


def _documents(
    spark: SparkSession, out: str, config: RunConfig, evaluation: modelling.Evaluation, report: DataFrame,
    source: str, inputs: DataFrame | None,
) -> None:
    """Metrics, quality and the run manifest; the manifest comes last and marks a complete run."""
    marts.write_json(_metric_rows(evaluation), f"{out}/reports/metrics")
    marts.write_json(report, f"{out}/reports/data_quality")
    if inputs is not None:
        marts.write_json(inputs, f"{out}/reports/inputs")
    manifest = {
        "config": asdict(config), "source": source, "spark": pyspark.__version__,
        "classifier": evaluation.classifier_name, "value_model": evaluation.value_model_name,
    }
    text = spark.createDataFrame([(json.dumps(manifest, ensure_ascii=False, default=str),)], "value string")
    text.coalesce(1).write.mode("errorifexists").text(f"{out}/reports/run_manifest")


def run_margin_track(
    spark: SparkSession,
    customers: DataFrame,
    products: DataFrame,
    raw_events: DataFrame,
    config: RunConfig,
    out: str,
    source: str = "margin track",
    shared: Sequence[str] = quality.SHARED_FIELDS,
    limits: rfm.Thresholds = rfm.Thresholds(),
    rounds: int | None = None,
    inputs: DataFrame | None = None,
) -> Run:
    """Identity, cleaning, snapshots, models, campaign and marts of data with costs and consent."""
    validate_split_plan(config)
    audit = checkpoint(identity.identity_audit(customers))
    people = identity.unified_customers(audit)
    cleaned = quality.clean_events(raw_events, products, audit, config.observed_until, shared)
    events = checkpoint(cleaned.accepted)
    cleaned = replace(cleaned, accepted=events)
    report = checkpoint(quality.quality_report(cleaned))
    quality.require_reconciled(report)

    panel = checkpoint(_panel(events, config, MARGIN))
    require_sales_history(panel, config.labelled_cutoffs)
    evaluation = modelling.fit_evaluate(panel, _scoring(events, config, MARGIN), MARGIN, rounds, config.seed)
    segmented = rfm.fixed_segments(evaluation.scores, limits)
    assert_unique(people, ["customer_id"], "customer_id must be unique.")
    favourites = affinity.customer_affinity(events, config.score_cutoff)
    scores = checkpoint(
        segmented.join(people, "customer_id")
        .join(favourites, "customer_id", "left")
        .withColumn("ltv_3year_scenario", campaign.ltv_scenario(F.col("expected_margin90")))
    )
    candidates = campaign.campaign_candidates(scores, config.campaign_capacity, config.control_fraction, config.seed)
    tables = {
        "dim_customer": people,
        "identity_audit": audit,
        "dim_product": products,
        "dim_date": calendar.calendar_days(events, config.score_cutoff, config.start),
        "fact_sales": events.withColumn("event_date", F.to_date("event_time")),
        "customer_scores": scores,
        "campaign_candidates": candidates,
        "cohort_retention": cohort.cohort_retention(events, config.score_cutoff),
        "quarantine": cleaned.quarantine,
        "labeled_snapshots": panel.drop("split"),
        "feature_importance": evaluation.importance,
        "test_predictions": evaluation.predictions,
    }
    _publish(tables, marts.MARGIN_CONTRACT, f"{out}/marts")
    modelling.save_models(evaluation, f"{out}/models", MARGIN, config.score_cutoff, source)
    marts.write_json(identity.identity_stats(people), f"{out}/reports/identity")
    _documents(spark, out, config, evaluation, report, source, inputs)
    return Run(tables, evaluation, report, _summary(events, scores, evaluation))


def run_revenue_track(
    spark: SparkSession,
    parts: Mapping[str, DataFrame],
    order: Sequence[str],
    config: RunConfig,
    out: str,
    source: str = "revenue track",
    prefix: str = "UCI-",
    rounds: int | None = None,
    inputs: DataFrame | None = None,
) -> Run:
    """Cleaning, snapshots, models and marts of revenue-only data in several parts."""
    validate_split_plan(config)
    cleaned = quality.clean_lines(parts, order, prefix)
    events = checkpoint(cleaned.accepted)
    cleaned = replace(cleaned, accepted=events)
    _require_data_before_end(events, config)
    report = checkpoint(quality.quality_report(cleaned, quality.revenue_quality_columns()))
    quality.require_reconciled(report)
    reasons = quality.reason_counts(cleaned.quarantine, "quarantine_reason")
    people = quality.most_frequent(events, "customer_id", "country")
    products = quality.most_frequent(events, "product_id", "product_name")

    panel = checkpoint(_panel(events, config, REVENUE))
    require_sales_history(panel, config.labelled_cutoffs)
    evaluation = modelling.fit_evaluate(panel, _scoring(events, config, REVENUE), REVENUE, rounds, config.seed)
    segmented = rfm.quintile_segments(checkpoint(evaluation.scores))
    scores = checkpoint(
        campaign.analysis_priority(
            segmented.join(people, "customer_id").join(
                affinity.top_product(events, config.score_cutoff), "customer_id", "left"
            )
        )
    )
    tables = {
        "dim_customer": people,
        "dim_product": products,
        "dim_date": calendar.calendar_days(events, config.score_cutoff),
        "fact_sales": events.withColumn("event_date", F.to_date("event_time")),
        "customer_scores": scores,
        "cohort_retention": cohort.cohort_retention(events, config.score_cutoff),
        "data_quality_metrics": quality.quality_metrics_mart(report, reasons),
        "model_metrics": metrics.model_metrics_mart(
            evaluation.test_risk, evaluation.test_risk_baseline, evaluation.test_recency,
            evaluation.test_value, evaluation.test_value_baseline,
        ),
        "quarantine": cleaned.quarantine,
        "labeled_snapshots": panel.drop("split"),
        "feature_importance": evaluation.importance,
        "test_predictions": evaluation.predictions,
    }
    _publish(tables, marts.REVENUE_CONTRACT, f"{out}/marts")
    modelling.save_models(evaluation, f"{out}/models", REVENUE, config.score_cutoff, source)
    _documents(spark, out, config, evaluation, report, source, inputs)
    return Run(tables, evaluation, report, _summary(events, scores, evaluation))


def run_margin_files(spark: SparkSession, folder: str, config: RunConfig, out: str, **options) -> Run:
    """The margin track from ``customers.csv``, ``products.csv`` and ``events.csv`` below ``folder``.

    The files' fingerprints go into the run's documents. Prices of the product
    file are typed by the mart contract.
    """
    read = {
        name: files.read_delimited(spark, f"{folder}/{name}.csv", columns)
        for name, columns in files.INPUT_COLUMNS.items()
    }
    return run_margin_track(
        spark, read["customers"], read["products"], read["events"], config, out,
        inputs=files.input_manifest(spark, folder, "*.csv"), **options,
    )


def _summary(events: DataFrame, scores: DataFrame, evaluation: modelling.Evaluation) -> dict:
    risk, value = evaluation.test_risk.first(), evaluation.test_value.first()
    totals = events.agg(F.count("*").alias("rows"), wide_sum(F.col("net_minor")).alias("net")).first()
    return {
        "accepted_events": totals["rows"],
        "scored_customers": scores.count(),
        "classifier": evaluation.classifier_name,
        "value_model": evaluation.value_model_name,
        "test_average_precision": round(risk["average_precision"], 4),
        "test_roc_auc": None if risk["roc_auc"] is None else round(risk["roc_auc"], 4),
        "test_lift_at_20pct": round(risk["lift_at_20pct"], 3),
        "test_value_mae": round(value["mae"], 2),
    }
