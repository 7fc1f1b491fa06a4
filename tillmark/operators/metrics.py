"""Model evaluation as aggregations over one distributed ordering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import ratio
from ..session import checkpoint
from .ordered import global_rank, totals_so_far

TOP_SHARE = 0.2
MIN_ROWS = 30
TIE_KEYS = ("snapshot_date", "customer_id")
# Metric, label and unit of the model mart.
MODEL_METRICS = (
    ("average_precision", "Inactivity average precision", "ratio"),
    ("roc_auc", "Inactivity ROC-AUC", "ratio"),
    ("lift_at_20pct", "Top-20% lift", "multiple"),
    ("revenue_mae", "90-day revenue MAE", "GBP"),
)


def split_population(panel: DataFrame, label: str, by: str = "split") -> DataFrame:
    """Rows, positives and whether a split can be evaluated: both classes and 30 rows."""
    positives = F.sum(F.col(label).cast("bigint"))
    return panel.groupBy(by).agg(
        F.count("*").alias("row_count"),
        positives.alias("positives"),
        ((F.count("*") >= MIN_ROWS) & (positives > 0) & (positives < F.count("*"))).alias("evaluable"),
    )


def require_evaluable(population: DataFrame, splits: Sequence[str] = ("train", "validation", "test")) -> None:
    usable = {row["split"] for row in population.where("evaluable").collect()}
    bad = [name for name in splits if name not in usable]
    if bad:
        raise ValueError(f"No evaluable customer population (two classes, {MIN_ROWS} rows) in {bad}.")


def fit_baselines(train: DataFrame, label: str, value: str) -> tuple[float, float]:
    """Prior probability and mean value of the training rows."""
    row = train.agg(F.avg(label).alias("prior"), F.avg(value).alias("mean")).first()
    return row["prior"], row["mean"]


def classification_metrics(
    scored: DataFrame, label: str, score: str, group: Sequence[str] = (), ties: Sequence[str] = TIE_KEYS
) -> DataFrame:
    """Row count, prevalence, AP, ROC-AUC, Brier loss, precision and lift of the top fifth.

    One row per ``group``. Rows are counted per distinct score first, so a score
    that many rows share is one row from there on. The scores are laid out once by
    descending value; totals of each partition give the rows and hits before it, and
    one scan adds everything up: AP is precision times the gain in recall per
    distinct score, AUC counts a tied pair as half. Only rows of the score at which
    the top fifth ends are looked at one by one, in the order of ``ties``.
    """
    narrow = scored.select(
        *group, *ties, F.col(label).cast("bigint").alias("_hit"), F.col(score).cast("double").alias("_score")
    )
    per_score = narrow.groupBy(*group, "_score").agg(F.count("*").alias("_rows"), F.sum("_hit").alias("_hits"))
    counted = totals_so_far(per_score, [F.desc("_score")], ("_rows", "_hits"), group)
    rows, hits, rows_down_to, hits_down_to = (F.col(c) for c in ("_rows", "_hits", "_rows_so_far", "_hits_so_far"))
    misses, value, above = rows - hits, F.col("_score"), rows_down_to - rows
    limit = F.greatest(F.lit(1), F.ceil(F.col("_rows_in_all") * F.lit(TOP_SHARE)))
    inside, cut = rows_down_to <= limit, (above < limit) & (rows_down_to > limit)
    sums = counted.groupBy(*group).agg(
        F.sum(rows).alias("n"),
        F.sum(hits).alias("positives"),
        F.sum(hits * hits_down_to / rows_down_to).alias("precision_sum"),
        F.sum(misses * (hits_down_to - hits + 0.5 * hits)).alias("pairs_won"),
        F.sum(hits * (value - 1) * (value - 1) + misses * value * value).alias("squares"),
        F.max(limit).alias("limit"),
        F.coalesce(F.sum(F.when(inside, hits)), F.lit(0)).alias("hits_inside"),
        F.max(F.when(cut, F.struct(value.alias("score"), (limit - above).alias("left")))).alias("cut"),
    )
    sums = checkpoint(sums.where("n > 0"))
    tied = _hits_of_cut_score(narrow, sums, group, ties)
    n, positives = F.col("n"), F.col("positives")
    whole = sums.join(tied, list(group), "left") if group else sums.withColumn("hits_tied", F.lit(tied))
    precision = (F.col("hits_inside") + F.coalesce("hits_tied", F.lit(0))) / F.col("limit")
    return whole.select(
        *group,
        "n",
        (positives / n).alias("prevalence"),
        ratio(F.col("precision_sum"), positives).alias("average_precision"),
        ratio(F.col("pairs_won"), positives * (n - positives)).alias("roc_auc"),
        (F.col("squares") / n).alias("brier"),
        precision.alias("precision_at_20pct"),
        ratio(precision, positives / n).alias("lift_at_20pct"),
    )


def _hits_of_cut_score(narrow: DataFrame, sums: DataFrame, group: Sequence[str], ties: Sequence[str]) -> DataFrame | int:
    """Hits among the rows of the score at which the top fifth ends that still belong to it; a number without groups."""
    order = [F.col(c) for c in ties]
    if not group:
        found = sums.where("cut IS NOT NULL").select("cut.score", "cut.left").first()
        if found is None:
            return 0
        return global_rank(narrow.where(F.col("_score") == found["score"]), order).where(
            F.col("rank") <= found["left"]
        ).agg(F.coalesce(F.sum("_hit"), F.lit(0))).first()[0]
    cuts = sums.where("cut IS NOT NULL").select(*group, F.col("cut.score").alias("_score"), F.col("cut.left").alias("_left"))
    ranked = global_rank(narrow.join(cuts, [*group, "_score"]), order, group)
    return ranked.where("rank <= _left").groupBy(*group).agg(F.sum("_hit").alias("hits_tied"))


def scorer_metrics(
    scored: DataFrame, label: str, scorers: Mapping[str, Column], ties: Sequence[str] = TIE_KEYS
) -> DataFrame:
    """Ranking metrics of several scores of the same rows, one row per ``scorer``, over one ordering."""
    given = F.array(*[
        F.struct(F.lit(name).alias("scorer"), score.cast("double").alias("score")) for name, score in scorers.items()
    ])
    stacked = scored.select(label, *ties, F.explode(given).alias("given")).select(label, *ties, "given.*")
    return classification_metrics(stacked, label, "score", ["scorer"], ties)


def regression_metrics(scored: DataFrame, actual: str, predicted: str, group: Sequence[str] = ()) -> DataFrame:
    """Row count, MAE, WAPE, R2, sums and relative bias of the total."""
    y, p = F.col(actual), F.col(predicted)
    spread = F.var_pop(y) * F.count("*")
    error = F.sum((y - p) * (y - p))
    fit = F.when(spread == 0, F.when(error == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(error, spread))
    return scored.groupBy(*group).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        ratio(F.sum(F.abs(y - p)), F.sum(F.abs(y))).alias("wape"),
        fit.alias("r2"),
        F.sum(y).alias("actual_sum"),
        F.sum(p).alias("predicted_sum"),
        (ratio(F.sum(p), F.sum(y)) - 1).alias("bias"),
    )


def model_metrics_mart(
    model: DataFrame, baseline: DataFrame, recency: DataFrame, value: DataFrame, value_baseline: DataFrame
) -> DataFrame:
    """Four held-out metrics next to their baselines, in long form.

    Lift is compared with the recency ranking, the value error with the mean.
    Each input is one row of the metric functions above.
    """

    wanted = (
        (model, "average_precision", 0, "value"), (model, "roc_auc", 1, "value"), (model, "lift_at_20pct", 2, "value"),
        (value, "mae", 3, "value"), (baseline, "average_precision", 0, "baseline"), (baseline, "roc_auc", 1, "baseline"),
        (recency, "lift_at_20pct", 2, "baseline"), (value_baseline, "mae", 3, "baseline"),
    )
    cells = [
        frame.select(F.lit(place).alias("place"), F.lit(side).alias("side"), F.col(name).cast("double").alias("number"))
        for frame, name, place, side in wanted
    ]

    def side(name: str) -> Column:
        return F.max(F.when(F.col("side") == name, F.col("number"))).alias(name)

    wide = reduce(DataFrame.unionByName, cells).groupBy("place").agg(side("value"), side("baseline"))
    names = F.lit([metric for metric, _, _ in MODEL_METRICS])
    labels = F.lit([label for _, label, _ in MODEL_METRICS])
    units = F.lit([unit for _, _, unit in MODEL_METRICS])
    at = F.col("place") + 1
    return wide.orderBy("place").select(
        F.element_at(names, at).alias("metric"), F.element_at(labels, at).alias("label"), "value", "baseline",
        F.element_at(units, at).alias("unit"), F.lit("held_out_test").alias("split"),
    )
