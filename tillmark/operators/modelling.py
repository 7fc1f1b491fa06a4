"""Chronological model selection, held-out evaluation and final refit with MLlib.

Model families are compared by metric, not by prediction: Spark's trees grow by
depth, without a leaf limit or an L2 penalty on leaf values.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint, stored
from .metrics import (
    classification_metrics,
    fit_baselines,
    regression_metrics,
    require_evaluable,
    scorer_metrics,
    split_population,
)
from .model_store import ModelStore, fingerprint, shared_store
from .ordered import global_rank
from .snapshot import INACTIVE_LABEL, Track

KEYS = ("customer_id", "snapshot_date")
# A ranking without probabilities has these metrics only.
RANKING_COLUMNS = ("average_precision", "precision_at_20pct", "lift_at_20pct")
ROUNDS = {"margin": 120, "revenue": 160}
_TREES = dict(maxDepth=4, minInstancesPerNode=35, stepSize=0.05, maxBins=255)


@dataclass(frozen=True)
class Constant:
    """A fitted baseline: the same prediction for every row."""

    value: float

    def predict(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.lit(float(self.value)))


@dataclass(frozen=True)
class Fitted:
    """A fitted MLlib pipeline; ``output`` reads its prediction."""

    model: PipelineModel
    output: str

    def predict(self, df: DataFrame, name: str) -> DataFrame:
        scored = self.model.transform(df.drop(VECTOR))
        value = vector_to_array("probability")[1] if self.output == "probability" else F.col("prediction")
        return scored.select(*df.columns, value.alias(name))


VECTOR = "raw_features"
# Rows of a task while models are fitted; small panels are one task.
ROWS_PER_TASK = 50_000


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR)


def _fit(stages: list, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Fit on vectors that ``training_frame`` has assembled, or assemble them; the result assembles its own."""
    assembler = _assembler(features)
    frame = train if VECTOR in train.columns else assembler.transform(train)
    return PipelineModel([assembler, *Pipeline(stages=stages).fit(frame).stages])


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 1500) -> Fitted:
    """Standardised logistic regression with unit inverse penalty."""
    rows = train.count()
    scaler = StandardScaler(inputCol=VECTOR, outputCol="features", withMean=True)
    learner = LogisticRegression(
        labelCol=label, featuresCol="features", maxIter=max_iter, regParam=1.0 / rows, standardization=False
    )
    return Fitted(_fit([scaler, learner], train, features), "probability")


def fit_boosted_classifier(train: DataFrame, features: Sequence[str], label: str, rounds: int, seed: int) -> Fitted:
    learner = GBTClassifier(labelCol=label, featuresCol=VECTOR, maxIter=rounds, seed=seed, **_TREES)
    return Fitted(_fit([learner], train, features), "probability")


def fit_boosted_regressor(train: DataFrame, features: Sequence[str], label: str, rounds: int, seed: int) -> Fitted:
    learner = GBTRegressor(labelCol=label, featuresCol=VECTOR, maxIter=rounds, seed=seed, **_TREES)
    return Fitted(_fit([learner], train, features), "prediction")


def fit_classifier(name: str, train: DataFrame, track: Track, rounds: int, seed: int) -> Constant | Fitted:
    if name == "prior_baseline":
        return Constant(fit_baselines(train, INACTIVE_LABEL, track.value_label)[0])
    if name == "logistic_regression":
        return fit_logistic(train, track.features, INACTIVE_LABEL)
    return fit_boosted_classifier(train, track.features, INACTIVE_LABEL, rounds, seed)


def fit_value_model(name: str, train: DataFrame, track: Track, rounds: int, seed: int) -> Constant | Fitted:
    if name == "mean_baseline":
        return Constant(fit_baselines(train, INACTIVE_LABEL, track.value_label)[1])
    return fit_boosted_regressor(train, track.features, track.value_label, rounds, seed)


CLASSIFIERS = ("prior_baseline", "logistic_regression", "gradient_boosting")
VALUE_MODELS = ("mean_baseline", "gradient_boosting")
BASELINES = (CLASSIFIERS[0], VALUE_MODELS[0])
# What a model is fitted on.
SCOPES = {"train": ("train",), "development": ("train", "validation"), "all": ("train", "validation", "test")}


def training_frame(panel: DataFrame, features: Sequence[str]) -> DataFrame:
    """The labelled panel with its feature vectors, written once: every boosting round reads it again."""
    frame = checkpoint(_assembler(features).transform(panel))
    return frame.coalesce(frame.count() // ROWS_PER_TASK + 1)


class ModelRun:
    """Candidates of one panel and one set of settings; each is fitted once, also across queries of a cluster.

    Models and metric rows live in ``folder`` (by default below the shared
    checkpoint folder) under a fingerprint of the panel's rows and the settings.
    """

    def __init__(self, panel: DataFrame, track: Track, rounds: int | None = None, seed: int = 42, folder: str | None = None):
        self.track, self.rounds, self.seed = track, rounds or ROUNDS[track.name], seed
        self.panel = training_frame(panel, track.features)
        columns = [*KEYS, "split", INACTIVE_LABEL, track.value_label, "recency_days", *track.features]
        settings = {"track": track.name, "rounds": self.rounds, "seed": seed, "trees": _TREES, "version": panel.sparkSession.version}
        self.mark = fingerprint(self.panel, sorted(set(columns)), settings)
        spark = panel.sparkSession
        self.store = ModelStore(spark, f"{folder or shared_store(spark)}/{self.mark}")

    def rows(self, scope: str) -> DataFrame:
        return self.panel.where(F.col("split").isin(*SCOPES.get(scope, (scope,))))

    def classifier(self, name: str, scope: str) -> Constant | Fitted:
        def fit() -> Constant | Fitted:
            return fit_classifier(name, self.rows(scope), self.track, self.rounds, self.seed)

        if name in BASELINES:
            return fit()
        return Fitted(self.store.model(f"risk-{name}-{scope}", lambda: fit().model), "probability")

    def value_model(self, name: str, scope: str) -> Constant | Fitted:
        def fit() -> Constant | Fitted:
            return fit_value_model(name, self.rows(scope), self.track, self.rounds, self.seed)

        if name in BASELINES:
            return fit()
        return Fitted(self.store.model(f"value-{name}-{scope}", lambda: fit().model), "prediction")

    def _predicted(self, models: dict[str, Constant | Fitted], label: str) -> DataFrame:
        """Predictions of every candidate for the validation rows, with the candidate's name."""
        validation = self.rows("validation")
        return _stack([
            model.predict(validation, "predicted").select(*KEYS, label, "predicted", F.lit(name).alias("model"))
            for name, model in models.items()
        ])

    def risk_table(self) -> DataFrame:
        """Validation metrics of the risk candidates, one row each."""
        def made() -> DataFrame:
            models = {name: self.classifier(name, "train") for name in CLASSIFIERS}
            return classification_metrics(self._predicted(models, INACTIVE_LABEL), INACTIVE_LABEL, "predicted", ["model"])

        return self.store.table("risk-validation", made)

    def value_table(self) -> DataFrame:
        """Validation metrics of the value candidates, one row each."""
        def made() -> DataFrame:
            models = {name: self.value_model(name, "train") for name in VALUE_MODELS}
            label = self.track.value_label
            return regression_metrics(self._predicted(models, label), label, "predicted", ["model"])

        return self.store.table("value-validation", made)

    def risk_name(self) -> str:
        """The risk candidate of the highest validation AP; of equal ones the simpler."""
        return max(self.risk_table().collect(), key=lambda r: (r["average_precision"], -CLASSIFIERS.index(r["model"])))["model"]

    def value_name(self) -> str:
        """The value candidate of the lowest validation MAE; of equal ones the simpler."""
        return min(self.value_table().collect(), key=lambda r: (r["mae"], VALUE_MODELS.index(r["model"])))["model"]


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


def permutation_importance(
    model: Constant | Fitted, test: DataFrame, features: Sequence[str], label: str, repeats: int = 3, seed: int = 42
) -> DataFrame:
    """Mean and deviation of the AP lost when one feature is shuffled, largest first.

    Rows get a random but repeatable place (rank of a seeded hash). A shuffled
    column takes its value from the row a fixed number of places further, different
    for each feature and repeat. Values are looked up one by one in a long table
    (place, feature), so only the changed value of each row, feature and repeat
    moves; the row itself moves once. All shuffles are scored and measured in one pass.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in KEYS]))
    rows = test.select(*KEYS, label, *features).withColumn("_draw", draw)
    placed = checkpoint(global_rank(rows, [F.col("_draw"), *map(F.col, KEYS)], name="_place").drop("_draw"))
    total = placed.count()
    chance = random.Random(seed)
    plans = [(name, turn, chance.randrange(1, max(total, 2))) for name in features for turn in range(repeats)]
    plan = F.array(*[
        F.struct(F.lit(n).alias("feature"), F.lit(t).alias("turn"), F.lit(s).cast("bigint").alias("shift")) for n, t, s in plans
    ])
    values = placed.select(
        F.col("_place").alias("_donor"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])).alias("given"),
    ).select("_donor", "given.*")
    swapped = stored(
        placed.select("_place", F.explode(plan).alias("plan"))
        .select("_place", "plan.feature", "plan.turn", ((F.col("_place") - 1 + F.col("plan.shift")) % total + 1).alias("_donor"))
        .join(values, ["_donor", "feature"])
        .groupBy("_place").agg(F.collect_list(F.struct("feature", "turn", "value")).alias("swaps"))
    )
    as_is = F.struct(F.lit("").alias("feature"), F.lit(0).alias("turn"), F.lit(None).cast("double").alias("value"))
    shuffled = (
        placed.join(swapped, "_place", "left")
        .select(*KEYS, label, *features, F.explode(F.concat(F.array(as_is), F.coalesce("swaps", F.array().cast("array<struct<feature:string,turn:int,value:double>>")))).alias("swap"))
        .select(
            *KEYS, label, "swap.feature", "swap.turn",
            *[F.when(F.col("swap.feature") == f, F.col("swap.value")).otherwise(F.col(f)).alias(f) for f in features],
        )
    )
    scored = model.predict(shuffled, "predicted")
    precision = checkpoint(
        classification_metrics(scored, label, "predicted", ["feature", "turn"]).select("feature", "average_precision")
    )
    whole = precision.where(F.col("feature") == "").first()["average_precision"]
    lost = F.lit(whole) - F.col("average_precision")
    return (
        precision.where(F.col("feature") != "")
        .groupBy("feature")
        .agg(F.avg(lost).alias("average_precision_drop"), F.stddev_pop(lost).alias("std"))
        .orderBy(F.desc("average_precision_drop"), "feature")
    )


@dataclass(frozen=True)
class Evaluation:
    """Everything a run publishes about its models."""

    scores: DataFrame
    predictions: DataFrame
    importance: DataFrame
    validation_risk: DataFrame
    validation_value: DataFrame
    test_risk: DataFrame
    test_risk_baseline: DataFrame
    test_recency: DataFrame
    test_value: DataFrame
    test_value_baseline: DataFrame
    classifier_name: str
    value_model_name: str
    classifier: Constant | Fitted
    value_model: Constant | Fitted


def risk_columns(track: Track) -> tuple[str, str]:
    return "inactive_risk90", "expected_margin90" if track.name == "margin" else "expected_revenue90"


def recency_ranking(test: DataFrame) -> DataFrame:
    """Longest absence first, a ranking without probabilities."""
    metrics = classification_metrics(test, INACTIVE_LABEL, "recency_days")
    return metrics.select(*RANKING_COLUMNS)


def fit_evaluate(
    panel: DataFrame, scoring: DataFrame, track: Track, rounds: int | None = None, seed: int = 42, repeats: int = 3
) -> Evaluation:
    """Select on validation, refit on train and validation, report on test, refit on all, score.

    ``panel`` carries a ``split`` column with train, validation and test.
    """
    run = ModelRun(panel, track, rounds, seed)
    panel = run.panel
    require_evaluable(split_population(panel, INACTIVE_LABEL))
    test, development = run.rows("test"), run.rows("development")
    risk_name, value_name = run.risk_name(), run.value_name()
    classifier, value_model = run.classifier(risk_name, "development"), run.value_model(value_name, "development")
    value_output = f"predicted_{track.name}90"
    predicted = value_model.predict(classifier.predict(test, "predicted_risk"), value_output)
    predictions = checkpoint(
        predicted.select(*KEYS, INACTIVE_LABEL, track.value_label, "recency_days", "predicted_risk", value_output)
    )
    prior, mean = fit_baselines(development, INACTIVE_LABEL, track.value_label)
    ranked = checkpoint(
        scorer_metrics(
            predictions,
            INACTIVE_LABEL,
            {"model": F.col("predicted_risk"), "prior": F.lit(prior), "recency": F.col("recency_days")},
        )
    )

    def ranking(scorer: str) -> DataFrame:
        return ranked.where(F.col("scorer") == scorer).drop("scorer")

    final_risk, final_value = run.classifier(risk_name, "all"), run.value_model(value_name, "all")
    risk, value = risk_columns(track)
    return Evaluation(
        scores=final_value.predict(final_risk.predict(scoring, risk), value),
        predictions=predictions.drop("recency_days"),
        importance=permutation_importance(classifier, test, track.features, INACTIVE_LABEL, repeats, seed),
        validation_risk=run.risk_table(),
        validation_value=run.value_table(),
        test_risk=ranking("model"),
        test_risk_baseline=ranking("prior"),
        test_recency=ranking("recency").select(*RANKING_COLUMNS),
        test_value=regression_metrics(predictions, track.value_label, value_output),
        test_value_baseline=regression_metrics(
            predictions.withColumn("_mean", F.lit(mean)), track.value_label, "_mean"
        ),
        classifier_name=risk_name,
        value_model_name=value_name,
        classifier=final_risk,
        value_model=final_value,
    )


def save_models(evaluation: Evaluation, path: str, track: Track, score_cutoff: str, source: str) -> None:
    """Both models below ``path`` with the feature list, cutoff and source as JSON."""
    spark = evaluation.predictions.sparkSession
    described = {"features": list(track.features), "score_cutoff": score_cutoff, "source": source}
    for part, name, model in (
        ("classifier", evaluation.classifier_name, evaluation.classifier),
        ("value_model", evaluation.value_model_name, evaluation.value_model),
    ):
        described[part] = {"name": name}
        if isinstance(model, Constant):
            described[part]["constant"] = model.value
        else:
            model.model.write().overwrite().save(f"{path}/{part}")
            described[part]["output"] = model.output
    text = spark.createDataFrame([(json.dumps(described),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_models(spark, path: str) -> tuple[Constant | Fitted, Constant | Fitted, dict]:
    described = json.loads(spark.read.text(f"{path}/metadata").first()["value"])

    def one(part: str) -> Constant | Fitted:
        if "constant" in described[part]:
            return Constant(described[part]["constant"])
        return Fitted(PipelineModel.load(f"{path}/{part}"), described[part]["output"])

    return one("classifier"), one("value_model"), described


