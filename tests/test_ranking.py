import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillmark.operators import metrics, modelling
from tillmark.operators.ordered import global_rank, rows_at_ranks, totals_so_far
from tillmark.operators.rfm import QUINTILE_SEGMENTS, fixed_segments, quintile_segments


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows share one value; ids are unique."""
    chance = random.Random(3)
    rows = [(i, 7 if chance.random() < 0.66 else chance.randrange(50), "g" + str(i % 3)) for i in range(3000)]
    return spark.createDataFrame(rows, "id bigint, v int, g string").repartition(5).cache(), rows


def test_global_rank(skewed):
    df, rows = skewed
    ranked = {r["id"]: r["rank"] for r in global_rank(df, [F.col("v"), F.col("id")]).collect()}
    assert ranked == {row[0]: i + 1 for i, row in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}


@pytest.mark.parametrize("group", [["g"], []])
def test_rank_and_totals_so_far(skewed, group):
    df, rows = skewed
    ranked = {r["id"]: r["rank"] for r in global_rank(df, [F.desc("v"), F.col("id")], group).collect()}
    summed = totals_so_far(df.withColumn("one", F.lit(1)), [F.desc("v"), F.col("id")], ["v", "one"], group)
    found = {r["id"]: (r["v_so_far"], r["one_so_far"], r["v_in_all"], r["one_in_all"]) for r in summed.collect()}
    for name in ("g0", "g1", "g2") if group else (None,):
        members, total = [r for r in rows if name in (None, r[2])], 0
        for place, row in enumerate(sorted(members, key=lambda r: (-r[1], r[0])), 1):
            total += row[1]
            assert ranked[row[0]] == place
            assert found[row[0]] == (total, place, sum(r[1] for r in members), len(members))


def test_totals_without_groups_need_no_join_and_no_constant_key(spark, skewed):
    df, _ = skewed
    plan = totals_so_far(df, [F.desc("v")], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SinglePartition" not in plan and "hashpartitioning(_part" in plan


def test_rows_at_ranks(skewed):
    df, rows = skewed
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    total, found = rows_at_ranks(df, [F.col("v"), F.col("id")], lambda n: [1, n // 2, n])
    assert total == 3000
    assert {rank: row["id"] for rank, row in found.items()} == {k: ordered[k - 1][0] for k in (1, 1500, 3000)}


def quintiles(values, reverse):
    if len(values) < 5:
        return [3] * len(values)
    score = pd.qcut(values.rank(method="first"), 5, labels=False).astype(int) + 1
    return list(6 - score if reverse else score)


@pytest.mark.parametrize("size", [3, 5, 7, 8, 12, 101])
def test_quintiles_equal_pandas(spark, size):
    chance = random.Random(size)
    rows = [(f"C{i:03}", float(chance.randrange(6)), chance.randrange(1, 4), chance.random() * 100, 200.0) for i in range(size)]
    names = ["customer_id", "recency_days", "frequency_365", "net_revenue_365", "tenure_days"]
    frame = pd.DataFrame(rows, columns=names)
    found = quintile_segments(spark.createDataFrame(rows, ", ".join(
        f"{n} {t}" for n, t in zip(names, ["string", "double", "bigint", "double", "double"])
    ))).orderBy("customer_id").toPandas()
    assert list(found.r_score) == quintiles(frame.recency_days, True)
    assert list(found.f_score) == quintiles(frame.frequency_365, False)
    assert list(found.m_score) == quintiles(frame.net_revenue_365, False)
    assert found.rfm_score.str.fullmatch("[1-5]{3}").all() and set(found.segment) <= set(QUINTILE_SEGMENTS)


def test_fixed_segments(spark):
    rows = [
        ("best", 10.0, 20, 30000.0, 500.0), ("lost", 120.0, 6, 100.0, 500.0), ("new", 20.0, 2, 100.0, 40.0),
        ("loyal", 80.0, 12, 100.0, 500.0), ("idle", 70.0, 1, 100.0, 500.0), ("growing", 50.0, 3, 100.0, 500.0),
    ]
    df = spark.createDataFrame(rows, "customer_id string, recency_days double, frequency_365 bigint, net_revenue_365 double, tenure_days double")
    found = {r["customer_id"]: (r["rfm_score"], r["segment"]) for r in fixed_segments(df).collect()}
    assert found == {
        "best": ("555", "Şampiyon"), "lost": ("131", "Geri kazanım adayı"), "new": ("421", "Yeni müşteri"),
        "loyal": ("241", "Sadık müşteri"), "idle": ("211", "İlgi gerekiyor"), "growing": ("321", "Gelişen müşteri"),
    }


def brute(rows):
    """Definitions over pairs and thresholds; rows are (label, score, key) in tie order."""
    positives = sum(y for y, _, _ in rows)
    negatives = len(rows) - positives
    precision_sum, seen_recall = 0.0, 0.0
    for threshold in sorted({s for _, s, _ in rows}, reverse=True):
        taken = [y for y, s, _ in rows if s >= threshold]
        recall = sum(taken) / positives
        precision_sum += (recall - seen_recall) * sum(taken) / len(taken)
        seen_recall = recall
    wins = sum((a > b) + 0.5 * (a == b) for y, a, _ in rows if y for z, b, _ in rows if not z)
    top = sorted(rows, key=lambda r: (-r[1], r[2]))[: max(1, math.ceil(len(rows) * 0.2))]
    precision = sum(y for y, _, _ in top) / len(top)
    return {
        "n": len(rows), "prevalence": positives / len(rows), "average_precision": precision_sum,
        "roc_auc": wins / (positives * negatives) if negatives else None,
        "brier": sum((s - y) ** 2 for y, s, _ in rows) / len(rows),
        "precision_at_20pct": precision, "lift_at_20pct": precision / (positives / len(rows)),
    }


def test_classification_metrics_equal_definitions(spark):
    chance = random.Random(8)
    rows = {
        "tied": [(chance.randrange(2), chance.randrange(5) / 4, i) for i in range(83)],
        "fine": [(int(chance.random() < 0.3), chance.random(), i) for i in range(120)],
        "flat": [(int(i % 3 == 0), 0.4, i) for i in range(50)],
        "one_class": [(1, chance.random(), i) for i in range(10)],
    }
    flat = [(g, y, s, k) for g, part in rows.items() for y, s, k in part]
    df = spark.createDataFrame(flat, "g string, y int, s double, k int")
    found = {row["g"]: row for row in metrics.classification_metrics(df, "y", "s", ["g"], ["k"]).collect()}
    assert set(found) == set(rows)
    for group, row in found.items():
        for name, value in brute(rows[group]).items():
            assert row[name] == (None if value is None else pytest.approx(value)), (group, name)
    for group in ("tied", "flat", "fine"):
        alone = metrics.classification_metrics(df.where(F.col("g") == group), "y", "s", (), ["k"]).first()
        assert alone.asDict() == pytest.approx({k: v for k, v in found[group].asDict().items() if k != "g"})
    assert metrics.classification_metrics(df.limit(0), "y", "s", (), ["k"]).count() == 0


def test_regression_metrics(spark):
    y, p = np.array([1.0, -2.0, 5.0, 4.0]), np.array([2.0, 0.0, 4.0, 4.5])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row["mae"] == pytest.approx(np.abs(y - p).mean())
    assert row["wape"] == pytest.approx(np.abs(y - p).sum() / np.abs(y).sum())
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert (row["actual_sum"], row["predicted_sum"]) == (8.0, 10.5) and row["bias"] == pytest.approx(10.5 / 8 - 1)
    zero = metrics.regression_metrics(spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y double, p double"), "y", "p").first()
    assert zero["wape"] is None and zero["r2"] == 0.0


def test_metric_mart(spark):
    one = lambda text, *values: spark.createDataFrame([values], text)
    mart = metrics.model_metrics_mart(
        one("average_precision double, roc_auc double, lift_at_20pct double", 0.7, 0.8, 1.5),
        one("average_precision double, roc_auc double", 0.4, 0.5),
        one("lift_at_20pct double", 1.2), one("mae double", 500.0), one("mae double", 800.0),
    ).collect()
    assert [r["metric"] for r in mart] == ["average_precision", "roc_auc", "lift_at_20pct", "revenue_mae"]
    assert {r["metric"]: r["baseline"] for r in mart}["lift_at_20pct"] == 1.2
    assert all(r["split"] == "held_out_test" for r in mart)


# ------------------------------------------------------------------------- models


@pytest.fixture(scope="module")
def panel(spark):
    """Signal in recency, none in the other features; three splits."""
    chance = random.Random(4)
    names = modelling.KEYS + tuple(f"f{i}" for i in range(2))
    rows = []
    for i in range(360):
        signal, noise = chance.random(), chance.random()
        label = int(chance.random() < 0.1 + 0.8 * signal)
        split = ("train", "validation", "test")[i % 3]
        rows.append((i, "2025-01-01", signal, noise, label, 100 * noise + chance.random(), signal * 180, split))
    text = "customer_id bigint, snapshot_date string, f0 double, f1 double, inactive_next90 int, margin_next90 double, recency_days double, split string"
    assert names[:2] == ("customer_id", "snapshot_date")
    return spark.createDataFrame(rows, text).cache()


@pytest.fixture(scope="module")
def track():
    from tillmark.operators.snapshot import Track

    return Track("margin", 2, ("f0", "f1"), "margin_minor", "margin_next90")


def test_population_guard(panel):
    population = metrics.split_population(panel, "inactive_next90")
    metrics.require_evaluable(population)
    with pytest.raises(ValueError, match="test"):
        metrics.require_evaluable(metrics.split_population(panel.where("split != 'test' or inactive_next90 = 1"), "inactive_next90"))


def test_baselines(panel):
    prior, mean = metrics.fit_baselines(panel, "inactive_next90", "margin_next90")
    frame = panel.toPandas()
    assert prior == pytest.approx(frame.inactive_next90.mean()) and mean == pytest.approx(frame.margin_next90.mean())


def test_importance_finds_the_signal_and_is_repeatable(panel, track):
    model = modelling.fit_logistic(panel.where("split = 'train'"), track.features, "inactive_next90")
    test = panel.where("split = 'test'")
    one = modelling.permutation_importance(model, test, track.features, "inactive_next90").collect()
    other = modelling.permutation_importance(model, test.repartition(7), track.features, "inactive_next90").collect()
    drops = {r["feature"]: r["average_precision_drop"] for r in one}
    assert drops["f0"] > 0.1 > abs(drops["f1"])
    assert drops == pytest.approx({r["feature"]: r["average_precision_drop"] for r in other})


def test_selection_evaluation_and_storage(spark, panel, track, tmp_path):
    result = modelling.fit_evaluate(panel, panel.drop("split"), track, rounds=3, repeats=1)
    assert result.classifier_name != "prior_baseline" and result.scores.count() == 360
    risk = result.scores.agg(F.min("inactive_risk90"), F.max("inactive_risk90")).first()
    assert 0 <= risk[0] < risk[1] <= 1
    assert result.test_risk.first()["average_precision"] > result.test_risk_baseline.first()["average_precision"]
    modelling.save_models(result, str(tmp_path / "models"), track, "2025-10-01", "test")
    classifier, value_model, described = modelling.load_models(spark, str(tmp_path / "models"))
    assert described["features"] == ["f0", "f1"] and described["score_cutoff"] == "2025-10-01"
    again = classifier.predict(panel.drop("split"), "inactive_risk90").agg(F.sum("inactive_risk90")).first()[0]
    assert again == pytest.approx(result.scores.agg(F.sum("inactive_risk90")).first()[0])
    assert value_model.predict(panel, "v").count() == 360


def test_candidates_are_fitted_once_per_panel(spark, panel, track, tmp_path, monkeypatch):
    def run(rows, rounds=3):
        return modelling.ModelRun(rows, track, rounds=rounds, folder=str(tmp_path / "store"))

    first = run(panel)
    name, value_name = first.risk_name(), first.value_name()
    table = {r["model"]: r["average_precision"] for r in first.risk_table().collect()}
    assert set(table) == set(modelling.CLASSIFIERS) and table[name] == max(table.values())
    scores = first.classifier(name, "development").predict(first.rows("test"), "p").agg(F.sum("p")).first()[0]
    fresh = modelling.fit_classifier(name, panel.where("split <> 'test'"), track, 3, 42).predict(panel.where("split = 'test'"), "p")
    assert scores == pytest.approx(fresh.agg(F.sum("p")).first()[0])

    def refuse(*_, **__):
        raise AssertionError("fitted again")

    for fit in ("fit_logistic", "fit_boosted_classifier", "fit_boosted_regressor"):
        monkeypatch.setattr(modelling, fit, refuse)
    again = run(panel.repartition(5))
    assert again.mark == first.mark and (again.risk_name(), again.value_name()) == (name, value_name)
    same = again.classifier(name, "development").predict(again.rows("test"), "p").agg(F.sum("p")).first()[0]
    assert same == pytest.approx(scores)
    assert run(panel.withColumn("f0", F.col("f0") + (F.col("customer_id") == 7).cast("int"))).mark != first.mark
    assert run(panel, 4).mark != first.mark


def test_a_failed_fit_leaves_nothing_in_the_store(spark, tmp_path):
    from tillmark.operators.model_store import ModelStore

    store = ModelStore(spark, str(tmp_path))
    with pytest.raises(ZeroDivisionError):
        store.model("m", lambda: 1 / 0)
    assert not store.has("m")
    made = [store.table("t", lambda n=n: spark.range(n)).count() for n in (3, 5)]
    assert made == [3, 3] and [x.name for x in tmp_path.iterdir()] == ["t"]
