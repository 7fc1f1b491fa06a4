import datetime
import hashlib
import io
import json
import os
import re
from contextlib import redirect_stdout

import pytest
from conftest import event
from pyspark.sql import functions as F

from tillmark.operators import affinity, campaign, constraints, marts, measures, reports, snapshot
from tillmark.operators import quality as q
from tillmark.plans import registry, tracks
from tillmark.session import ensure_checkpoint_dir
from tillmark.sources import calendar, files, tables

SCORES = (
    "customer_id string, snapshot_date string, segment string, city string, top_category string, top_brand string, "
    "recency_days double, inactive_risk90 double, expected_margin90 double, marketing_consent boolean, "
    "identity_review_required boolean"
)


def scores(spark, count=7, **changes):
    rows = []
    for i in range(count):
        row = ["C%d" % i, "2026-04-01", "Sadık müşteri", "Bursa", "Care", "House", 60.0, 0.8, 1000.0, True, False]
        for position, value in changes.get(f"c{i}", {}).items():
            row[position] = value
        rows.append(tuple(row))
    return spark.createDataFrame(rows, SCORES)


def test_candidates_leave_out_opt_out_conflict_loss_and_recent(spark):
    df = scores(spark, c0={9: False}, c1={10: True}, c2={8: -10.0}, c3={6: 5.0})
    rows = campaign.campaign_candidates(df, capacity=3).collect()
    assert {r["customer_id"] for r in rows} == {"C4", "C5", "C6"}
    assert {r["experiment_group"] for r in rows} == {"treatment", "control"}
    again = campaign.campaign_candidates(df.repartition(5), capacity=3).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.mark.parametrize("count", [1, 2, 3, 12, 13, 150])
def test_control_group_size(spark, count):
    groups = [r["experiment_group"] for r in campaign.campaign_candidates(scores(spark, count)).collect()]
    if count < 2:
        assert groups == ["insufficient_sample"]
    else:
        assert groups.count("control") == min(count - 1, max(1, round(count * 0.2)))


def test_campaign_and_scenario_parameters(spark):
    with pytest.raises(ValueError):
        campaign.campaign_candidates(scores(spark), capacity=0)
    with pytest.raises(ValueError):
        campaign.ltv_factor(retention=1.2)
    value = spark.range(1).select(campaign.ltv_scenario(F.lit(100.0), 0, 0.1, 12)).first()[0]
    assert value == pytest.approx(100 / 1.1)


def test_affinity_breaks_ties_by_name(events):
    rows = [
        event("A", "2025-01-01", category="b", brand="x", product_id="9"),
        event("B", "2025-01-02", category="a", brand="y", product_id="10"),
        event("C", "2023-01-02", category="old", brand="old", product_id="old", quantity=50),
        event("D", "2025-01-03", "return", category="z", quantity=50),
    ]
    row = affinity.customer_affinity(events(*rows), "2025-03-01").first()
    assert (row["top_category"], row["top_brand"], row["top_product_id"]) == ("a", "x", "10")


def test_score_measures_are_blank_over_two_snapshots(spark):
    rows = [("C1", "2025-01-01", 0.4, 10.0), ("C1", "2025-04-01", 0.6, 20.0)]
    df = spark.createDataFrame(rows, "customer_id string, snapshot_date string, inactive_risk90 double, expected_margin90 double")
    both = df.agg(measures.average_risk().alias("risk"), measures.expected_value().alias("value")).first()
    one = reports.latest_snapshot(df).agg(measures.average_risk().alias("risk"), measures.high_risk_customers().alias("high")).first()
    assert both["risk"] is None and both["value"] is None and (one["risk"], one["high"]) == (0.6, 1)


def test_every_contract_measure_has_an_aggregate():
    assert len(measures.REVENUE_MEASURES) == 21 and len(measures.MARGIN_MEASURES) + 1 == 15
    assert all(build() is not None for build in [*measures.REVENUE_MEASURES.values(), *measures.MARGIN_MEASURES.values()])


def test_contract():
    contract = {name: marts.contract_columns(ddl) for name, ddl in marts.REVENUE_CONTRACT.items()}
    bindings = ["dim_date.year_month", "[Net Revenue]", "customer_scores.segment"]
    names = list(measures.REVENUE_MEASURES)
    assert constraints.contract_findings(contract, marts.RELATIONSHIPS, bindings, names, listed_tables=list(contract), listed_measures=names) == []
    found = constraints.contract_findings(
        {"a": ["x", "x"], "b": ["y"]}, [("a.x", "b.z")], ["[Missing]", "b.q"], ["Known"], {"b": ["z"]}, ["a", "a", "b"],
        ["Known", "Lost"], {"Overview": ["card"], "Detail": []},
    )
    assert [rule for rule, _, _ in found] == [
        "bare page", "missing mart", "other header", "repeated column", "repeated table", "undefined measure", "unknown binding",
        "unknown binding", "unknown relationship end",
    ]


def test_top_products_keep_their_order_and_unknown_products(spark):
    from tillmark.operators.reports import top_products

    lines = spark.createDataFrame([(f"p{i}", 100 * i) for i in range(1, 12)], "product_id string, net_minor bigint")
    names = spark.createDataFrame([(f"p{i}", f"n{i}") for i in range(1, 10)], "product_id string, product_name string")
    found = [(r["product_id"], r["product_name"]) for r in top_products(lines, names).collect()]
    assert found == [("p11", None), ("p10", None)] + [(f"p{i}", f"n{i}") for i in range(9, 3, -1)]


def test_manifest_names_files_in_folders(spark, tmp_path):
    from tillmark.sources.files import input_manifest

    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.csv").write_text("1")
    (tmp_path / "a" / "x.csv").write_text("2")
    assert {r["file_name"] for r in input_manifest(spark, str(tmp_path)).collect()} == {"a/b/x.csv", "a/x.csv"}
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="No file"):
        input_manifest(spark, str(tmp_path / "none"))


def test_violations(spark):
    child = spark.createDataFrame([("1", 1), ("1", 2), ("9", 3), (None, 4)], "k string, n int")
    parent = spark.createDataFrame([("1",)], "k string")
    row = constraints.fk_violations([("child.k", child, "k", parent, "k")]).first()
    assert (row["orphan_keys"], row["orphan_rows"]) == (1, 1)
    row = constraints.pk_violations({"child": (child, ["k"])}).first()
    assert (row["row_count"], row["duplicate_keys"], row["null_keys"]) == (4, 1, 1)
    row = constraints.check_violations(child, {"small": F.col("n") < 3, "known": F.col("k") == "1"}).collect()
    assert {r["rule"]: r["violations"] for r in row} == {"small": 2, "known": 1}


def test_delimited_round_trip(spark, tmp_path):
    rows = [("a,b", '"q"', ""), (" x ", "", "'"), ("İ", "=1", "\\")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    files.write_delimited(df, str(tmp_path / "t"))
    assert {tuple(r) for r in files.read_delimited(spark, str(tmp_path / "t"), ["a", "b", "c"]).collect()} == set(rows)


def test_export_text(spark, tmp_path):
    df = spark.createDataFrame([("=SUM(1)", 1.5), ('say "hi"; now', None)], "a string, b double")
    marts.write_export(df, str(tmp_path / "e"))
    text = "".join(open(tmp_path / "e" / f, encoding="utf-8").read() for f in sorted(os.listdir(tmp_path / "e")) if f.endswith(".csv"))
    assert "\"'=SUM(1)\";\"1.5\"" in text and '"say ""hi""; now";""' in text


def test_fingerprints(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("x")
    manifest = files.input_manifest(spark, str(tmp_path / "in"))
    digest = manifest.first()["sha256"]
    files.require_fingerprints(manifest, {"a.csv": digest})
    with pytest.raises(ValueError, match="a.csv"):
        files.require_fingerprints(manifest, {"a.csv": "0" * 64})


def test_load_refuses_bad_headers_and_filled_targets(spark, tmp_path):
    contract = {"dim": "k string, n int"}
    df = spark.createDataFrame([("", 1), ("b", 2)], "k string, n int")
    report = marts.load_tables(spark, {"dim": df}, contract, str(tmp_path / "db")).first()
    assert (report["rows_sent"], report["rows_loaded"]) == (2, 2)
    loaded = {tuple(r) for r in marts.read_mart(spark, str(tmp_path / "db"), "dim", contract).collect()}
    assert loaded == {(None, 1), ("b", 2)}
    with pytest.raises(ValueError, match="Column mismatch"):
        marts.load_tables(spark, {"dim": df.select("k")}, contract, str(tmp_path / "db2"))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        marts.load_tables(spark, {"dim": df}, contract, str(tmp_path / "db"))


def test_a_failed_load_leaves_nothing_visible(spark, tmp_path):
    contract = {"good": "k bigint", "bad": "k bigint"}
    good = spark.createDataFrame([(1,)], "k bigint")
    bad = spark.createDataFrame([("x",)], "k string")
    root = tmp_path / "db"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        marts.load_tables(spark, {"good": good, "bad": bad}, contract, str(root))
    assert not [x for x in root.rglob("*.parquet")] and not (root / "manifest").exists()
    assert marts.load_tables(spark, {"good": good, "bad": good}, contract, str(root)).count() == 2
    assert (root / "manifest").exists() and not list(root.glob("_staging*"))


def test_typed_text_marts_refuse_wrong_cells(spark, tmp_path):
    contract = {"dim_date": marts.MARGIN_CONTRACT["dim_date"]}
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "dim_date").write_text("date,year,month,year_month\n2020-02-29,2020,2,2020-02\n,2021,,\n")
    found = marts.read_delimited_mart(spark, str(tmp_path), "dim_date", contract)
    assert found.dtypes == [("date", "date"), ("year", "int"), ("month", "int"), ("year_month", "string")]
    assert sorted(found.collect(), key=str)[0]["year"] in (2020, 2021) and found.count() == 2
    path = str(tmp_path / "csv" / "dim_date")
    with open(path, "a") as lines:
        lines.write("2020-02-30,x,2,2020-02\n")
    rejected = [r["_rejected"] for r in files.read_typed(spark, path, contract["dim_date"]).collect()]
    assert [x for x in rejected if x] == ["2020-02-30,x,2,2020-02"]
    with pytest.raises(Exception, match="breaks its contract"):
        found.collect()


def test_fingerprint_of_a_file_beyond_two_gibibytes(spark, tmp_path):
    size = (2 << 30) + 5
    with open(tmp_path / "sparse.bin", "wb") as sparse:
        sparse.truncate(size)
    digest = hashlib.sha256()
    for _ in range(size >> 20):
        digest.update(bytes(1 << 20))
    digest.update(bytes(5))
    row = files.input_manifest(spark, str(tmp_path)).first()
    assert (row["file_name"], row["file_bytes"], row["sha256"]) == ("sparse.bin", size, digest.hexdigest())


def test_totals_beyond_64_bits(spark):
    rows = [(i, i, 1, 9 * 10**18, 9 * 10**18, "sale") for i in range(4)]
    events = spark.createDataFrame(rows, "order_id bigint, customer_id bigint, product_id bigint, net_minor bigint, margin_minor bigint, event_type string")
    assert reports.headline_cards(events).first()["net_revenue"] == 3.6e17
    assert events.agg(measures.net_revenue().alias("x"), measures.margin_rate().alias("y")).first() == (3.6e17, 1.0)


def test_the_slicer_shows_one_date(spark):
    table = spark.createDataFrame([("a", "2020-01-01", 1), ("a", "2020-04-01", 2)], "customer_id string, day string, n int")
    table = table.withColumn("snapshot_date", F.to_date("day"))
    assert [r["n"] for r in reports.at_snapshot(table).collect()] == [2]
    assert [r["n"] for r in reports.at_snapshot(table, "2020-01-01").collect()] == [1]


def test_the_scatter_holds_every_snapshot_apart(spark, small):
    found = registry.scatter_recency_value(spark, small).collect()
    keys = {(r["customer_id"], r["snapshot_date"]) for r in found}
    scored = registry.portfolio(spark, small, (registry.CONFIG.test_cutoff, registry.CONFIG.score_cutoff))
    assert len(found) == len(keys) and len({day for _, day in keys}) == 2
    assert keys == {(r["customer_id"], r["snapshot_date"]) for r in scored.select("customer_id", "snapshot_date").collect()}


def test_json_refuses_nan(spark, tmp_path):
    with pytest.raises(ValueError, match="NaN"):
        marts.write_json(spark.createDataFrame([(float("nan"),)], "x double"), str(tmp_path / "j"))
    marts.write_json(spark.createDataFrame([("İ", None)], "t string, x double"), str(tmp_path / "ok"))
    lines = [x for f in (tmp_path / "ok").glob("*.json") for x in f.read_text(encoding="utf-8").splitlines()]
    assert [json.loads(x) for x in lines] == [{"t": "İ", "x": None}]


def test_calendar(events):
    days = calendar.calendar_days(events(event("A", "2024-02-27")), "2024-03-02").orderBy("date").collect()
    assert [str(r["date"]) for r in days] == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]
    assert days[-1]["year_month"] == "2024-03"


def test_one_row_star(spark):
    at = datetime.datetime(2011, 12, 1)
    fact = spark.createDataFrame(
        [("E", "O", "C", "P", at, "sale", 2100, 900)],
        "event_id string, order_id string, customer_id string, product_id string, event_time timestamp_ntz, "
        "event_type string, net_minor bigint, margin_minor bigint",
    )
    row = reports.monthly_performance(fact).first()
    assert (row["year_month"], row["net_revenue"], row["sale_orders"], row["purchasing_customers"]) == ("2011-12", 21.0, 1, 1)


def test_margin_run_from_files(spark, small, tmp_path):
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for name, df in (
        ("customers", tables.customer_records(spark, small)),
        ("products", tables.raw_products(spark, small).select(*files.INPUT_COLUMNS["products"])),
        ("events", tables.raw_events(spark, small)),
    ):
        files.write_delimited(df, f"{folder}/{name}.csv")
    run = tracks.run_margin_files(
        spark, folder, registry.CONFIG, out, shared=registry.RETURN_FIELDS, limits=registry.LIMITS, rounds=2
    )
    assert run.summary["scored_customers"] > 30
    for name, ddl in marts.MARGIN_CONTRACT.items():
        mart = marts.read_mart(spark, f"{out}/marts", name, marts.MARGIN_CONTRACT)
        assert mart.count() > 0 and mart.columns[: len(marts.contract_columns(ddl))] == marts.contract_columns(ddl)
    events = q.clean_events(
        tables.raw_events(spark, small), tables.raw_products(spark, small),
        registry.identity_audit(spark, small), registry.CONFIG.observed_until, registry.RETURN_FIELDS,
    ).accepted
    assert marts.read_mart(spark, f"{out}/marts", "fact_sales", marts.MARGIN_CONTRACT).count() == events.count()
    assert os.path.isdir(f"{out}/reports/run_manifest")


def test_revenue_run(spark, small, tmp_path):
    run = tracks.run_revenue_track(
        spark, tables.raw_line_parts(spark, small), tables.LINE_ORDER, registry.CONFIG, str(tmp_path / "out"), rounds=2
    )
    for name in marts.REVENUE_CONTRACT:
        assert marts.read_mart(spark, f"{tmp_path}/out/marts", name, marts.REVENUE_CONTRACT).count() > 0
    metric = marts.read_mart(spark, f"{tmp_path}/out/marts", "model_metrics", marts.REVENUE_CONTRACT)
    shown = metric.agg(measures.REVENUE_MEASURES["Held-out Average Precision"]().alias("ap")).first()["ap"]
    assert shown == pytest.approx(run.evaluation.test_risk.first()["average_precision"])


def test_checkpoints_follow_the_session(spark):
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() is not None




@pytest.mark.parametrize("name", ["labeled_snapshots", "return_reference_check", "identity_audit", "cohort_retention",
                                  "customer_affinity", "classification_metrics", "enrich_events", "sales_star"])
def test_plans_have_no_cross_join_and_no_python(spark, small, name):
    text = io.StringIO()
    with redirect_stdout(text):
        registry.QUERIES[name](spark, small).explain("formatted")
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|EvalPython|InPandas", text.getvalue())


def test_filters_and_columns_reach_the_scan(spark, small, monkeypatch):
    text = io.StringIO()
    monkeypatch.setattr(snapshot, "stored", lambda df: df)  # the plan of the orders, which else are written first
    with redirect_stdout(text):
        registry.QUERIES["snapshot_labels"](spark, small).explain("formatted")
    plan = text.getvalue()
    # One scan of the lines; no lower bound, since the first sale of all counts.
    assert "LessThan(o_orderdate" in plan and plan.count("ReadSchema: struct<l_orderkey") == 1
    assert "l_tax" not in plan and "o_totalprice" not in plan and "p_name" not in plan
