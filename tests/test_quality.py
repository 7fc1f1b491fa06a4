import dataclasses
import datetime
import random

import pytest
from conftest import event
from pyspark.sql import functions as F

from tillmark.functions import values
from tillmark.operators import quality
from tillmark.operators.dedup import keep_first
from tillmark.operators.returns import accepted_returns, matching_returns

RAW = (
    "event_id", "order_id", "customer_record_id", "product_id", "event_time", "event_type", "quantity", "unit_price",
    "discount_rate", "unit_cost", "channel", "origin_event_id",
)


@pytest.fixture
def dims(spark):
    products = spark.createDataFrame([("P1", "Care", "House")], "product_id string, category string, brand string")
    mapping = spark.createDataFrame([("R1", "C1")], "record_id string, customer_id string")
    return products, mapping


def raw(spark, *rows):
    cells = [tuple(None if r[c] is None else str(r[c]) for c in RAW) for r in rows]
    return spark.createDataFrame(cells, ", ".join(f"{c} string" for c in RAW))


def test_every_raw_row_ends_in_one_place(spark, dims):
    kept = event("K", "2024-03-05", quantity=5, unit_price=30.0, unit_cost=10.0)
    part = event("P", "2024-03-09", "return", "K", quantity=3, unit_price=30.0, unit_cost=10.0, order=kept["order_id"])
    stray = dict(event("U", "2024-03-06"), product_id="nowhere")
    late = event("L", "2024-09-01")
    rows = [kept, part, stray, kept, late, kept, stray]
    cleaned = quality.clean_events(raw(spark, *rows), *dims, "2024-04-01")
    assert {r["event_id"]: (r["net_revenue"], r["gross_margin"]) for r in cleaned.accepted.collect()} == {"K": (150.0, 100.0), "P": (-90.0, -60.0)}
    assert sorted(r["event_id"] for r in cleaned.quarantine.collect()) == ["L", "U"]
    report = quality.quality_report(cleaned).first()
    assert (report["exact_duplicates_removed"], report["quarantined_rows"], report["reconciled"]) == (3, 2, True)
    quality.require_reconciled(quality.quality_report(cleaned))


def test_conflicting_event_id_is_refused(spark, dims):
    rows = raw(spark, event("S1", "2025-01-01"), event("S1", "2025-01-01", quantity=2))
    with pytest.raises(ValueError, match="Conflicting"):
        quality.clean_events(rows, *dims, "2025-02-01")


def test_repeated_product_is_refused(spark, dims):
    products, mapping = dims
    with pytest.raises(ValueError, match="product_id"):
        quality.clean_events(raw(spark, event("S1", "2025-01-01")), products.union(products), mapping, "2025-02-01")


def test_first_matching_reason_wins(spark, dims):
    base = event("S", "2025-01-01")
    cases = {
        "unknown_customer": dict(customer_record_id="?", product_id="?", event_time="x"),
        "unknown_product": dict(product_id="?", event_time="x"),
        "invalid_timestamp": dict(event_time="x", event_type="gift"),
        "after_observation_end": dict(event_time="2025-02-01 00:00:00", event_type="gift"),
        "invalid_type": dict(event_type=None, channel="kiosk"),
        "invalid_channel": dict(channel=None, quantity="nan"),
        "invalid_number": dict(quantity="nan"),
        "invalid_quantity": dict(quantity="1.5", unit_price="0"),
        "invalid_price_or_discount": dict(discount_rate="1.01"),
        "invalid_return_reference": dict(event_type="return", origin_event_id="nowhere"),
    }
    rows = [dict(base, event_id=name, order_id=name, **changes) for name, changes in cases.items()]
    rows += [dict(base, event_id="inf", order_id="inf", unit_cost="inf"), dict(base, event_id="free", unit_price="0")]
    rows += [dict(base, event_id="negative", unit_cost="-1")]
    cleaned = quality.clean_events(raw(spark, base, *rows), *dims, "2025-02-01")
    found = {r["event_id"]: r["rejection_reason"] for r in cleaned.quarantine.collect()}
    expected = {name: name for name in cases} | {
        "inf": "invalid_number", "free": "invalid_price_or_discount", "negative": "invalid_price_or_discount",
    }
    assert found == expected
    assert [r["event_id"] for r in cleaned.accepted.collect()] == ["S"]


def test_cancelled_lines_carry_no_money(spark, dims):
    cleaned = quality.clean_events(raw(spark, event("X", "2025-01-01", "cancelled")), *dims, "2025-02-01")
    row = cleaned.accepted.first()
    assert (row["signed_quantity"], row["net_revenue"], row["gross_margin"]) == (0, 0.0, 0.0)


def test_margin_comes_from_rounded_revenue(spark, dims):
    rows = raw(spark, dict(event("X", "2025-01-01"), unit_price="1.015", unit_cost="0.333"))
    row = quality.clean_events(rows, *dims, "2025-02-01").accepted.first()
    assert (row["net_revenue"], row["gross_margin"]) == (1.01, 0.68)


def greedy(sale_quantity, items):
    left, taken = sale_quantity, set()
    for _, name, size in sorted(items):
        if size <= left:
            left -= size
            taken.add(name)
    return taken


def test_a_refused_return_uses_nothing_up(events):
    rows = [event("S", "2025-01-01", quantity=4, order="O")]
    for i, size in enumerate([2, 5, 1, 1]):
        rows.append(event(f"R{i}", f"2025-01-0{i + 2}", "return", "S", size, order="O"))
    assert {r["event_id"] for r in accepted_returns(events(*rows)).collect()} == {"R0", "R2", "R3"}


def test_static_conditions(events):
    sale = event("S", "2025-01-05", quantity=4, order="O")
    rows = [
        sale,
        event("EARLY", "2025-01-04", "return", "S", order="O"),
        event("PRICE", "2025-01-06", "return", "S", order="O", unit_price=99.0),
        event("ORDER", "2025-01-06", "return", "S", order="other"),
        event("BLANK", "2025-01-06", "return", "", order="O"),
        event("CHAIN", "2025-01-07", "return", "GOOD", order="O"),
        event("GOOD", "2025-01-05", "return", "S", order="O"),
    ]
    assert {r["event_id"] for r in matching_returns(events(*rows)).collect()} == {"GOOD"}


def test_greedy_returns_equal_brute_force_with_a_hot_sale(events):
    chance = random.Random(11)
    rows, expected = [], set()
    for s in range(12):
        sold = 300 if s == 0 else chance.randrange(1, 30)
        rows.append(event(f"S{s}", "2025-01-01", quantity=sold, order=f"O{s}"))
        items = []
        for i in range(700 if s == 0 else chance.randrange(0, 20)):
            size = chance.randrange(1, 40 if s == 0 else 12)
            name = f"R{s}-{i}"
            day = datetime.datetime(2025, 1, 2) + datetime.timedelta(hours=chance.randrange(200))
            items.append((day, name, size))
            rows.append(event(name, str(day), "return", f"S{s}", size, order=f"O{s}"))
        expected |= greedy(sold, items)
    assert {r["event_id"] for r in accepted_returns(events(*rows)).collect()} == expected


def test_a_sale_of_a_million_units(events):
    """100,000 returns of one sale that ask for more than it had: one pass over them, no growing state."""
    spark = events(event("S", "2025-01-01", quantity=1_000_000, order="O")).sparkSession
    sale = events(event("S", "2025-01-01", quantity=1_000_000, order="O"))
    one = events(event("R", "2025-01-02", "return", "S", 1, order="O")).drop("event_id", "quantity", "event_time")
    numbered = spark.range(100_000).select(
        F.format_string("R%06d", "id").alias("event_id"), (F.col("id") % 21 + 1).cast("double").alias("quantity"),
        (F.lit(datetime.datetime(2025, 1, 2)).cast("timestamp_ntz") + F.make_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("event_time"),
    )
    rows = sale.unionByName(numbered.crossJoin(one))
    found = {r["event_id"] for r in accepted_returns(rows).collect()}
    assert found == greedy(1_000_000, [(i, f"R{i:06d}", i % 21 + 1) for i in range(100_000)])


def test_returns_that_fit_together_need_no_order(events):
    rows = [event("S", "2025-01-01", quantity=6, order="O")]
    rows += [event(f"R{i}", "2025-01-02", "return", "S", size, order="O") for i, size in enumerate([1, 2, 3])]
    assert {r["event_id"] for r in accepted_returns(events(*rows)).collect()} == {"R0", "R1", "R2"}


def test_a_lost_row_breaks_the_reconciliation(spark, dims):
    rows = raw(spark, event("A", "2025-01-01"), event("B", "2025-01-02"), event("A", "2025-01-01"))
    cleaned = quality.clean_events(rows, *dims, "2025-02-01")
    quality.require_reconciled(quality.quality_report(cleaned))
    for lost in (
        dataclasses.replace(cleaned, accepted=cleaned.accepted.where("event_id <> 'B'")),
        dataclasses.replace(cleaned, screened=cleaned.screened.where("event_id <> 'A'")),
        dataclasses.replace(cleaned, raw_rows=4),
    ):
        with pytest.raises(ValueError, match="do not equal"):
            quality.require_reconciled(quality.quality_report(lost))


def test_rows_beyond_two_to_the_fortieth(spark):
    far = 2**41 + 7
    rows = [("UK", "7", "Cup", "100", "2010-01-01", "1.5", "2", "S", "b", far), ("UK", "7", "Cup", "100", "2010-01-01", "1.5", "2", "S", "b", far - 1),
            ("UK", "8", "Cup", "100", "2010-01-01", "1.5", "2", "S", "b", 2), ("UK", "8", "Cup", "100", "2010-01-01", "1.5", "2", "S", "a", far + 5)]
    df = spark.createDataFrame(rows, [*quality.LINE_COLUMNS, "source_sheet", "source_row"])
    found = {(r["Customer ID"], r["source_sheet"], r["source_row"], r["_copies"]) for r in quality.first_lines(df, ["a", "b"]).collect()}
    assert found == {("7", "b", far - 1, 2), ("8", "a", far + 5, 2)}


def test_keep_first_follows_the_position(spark):
    df = spark.createDataFrame(
        [("a", None, 3, "late"), ("a", None, 1, "first"), ("b", 1, 2, "only")], "k string, n int, at bigint, note string"
    )
    kept = {(r["k"], r["at"], r["note"]) for r in keep_first(df, ["k", "n"], "at").collect()}
    assert kept == {("a", 1, "first"), ("b", 2, "only")}


LINES = "Invoice string, StockCode string, Description string, Quantity string, InvoiceDate string, Price string, `Customer ID` string, Country string, at int"


def line(at, invoice="100", stock="S", text="Cup", quantity="2", day="2010-01-01 08:00:00", price="1.5", customer="7.0", country="UK"):
    return (invoice, stock, text, quantity, day, price, customer, country, at)


def test_lines_are_quarantined_typed_and_keyed(spark):
    parts = {
        "Year 2009-2010": [line(1), line(2), line(3, customer=None), line(4, invoice="c200", quantity="-1"),
                           line(5, invoice=" C300", quantity="4"), line(6, price="0", text=None, country=None)],
        "Extra": [line(1), line(2, stock="  "), line(3, quantity="0", day="bad"), line(4, price="-1"),
                  line(5, invoice=None), line(6, quantity="x"), line(7, invoice="900\t")],
    }
    frames = {name: spark.createDataFrame(rows, LINES) for name, rows in parts.items()}
    cleaned = quality.clean_lines(frames, ["at"])
    reasons = {(r["source_sheet"], r["source_row"]): r["quarantine_reason"] for r in cleaned.quarantine.collect()}
    assert reasons == {
        ("Year 2009-2010", 4): "missing_customer_id", ("Year 2009-2010", 6): "positive_cancellation",
        ("Extra", 3): "missing_stock_code", ("Extra", 4): "invalid_invoice_date", ("Extra", 5): "invalid_price",
        ("Extra", 6): "missing_invoice", ("Extra", 7): "invalid_quantity",
    }
    events = {r["event_id"]: r for r in cleaned.accepted.collect()}
    assert set(events) == {"UCI-2009-2010-2", "UCI-2009-2010-5", "UCI-2009-2010-7", "UCI-sheet-8"}
    assert events["UCI-2009-2010-5"]["event_type"] == "return" and events["UCI-2009-2010-5"]["net_revenue"] == -1.5
    free = events["UCI-2009-2010-7"]
    assert (free["product_name"], free["country"], free["unit_price"]) == ("Description unavailable", "Unknown", 0.0)
    assert events["UCI-sheet-8"]["order_id"] == "900" and events["UCI-sheet-8"]["customer_id"] == "UCI-7"
    report = quality.quality_report(cleaned, quality.revenue_quality_columns())
    row = report.first()
    assert (row["raw_rows"], row["exact_duplicates_removed"], row["zero_price_rows_accepted"]) == (13, 2, 1)
    mart = quality.quality_metrics_mart(report, quality.reason_counts(cleaned.quarantine, "quarantine_reason"))
    assert mart.columns == ["metric", "label", "value", "unit", "status"]
    marks = {r["metric"]: (r["value"], r["status"]) for r in mart.collect()}
    assert marks["reconciled"] == (1, "pass") and marks["quarantine_invalid_price"] == (1, "observed")


def test_missing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="missing columns"):
        quality.clean_lines({"A": spark.createDataFrame([("1",)], "Invoice string")}, ["Invoice"])


def test_most_frequent_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", "z"), ("b", "z"), ("b", "a")], "k string, v string")
    assert {tuple(r) for r in quality.most_frequent(df, "k", "v").collect()} == {("a", "x"), ("b", "z")}


def test_lenient_values(spark):
    df = spark.createDataFrame(
        [("1e3",), (" 5 ",), ("nan",), ("inf",), ("5d",), ("x",), ("",), (None,)], "t string"
    )
    rows = df.select("t", values.lenient_number(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in rows] == [1000.0, 5.0, None, float("inf"), None, None, None, None]
    finite = df.select(F.coalesce(values.is_finite(values.lenient_number(F.col("t"))), F.lit(False))).collect()
    assert [r[0] for r in finite] == [True, True] + [False] * 6


def test_text_helpers(spark):
    df = spark.createDataFrame([("  Ab\t",), ("=1+1",), (None,)], "t string")
    rows = df.select(
        values.fold(F.col("t")).alias("fold"), values.spreadsheet_safe(F.col("t")).alias("safe"),
        values.truth(F.col("t")).alias("truth"),
    ).collect()
    assert [r["fold"] for r in rows] == ["ab", "=1+1", ""]
    assert rows[1]["safe"] == "'=1+1" and rows[2]["safe"] == "" and not any(r["truth"] for r in rows)
