"""Cleaning that goes over its rows in turns: the same results with less on disk at a time."""

import random
import time

import pytest
from conftest import event
from pyspark.sql import functions as F

from tillmark.operators import quality
from tillmark.operators.dedup import drop_exact_duplicates
from tillmark.operators.ordered import global_rank, ranges
from tillmark.session import discard, stored, stored_in_turn
from tillmark.sources import tables

RAW = (
    "event_id", "order_id", "customer_record_id", "product_id", "event_time", "event_type", "quantity", "unit_price",
    "discount_rate", "unit_cost", "channel", "origin_event_id",
)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def goes_away(spark, kept):
    """Files are deleted in the background, so they get some seconds."""
    for _ in range(100):
        if not shuffle_files(spark) - kept:
            return True
        time.sleep(0.1)
    return False


@pytest.fixture
def raw_rows(spark):
    """Sales, returns that fit, returns that do not, copies, unknown keys and orders without an id."""
    chance, rows = random.Random(5), []
    for i in range(40):
        sale = event(f"S{i:02d}", "2024-03-05", quantity=4, order=f"O{i}")
        rows.append(sale)
        for j in range(chance.randrange(4)):
            rows.append(event(f"R{i:02d}-{j}", f"2024-03-0{6 + j}", "return", f"S{i:02d}", chance.randrange(1, 4), order=f"O{i}"))
        if i % 5 == 0:
            rows += [sale, dict(event(f"U{i:02d}", "2024-03-06"), product_id="nowhere"), dict(event(f"N{i:02d}", "2024-03-06"), order_id=None)]
        if i % 7 == 0:
            rows.append(dict(event(f"X{i:02d}", "2024-03-06"), customer_record_id=None))
    cells = [tuple(None if r[c] is None else str(r[c]) for c in RAW) for r in rows]
    return spark.createDataFrame(cells, ", ".join(f"{c} string" for c in RAW)).repartition(5)


def cleaned_all(spark, raw):
    products = spark.createDataFrame([("P1", "Care", "House")], "product_id string, category string, brand string")
    mapping = spark.createDataFrame([("R1", "C1")], "record_id string, customer_id string")
    cleaned = quality.clean_events(raw, products, mapping, "2024-04-01")
    report = quality.quality_report(cleaned)
    return (
        sorted(map(tuple, cleaned.accepted.collect())), sorted(map(str, cleaned.quarantine.collect())), report.first(),
        quality.reason_counts(cleaned.quarantine).orderBy("reason").collect(), cleaned.accepted.columns, cleaned.quarantine.columns,
    )


def test_events_cleaned_in_turns_equal_those_of_one(spark, raw_rows, monkeypatch):
    whole = cleaned_all(spark, raw_rows)
    monkeypatch.setattr(quality, "SLICE_ROWS", 10)
    assert cleaned_all(spark, raw_rows) == whole
    report = whole[2]
    assert report["reconciled"] and report["exact_duplicates_removed"] == 8 and report["raw_rows"] == raw_rows.count()


def test_cleaning_leaves_no_shuffle_files(spark, raw_rows, monkeypatch):
    monkeypatch.setattr(quality, "SLICE_ROWS", 10)
    products = spark.createDataFrame([("P1", "Care", "House")], "product_id string, category string, brand string")
    mapping = spark.createDataFrame([("R1", "C1")], "record_id string, customer_id string")
    before = shuffle_files(spark)
    cleaned = quality.clean_events(raw_rows, products, mapping, "2024-04-01")
    assert goes_away(spark, before)
    assert cleaned.accepted.count() > 0
    before = shuffle_files(spark)
    lines = quality.clean_lines(line_parts(spark)[0], ["at", "then"])
    assert goes_away(spark, before)
    assert lines.accepted.count() > 0


LINES = "Invoice string, StockCode string, Description string, Quantity string, InvoiceDate string, Price string, `Customer ID` string, Country string, at int, then int"


def line_parts(spark):
    """Two parts that overlap; the position is null, repeated or skewed, and ties go by the second column."""
    chance, parts, rows = random.Random(3), {}, {}
    for name in ("Year 2009-2010", "Year 2010-2011"):
        rows[name] = [
            (f"{chance.randrange(30)}", "S", "Cup", f"{chance.randrange(1, 3)}", "2010-01-01", "1.5", chance.choice(["7.0", None]), None,
             None if i < 3 else 50 if i < 40 else chance.randrange(100), i)
            for i in range(120)
        ]
        mixed = chance.sample(rows[name], len(rows[name]))
        parts[name] = spark.createDataFrame(mixed, LINES).repartition(3)
    return parts, rows


def test_lines_numbered_in_turns_keep_their_places(spark, monkeypatch):
    parts, rows = line_parts(spark)
    expected, first, copies = set(), {}, {}
    for name, held in rows.items():
        held = sorted(held, key=lambda r: (r[8] is not None, r[8] or 0, r[9]))
        for number, r in enumerate(held, 2):
            expected.add((name, number, r[8], r[9]))
            first.setdefault(r[:8], (name, number))
            copies[r[:8]] = copies.get(r[:8], 0) + 1
    for most in (1_000_000, 50):
        monkeypatch.setattr(quality, "SLICE_ROWS", most)
        numbered = quality.union_with_provenance(parts, ["at", "then"])
        assert {(r["source_sheet"], r["source_row"], r["at"], r["then"]) for r in numbered.collect()} == expected
        assert set(numbered.columns) == {*parts["Year 2009-2010"].columns, "source_sheet", "source_row"}
        cleaned = quality.clean_lines(parts, ["at", "then"])
        assert cleaned.raw_rows == 240
        found = {(r["source_sheet"], r["source_row"]): r["_copies"] for r in cleaned.screened.collect()}
        assert found == {first[k]: n for k, n in copies.items()}
        quality.require_reconciled(quality.quality_report(cleaned, quality.revenue_quality_columns()))


def test_lines_without_rows(spark, monkeypatch):
    monkeypatch.setattr(quality, "SLICE_ROWS", 1)
    empty = {"A": spark.createDataFrame([], LINES)}
    cleaned = quality.clean_lines(empty, ["at", "then"])
    assert (cleaned.raw_rows, cleaned.accepted.count(), cleaned.quarantine.count()) == (0, 0, 0)


def test_lines_ordered_by_text_take_one_turn(spark, monkeypatch):
    monkeypatch.setattr(quality, "SLICE_ROWS", 1)
    rows = [(f"{i}", "S", "Cup", "1", "2010-01-01", "1.5", "7", "UK", i, 0) for i in range(12)]
    numbered = quality.union_with_provenance({"A": spark.createDataFrame(rows, LINES)}, ["Invoice"])
    found = {r["Invoice"]: r["source_row"] for r in numbered.collect()}
    assert found == {name: place for place, name in enumerate(sorted(str(i) for i in range(12)), 2)}


def test_rank_in_turns(spark):
    values = [None, None, -5, 0, 0, 1, 7, 7, 7, 9]
    df = spark.createDataFrame([(g, v, i) for g in "ab" for i, v in enumerate(values)], "g string, v int, i int")
    found = {(r["g"], r["i"]): r["rank"] for r in global_rank(df, [F.col("v"), F.col("i")], ["g"], turns=ranges("v", [0, 7])).collect()}
    assert found == {(g, i): i + 1 for g in "ab" for i in range(len(values))}


def test_stored_in_turn_and_discarded(spark):
    df = stored_in_turn(spark.range(i, i + 2) for i in (0, 10, 20))
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 10, 11, 20, 21]
    other = stored(spark.range(3))
    discard(df)
    assert spark.read.schema("id long").parquet(*other.inputFiles()).count() == 3
    with pytest.raises(Exception, match="(?i)not.exist|FILE_NOT_EXIST|FileNotFound"):
        df.collect()


def test_copies_of_raw_events_are_found_without_another_shuffle(spark, tmp_path):
    """The rows of an order lie together since its lines met it: the plan moves lines and orders, nothing else."""
    day = "timestamp_ntz'1996-01-02 00:00:00'"
    spark.range(50).selectExpr("id as o_orderkey", "id % 7 as o_custkey", "'O' as o_orderstatus", "1.0d as o_totalprice", f"{day} as o_orderdate", "'5' as o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(200).selectExpr(
        "id % 50 as l_orderkey", "id % 9 as l_partkey", "id % 5 as l_suppkey", "cast(id % 4 as int) as l_linenumber", "2.0d as l_quantity", "30.0d as l_extendedprice",
        "0.1d as l_discount", "0.0d as l_tax", "if(id % 3 = 0, 'R', 'N') as l_returnflag", "'F' as l_linestatus", f"{day} as l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    raw = tables.raw_events(spark, str(tmp_path))
    apart = drop_exact_duplicates(raw, "n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = drop_exact_duplicates(raw, "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2
    firsts = {}
    for r in raw.where("event_type = 'sale'").collect():
        firsts[r["order_id"]] = min(r["event_id"], firsts.get(r["order_id"], r["event_id"]))
    for r in apart.collect():
        assert r["origin_event_id"] == (firsts.get(r["order_id"], "") if r["event_type"] == "return" else "")
    assert apart.agg(F.sum("n")).first()[0] == raw.count()
