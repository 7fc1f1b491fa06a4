"""Quarantine with a single first-match reason, accounting and reconciliation."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import moment
from ..functions.values import (
    first_reason,
    is_finite,
    is_whole,
    lenient_number,
    lenient_timestamp,
    strip,
)
from ..session import brief_shuffles, discard, stored, stored_in_turn
from ..sources.tables import with_accounting, with_plain_revenue
from .constraints import assert_unique
from .dedup import drop_exact_duplicates, keep_first
from .ordered import global_rank, ranges
from .returns import SHARED_FIELDS, accepted_returns

# Accepted domains of the margin track.
EVENT_TYPES = ("sale", "return", "cancelled")
CHANNELS = ("online", "store")
# The columns a revenue-track part must have; equal rows on them are duplicates.
LINE_COLUMNS = (
    "Country", "Customer ID", "Description", "Invoice", "InvoiceDate", "Price", "Quantity", "StockCode",
)
# Metric, label, unit and status of the quality mart; the last status depends on the run.
QUALITY_METRICS = (
    ("raw_rows", "Raw transaction rows", "rows", "observed"),
    ("exact_duplicates_removed", "Exact duplicates removed", "rows", "observed"),
    ("quarantined_rows", "Quarantined rows", "rows", "observed"),
    ("accepted_rows", "Accepted transaction rows", "rows", "observed"),
    ("known_customers", "Identified customers", "customers", "observed"),
    ("products", "Distinct products", "products", "observed"),
    ("sale_orders", "Sale orders", "orders", "observed"),
    ("return_rows", "Return rows", "rows", "observed"),
    ("zero_price_rows_accepted", "Accepted zero-price rows", "rows", "review"),
    ("reconciled", "Row reconciliation", "boolean", "pass or fail"),
)
_NUMBERS = ("quantity", "unit_price", "discount_rate", "unit_cost")
# Equal input rows behind a screened row.
COPIES = "_copies"
# Work on many rows goes in turns: so many rows in one, and no more turns than these for events and lines.
SLICE_ROWS = 1_000_000
EVENT_TURNS = 6
LINE_TURNS = 4
# Position of a row over all sheets: sheet times this plus row, a decimal with room for both.
_SHEET_STEP = 10**19


@dataclass(frozen=True)
class Cleaned:
    """Outcome of a cleaning run: every screened row is either accepted or quarantined.

    ``screened`` carries the number of equal input rows of each row; ``raw_rows``
    was counted on the input itself.
    """

    accepted: DataFrame
    quarantine: DataFrame
    screened: DataFrame
    raw_rows: int


# ---------------------------------------------------------------- margin track


def _margin_rules(observed_until: str) -> list[tuple[str, Column]]:
    quantity, price = F.col("quantity"), F.col("unit_price")
    known_type = F.coalesce(F.col("event_type").isin(*EVENT_TYPES), F.lit(False))
    known_channel = F.coalesce(F.col("channel").isin(*CHANNELS), F.lit(False))
    discount_ok = F.coalesce(F.col("discount_rate").between(0, 1), F.lit(False))
    return [
        ("unknown_customer", F.col("customer_id").isNull()),
        ("unknown_product", F.col("_product_known").isNull()),
        ("invalid_timestamp", F.col("event_time").isNull()),
        ("after_observation_end", F.col("event_time") >= moment(observed_until)),
        ("invalid_type", ~known_type),
        ("invalid_channel", ~known_channel),
        ("invalid_number", ~is_finite(*[F.col(c) for c in _NUMBERS])),
        ("invalid_quantity", (quantity <= 0) | ~is_whole(quantity)),
        ("invalid_price_or_discount", (price <= 0) | (F.col("unit_cost") < 0) | ~discount_ok),
    ]


def screen_events(raw: DataFrame, products: DataFrame, mapping: DataFrame, observed_until: str) -> DataFrame:
    """Deduplicated events with typed cells, dimension columns and ``rejection_reason`` (null if good).

    The dimension joins that tell unknown keys also bring customer, category
    and brand, so an accepted row needs no further join. Return references are
    not judged here.
    """
    events = drop_exact_duplicates(raw.fillna({"origin_event_id": ""}), COPIES)
    keys = ["product_id", "customer_record_id"]
    columns = [*keys, *[c for c in events.columns if c not in keys], "customer_id", "category", "brand"]
    events = events.withColumns(
        {"event_time": lenient_timestamp(F.col("event_time")), **{c: lenient_number(F.col(c)) for c in _NUMBERS}}
    )
    people = mapping.select(F.col("record_id").alias("customer_record_id"), "customer_id")
    goods = products.select("product_id", "category", "brand", F.lit(True).alias("_product_known"))
    # Customers come last: rows then lie by customer, which packs better than by product.
    events = events.join(goods, "product_id", "left").join(people, "customer_record_id", "left")
    return events.select(*columns, first_reason(_margin_rules(observed_until)).alias("rejection_reason"))


def _hash_slices(df: DataFrame, keys: Sequence[str], slices: int) -> list[DataFrame]:
    """Rows dealt by a hash of their keys, equal keys to one slice; fractions are left out, as 0 equals -0."""
    hashed = [c for c in keys if not isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))]
    if slices < 2 or not hashed:
        return [df]
    at = F.pmod(F.xxhash64(*[F.col(c) for c in hashed]), F.lit(slices))
    return [df.where(at == i) for i in range(slices)]


def _turns(rows: int, most: int) -> int:
    return max(1, min(most, rows // SLICE_ROWS))


def clean_events(
    raw: DataFrame,
    products: DataFrame,
    mapping: DataFrame,
    observed_until: str,
    shared: Sequence[str] = SHARED_FIELDS,
    check_keys: bool = True,
) -> Cleaned:
    """Split raw margin-track events into accepted (signed, priced) and quarantined rows."""
    mapping = stored(mapping.select("record_id", "customer_id"))
    if check_keys:
        assert_unique(products, ["product_id"], "product_id must be unique.")
        assert_unique(mapping, ["record_id"], "record_id must be unique.")
    with brief_shuffles(raw.sparkSession):
        raw_rows = raw.count()
    # Copies have one order id, so slices by it can be cleaned one after another.
    turns = _turns(raw_rows, EVENT_TURNS)
    screened = stored_in_turn(
        screen_events(part, products, mapping, observed_until) for part in _hash_slices(raw, ["order_id"], turns)
    )
    if check_keys:
        assert_unique(screened, ["event_id"], "Conflicting rows share an event_id; reconcile the source.")
    good = F.col("rejection_reason").isNull()
    open_return = good & F.coalesce(F.col("event_type") == "return", F.lit(False))
    # Returns are decided once; only they take part in the join with the verdicts.
    passed = accepted_returns(screened.where(good), shared, (turns + 1) // 2).withColumn("_passed", F.lit(True))
    returns = (
        screened.where(open_return)
        .join(passed, "event_id", "left")
        .withColumn("rejection_reason", F.when(F.col("_passed").isNull(), "invalid_return_reference"))
        .drop("_passed")
    )
    judged = screened.where(~open_return).unionByName(returns)
    return Cleaned(
        accepted=with_accounting(judged.where(good).drop("rejection_reason", COPIES)),
        quarantine=judged.where(~good).drop(COPIES),
        screened=screened,
        raw_rows=raw_rows,
    )


# --------------------------------------------------------------- revenue track


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Input is missing columns: {missing}")


def _tagged(parts: Mapping[str, DataFrame]) -> DataFrame:
    """All parts as one frame with ``source_sheet``."""
    tagged = [df.withColumn("source_sheet", F.lit(name)) for name, df in parts.items()]
    rows = tagged[0]
    for part in tagged[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def _measured(parts: Mapping[str, DataFrame], order: Sequence[str]) -> tuple[int, list]:
    """Rows of the parts, and values of the first order column that cut many rows into ranges of about equal size."""
    rows = _tagged(parts)
    kind = rows.schema[order[0]].dataType
    known = isinstance(kind, (T.IntegralType, T.FractionalType, T.DateType, T.TimestampType, T.TimestampNTZType))
    steps = math.lcm(*range(1, LINE_TURNS + 1))
    cuts = F.percentile_approx(order[0], [i / steps for i in range(1, steps)], 1000) if known else F.lit(None)
    with brief_shuffles(rows.sparkSession):
        found = rows.agg(F.count("*").alias("rows"), cuts.alias("cuts")).first()
    few = _turns(found["rows"], LINE_TURNS)
    at = [found["cuts"][steps * i // few - 1] for i in range(1, few)] if found["cuts"] else []
    return found["rows"], sorted({x for x in at if x == x})


def union_with_provenance(
    parts: Mapping[str, DataFrame], order: Sequence[str], cuts: Sequence | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """All parts as one frame with ``source_sheet`` and ``source_row``.

    Rows are numbered from 2 inside their part (row 1 is a header) along
    ``order``, which must be total; its columns are kept unless ``columns`` names
    others. ``cuts`` part the first order column into ranges that are numbered one
    after another; they are found where none are given.
    """
    if cuts is None:
        _, cuts = _measured(parts, order)
    ranked = global_rank(
        _tagged(parts), [F.col(c) for c in order], ["source_sheet"], "source_row", ranges(order[0], cuts),
        [*columns, "source_sheet"] if columns else None,
    )
    return ranked.withColumn("source_row", F.col("source_row") + 1)


def first_lines(raw: DataFrame, sheets: Sequence[str]) -> DataFrame:
    """Drop rows equal on all business columns, keeping the first by part and row."""
    require_columns(raw, LINE_COLUMNS)
    ordinal = F.array_position(F.lit(list(sheets)), F.col("source_sheet")) - 1
    step = F.lit(str(_SHEET_STEP)).cast("decimal(20,0)")
    position = (ordinal.cast("decimal(10,0)") * step + F.col("source_row").cast("decimal(19,0)")).cast("decimal(38,0)")
    kept = keep_first(raw.select(*LINE_COLUMNS, position.alias("_position")), LINE_COLUMNS, "_position", COPIES)
    place = F.call_function("div", F.col("_position"), step)
    row = (F.col("_position") - (place.cast("decimal(10,0)") * step).cast("decimal(38,0)")).cast("bigint")
    return kept.withColumns({"source_sheet": F.element_at(F.lit(list(sheets)), place.cast("int") + 1), "source_row": row}).drop("_position")


def screen_lines(lines: DataFrame) -> DataFrame:
    """Typed lines with ``quarantine_reason`` (null if good)."""
    typed = lines.withColumns(
        {
            "InvoiceDate": lenient_timestamp(F.col("InvoiceDate")),
            "Quantity": lenient_number(F.col("Quantity")),
            "Price": lenient_number(F.col("Price")),
            "Customer ID": lenient_number(F.col("Customer ID")),
        }
    )
    invoice, stock = strip(F.col("Invoice").cast("string")), strip(F.col("StockCode").cast("string"))
    rules = [
        ("missing_customer_id", F.col("Customer ID").isNull()),
        ("invalid_invoice_date", F.col("InvoiceDate").isNull()),
        ("missing_invoice", invoice.isNull() | (invoice == "")),
        ("missing_stock_code", stock.isNull() | (stock == "")),
        ("invalid_quantity", F.col("Quantity").isNull() | (F.col("Quantity") == 0)),
        ("invalid_price", F.col("Price").isNull() | (F.col("Price") < 0)),
        ("positive_cancellation", F.upper(invoice).startswith("C") & (F.col("Quantity") > 0)),
    ]
    return typed.withColumn("quarantine_reason", first_reason(rules))


def type_and_key(lines: DataFrame, prefix: str = "UCI-") -> DataFrame:
    """Event columns of accepted lines: type by sign, text keys, plain revenue."""
    span = F.regexp_extract("source_sheet", r"(\d{4}-\d{4})", 1)
    sheet = F.when(span == "", "sheet").otherwise(span)
    events = lines.select(
        F.concat(F.lit(prefix), sheet, F.lit("-"), F.col("source_row").cast("string")).alias("event_id"),
        strip(F.col("Invoice").cast("string")).alias("order_id"),
        F.concat(F.lit(prefix), F.col("Customer ID").cast("bigint").cast("string")).alias("customer_id"),
        strip(F.col("StockCode").cast("string")).alias("product_id"),
        strip(F.coalesce("Description", F.lit("Description unavailable"))).alias("product_name"),
        strip(F.coalesce("Country", F.lit("Unknown"))).alias("country"),
        F.col("InvoiceDate").alias("event_time"),
        F.when(F.col("Quantity") < 0, "return").otherwise("sale").alias("event_type"),
        F.col("Quantity").cast("bigint").alias("signed_quantity"),
        F.col("Price").alias("unit_price"),
    )
    return with_plain_revenue(events)


def clean_lines(parts: Mapping[str, DataFrame], order: Sequence[str], prefix: str = "UCI-") -> Cleaned:
    """Union, deduplicate, quarantine and type the revenue-track parts."""
    for part in parts.values():
        require_columns(part, LINE_COLUMNS)
    raw_rows, cuts = _measured(parts, order)
    lines = union_with_provenance(parts, order, cuts, LINE_COLUMNS)
    slices = _hash_slices(lines, LINE_COLUMNS, len(cuts) + 1)
    screened = stored_in_turn(screen_lines(first_lines(rows, list(parts))) for rows in slices)
    discard(lines)
    good = F.col("quarantine_reason").isNull()
    return Cleaned(
        accepted=type_and_key(screened.where(good), prefix),
        quarantine=screened.where(~good).drop(COPIES),
        screened=screened,
        raw_rows=raw_rows,
    )


def most_frequent(events: DataFrame, key: str, value: str) -> DataFrame:
    """Per ``key`` the most frequent ``value``, the smallest one on ties."""
    counted = events.groupBy(key, value).agg(F.count("*").alias("_n")).where(F.col(value).isNotNull())
    return counted.groupBy(key).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


# --------------------------------------------------------------------- reports


def reason_counts(quarantine: DataFrame, column: str = "rejection_reason") -> DataFrame:
    return quarantine.groupBy(F.col(column).alias("reason")).agg(F.count("*").alias("row_count"))


def quality_report(cleaned: Cleaned, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """One row that reconciles raw = duplicates removed + quarantined + accepted rows.

    All four are counted apart: input rows on the input, duplicates where they were
    removed, the others in what came out, so a row lost in between is noticed.
    ``extra`` adds aggregates over the accepted rows.
    """
    extra = extra or {}
    accepted = cleaned.accepted.agg(
        F.count("*").alias("accepted_rows"),
        F.count(F.when(F.col("event_type") == "return", 1)).alias("return_rows"),
        F.count(F.when(F.col("event_type") == "cancelled", 1)).alias("cancelled_rows"),
        *[expr.alias(name) for name, expr in extra.items()],
    )
    # One-row tables become one row by summing their union.
    parts = accepted
    quarantined = cleaned.quarantine.agg(F.count("*").alias("quarantined_rows"))
    repeated = cleaned.screened.agg(F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("removed"))
    for counted in (quarantined, repeated):
        parts = parts.unionByName(counted, allowMissingColumns=True)
    totals = parts.agg(*[F.sum(c).alias(c) for c in parts.columns]).withColumn("raw_rows", F.lit(cleaned.raw_rows).cast("bigint"))
    removed = F.col("removed")
    balanced = F.col("raw_rows") == removed + F.col("quarantined_rows") + F.col("accepted_rows")
    return totals.select(
        "raw_rows",
        removed.alias("exact_duplicates_removed"),
        "quarantined_rows",
        "accepted_rows",
        "return_rows",
        "cancelled_rows",
        *extra,
        balanced.alias("reconciled"),
    )


def require_reconciled(report: DataFrame) -> None:
    if not report.first()["reconciled"]:
        raise ValueError("Raw rows do not equal duplicates, quarantined and accepted rows.")


def revenue_quality_columns() -> dict[str, Column]:
    """Accepted-row counts of the revenue track for :func:`quality_report`."""
    return {
        "known_customers": F.count_distinct("customer_id"),
        "products": F.count_distinct("product_id"),
        "sale_orders": F.count_distinct(F.when(F.col("event_type") == "sale", F.col("order_id"))),
        "zero_price_rows_accepted": F.count(F.when(F.col("unit_price") == 0, 1)),
    }


def quality_metrics_mart(report: DataFrame, reasons: DataFrame) -> DataFrame:
    """Long form of the quality report with labels, units and statuses, one more row per reason."""
    rows = []
    for metric, label, unit, status in QUALITY_METRICS:
        state = F.when(F.col("reconciled"), "pass").otherwise("fail") if metric == "reconciled" else F.lit(status)
        rows.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.lit(label).alias("label"),
                F.col(metric).cast("bigint").alias("value"),
                F.lit(unit).alias("unit"),
                state.alias("status"),
            )
        )
    fixed = report.select(F.inline(F.array(*rows)))
    by_reason = reasons.select(
        F.concat(F.lit("quarantine_"), F.col("reason")).alias("metric"),
        F.concat(F.lit("Quarantine: "), F.replace("reason", F.lit("_"), F.lit(" "))).alias("label"),
        F.col("row_count").alias("value"),
        F.lit("rows").alias("unit"),
        F.lit("observed").alias("status"),
    )
    return fixed.unionByName(by_reason)
