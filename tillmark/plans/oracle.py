"""SQL twins of the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

from ..operators import campaign, rfm
from .registry import CONFIG, LIMITS, PERIOD


def _r2(x: str) -> str:
    """Nearest cent on the binary value, halves to even."""
    return f"(round_even(({x}) * 100, 0) / 100)"


def _minor(x: str, scale: int = 100) -> str:
    return f"CAST(round_even(({x}) * {scale}, 0) AS BIGINT)"


D = "CAST({} AS DOUBLE)".format
CENTS = "100::DOUBLE"
EVENT_ID = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'))"
)
PRICE = _r2("l_extendedprice / l_quantity")

# ---------------------------------------------------------------- canonical events

EV = f"""
priced AS (
  SELECT {EVENT_ID} AS event_id, l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
         CASE WHEN l_linestatus = 'F' THEN 'store' ELSE 'online' END AS channel, o_orderdate AS event_time,
         CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'sale' END AS event_type,
         l_quantity AS quantity, {PRICE} AS unit_price, l_discount AS discount_rate,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS signed_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
netted AS (
  SELECT *, {_r2("0.6::DOUBLE * unit_price")} AS unit_cost,
         {_minor("signed_quantity * unit_price * (1 - discount_rate)")} AS net_minor
  FROM priced),
ev AS (
  SELECT *, net_minor / {CENTS} AS net_revenue,
         {_minor("net_minor / 100::DOUBLE - signed_quantity * unit_cost")} AS margin_minor
  FROM netted),
rev AS (
  SELECT event_id, order_id, customer_id, product_id, event_time, event_type, signed_quantity, unit_price,
         {_minor("signed_quantity * unit_price", 10000)} AS net_minor
  FROM priced)"""
PRODUCTS = f"""
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         p_retailprice AS list_price, {_r2("0.6::DOUBLE * p_retailprice")} AS unit_cost FROM part)"""


def _sum(column: str, condition: str | None = None) -> str:
    filtered = f" FILTER (WHERE {condition})" if condition else ""
    return f"CAST(coalesce(sum({column}){filtered}, 0) AS BIGINT)"


def _money(column: str, condition: str | None = None, scale: int = 100) -> str:
    return f"{_sum(column, condition)} / {scale}::DOUBLE"


# ------------------------------------------------------------------------ identity

IDENTITY = """
records AS (
  SELECT CAST(c_custkey AS VARCHAR) AS record_id,
         CASE WHEN c_custkey % 7 <> 0 THEN 'c' || (c_custkey // 3) || '@example.invalid' ELSE '' END AS email,
         'p' || (c_custkey // 6) AS phone,
         CASE WHEN ((c_custkey // 3) % 4 = 0 AND c_custkey % 3 = 0) OR ((c_custkey // 3) % 4 = 1 AND c_custkey % 3 <= 1)
              THEN 'l' || c_custkey END AS loyalty,
         n_name AS city, c_custkey % 5 <> 0 AS consent
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
pairs AS (
  SELECT email, phone, count(DISTINCT loyalty) AS ids, min(loyalty) AS one_id
  FROM records WHERE email <> '' GROUP BY email, phone),
judged AS (
  SELECT r.*, coalesce(ids, 0) AS ids, one_id FROM records r LEFT JOIN pairs p ON r.email = p.email AND r.phone = p.phone),
keyed AS (
  SELECT *, CASE WHEN loyalty IS NOT NULL THEN 'loyalty:' || loyalty
                 WHEN email <> '' AND ids = 1 THEN 'loyalty:' || one_id
                 WHEN email <> '' AND ids = 0 THEN 'pair:(''' || email || ''', ''' || phone || ''')'
                 ELSE 'record:' || record_id END AS link,
         CASE WHEN loyalty IS NOT NULL THEN 'verified_loyalty'
              WHEN email <> '' AND ids = 1 THEN 'verified_pair_to_loyalty'
              WHEN email <> '' AND ids = 0 THEN 'verified_email_and_phone'
              ELSE 'unmerged_record' END AS match_rule
  FROM judged),
audit AS (
  SELECT record_id, 'C' || substr(sha256(link), 1, 16) AS customer_id, match_rule,
         ids > 1 AS identity_review_required, city, consent AS marketing_consent FROM keyed),
dim AS (
  SELECT customer_id, arg_min(city, record_id) AS city, bool_and(marketing_consent) AS marketing_consent,
         bool_or(identity_review_required) AS identity_review_required, count(*) AS source_records
  FROM audit GROUP BY customer_id)"""

# ---------------------------------------------------------------- raw margin events

RAW = f"""
base AS (
  SELECT {EVENT_ID} AS event_id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_custkey % 61 = 0 THEN 'X' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS customer_record_id,
         CASE WHEN l_partkey % 67 = 0 THEN 'X' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
         CASE WHEN l_orderkey % 71 = 0 THEN 'no time' ELSE
           strftime(CASE WHEN l_returnflag = 'R' THEN greatest(o_orderdate, l_shipdate) ELSE o_orderdate END,
                    '%Y-%m-%d %H:%M:%S') END AS event_time,
         CASE WHEN l_returnflag = 'R' THEN 'return' WHEN l_suppkey % 73 = 0 THEN 'gift'
              WHEN l_suppkey % 37 = 0 THEN 'cancelled' ELSE 'sale' END AS event_type,
         CASE WHEN l_partkey % 83 = 0 THEN 'n/a' WHEN l_partkey % 89 = 0 THEN '0' WHEN l_partkey % 97 = 0 THEN '2.5'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
         CASE WHEN l_partkey % 101 = 0 THEN '-1' ELSE CAST({PRICE} AS VARCHAR) END AS unit_price,
         CASE WHEN l_suppkey % 83 = 0 THEN '1.5' ELSE CAST(l_discount AS VARCHAR) END AS discount_rate,
         CAST({_r2(f"0.6::DOUBLE * {PRICE}")} AS VARCHAR) AS unit_cost,
         CASE WHEN l_suppkey % 79 = 0 THEN 'kiosk' WHEN l_linestatus = 'F' THEN 'store' ELSE 'online' END AS channel,
         l_orderkey % 50 = 0 AS copied
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
first_sales AS (SELECT order_id, min(event_id) AS first_sale_id FROM base WHERE event_type = 'sale' GROUP BY order_id),
uniq AS (
  SELECT base.*, CASE WHEN event_type = 'return' THEN coalesce(first_sale_id, '') ELSE '' END AS origin_event_id
  FROM base LEFT JOIN first_sales USING (order_id)),
raw AS (SELECT * FROM uniq UNION ALL SELECT * FROM uniq WHERE copied)"""
TYPED = f"""
cells AS (
  SELECT DISTINCT event_id, order_id, customer_record_id, product_id, event_type, channel, origin_event_id,
         TRY_CAST(event_time AS TIMESTAMP) AS event_time, TRY_CAST(quantity AS DOUBLE) AS quantity,
         TRY_CAST(unit_price AS DOUBLE) AS unit_price, TRY_CAST(discount_rate AS DOUBLE) AS discount_rate,
         TRY_CAST(unit_cost AS DOUBLE) AS unit_cost
  FROM raw),
screened AS (
  SELECT cells.*, audit.customer_id, p_type AS category, p_brand AS brand,
         CASE WHEN audit.record_id IS NULL THEN 'unknown_customer'
              WHEN p_partkey IS NULL THEN 'unknown_product'
              WHEN event_time IS NULL THEN 'invalid_timestamp'
              WHEN event_time >= TIMESTAMP '{CONFIG.observed_until}' THEN 'after_observation_end'
              WHEN event_type NOT IN ('sale', 'return', 'cancelled') THEN 'invalid_type'
              WHEN channel NOT IN ('online', 'store') THEN 'invalid_channel'
              WHEN quantity IS NULL OR unit_price IS NULL OR discount_rate IS NULL OR unit_cost IS NULL THEN 'invalid_number'
              WHEN quantity <= 0 OR quantity <> floor(quantity) THEN 'invalid_quantity'
              WHEN unit_price <= 0 OR unit_cost < 0 OR NOT discount_rate BETWEEN 0 AND 1 THEN 'invalid_price_or_discount'
         END AS static_reason
  FROM cells LEFT JOIN audit ON audit.record_id = customer_record_id
             LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = product_id)"""
# Returns of one sale, stepped in (time, id) order; a refused one uses nothing up.
GREEDY = """
queue AS (
  SELECT origin_event_id, event_id, quantity, sold,
         row_number() OVER (PARTITION BY origin_event_id ORDER BY event_time, event_id) AS place
  FROM candidates),
step AS (
  SELECT origin_event_id, event_id, place, quantity <= sold AS accepted,
         CASE WHEN quantity <= sold THEN quantity ELSE 0 END AS used
  FROM queue WHERE place = 1
  UNION ALL
  SELECT q.origin_event_id, q.event_id, q.place, s.used + q.quantity <= q.sold,
         s.used + CASE WHEN s.used + q.quantity <= q.sold THEN q.quantity ELSE 0 END
  FROM step s JOIN queue q ON q.origin_event_id = s.origin_event_id AND q.place = s.place + 1)"""
JUDGED = f"""
good AS (SELECT * FROM screened WHERE static_reason IS NULL),
candidates AS (
  SELECT r.origin_event_id, r.event_id, r.event_time, r.quantity, s.quantity AS sold
  FROM good r JOIN good s ON r.origin_event_id = s.event_id AND s.event_type = 'sale'
  WHERE r.event_type = 'return' AND r.event_time >= s.event_time
    AND r.customer_record_id = s.customer_record_id AND r.order_id = s.order_id),
{GREEDY.strip()},
outcome AS (
  SELECT screened.*, CASE WHEN static_reason IS NOT NULL THEN static_reason
                          WHEN event_type = 'return' AND NOT coalesce(step.accepted, false) THEN 'invalid_return_reference'
                     END AS rejection_reason
  FROM screened LEFT JOIN step ON step.event_id = screened.event_id)"""
CLEAN = f"WITH RECURSIVE {IDENTITY},{RAW},{TYPED},{JUDGED}"

# ------------------------------------------------------------------ revenue lines

LINES = f"""
line_rows AS (
  SELECT CASE WHEN l_orderkey % 89 = 0 THEN NULL WHEN l_returnflag = 'R' THEN ' c' || l_orderkey
              ELSE l_orderkey || chr(9) END AS "Invoice",
         CASE WHEN l_partkey % 97 = 0 THEN '  ' ELSE CAST(l_partkey AS VARCHAR) END AS "StockCode",
         CASE WHEN l_partkey % 11 <> 0 THEN ' ' || p_name END AS "Description",
         CASE WHEN l_suppkey % 53 = 0 THEN 'x' WHEN l_suppkey % 59 = 0 THEN '0'
              ELSE CAST(CAST(CASE WHEN l_returnflag = 'R' AND l_suppkey % 29 <> 0 THEN -l_quantity ELSE l_quantity END
                        AS INTEGER) AS VARCHAR) END AS "Quantity",
         CASE WHEN l_orderkey % 71 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS "InvoiceDate",
         CASE WHEN l_partkey % 83 = 0 THEN '0' WHEN l_partkey % 101 = 0 THEN '-2.5'
              ELSE CAST({PRICE} AS VARCHAR) END AS "Price",
         CASE WHEN o_custkey % 7 <> 0 THEN o_custkey || '.0' END AS "Customer ID",
         CASE WHEN o_custkey % 13 <> 0 THEN n_name END AS "Country",
         l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
       LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
sheets AS (
  SELECT 'Year 1995-1998' AS source_sheet, 0 AS sheet_no, * FROM line_rows WHERE o_orderdate < TIMESTAMP '1998-07-01'
  UNION ALL
  SELECT 'Year 1998-2001', 1, * FROM line_rows WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
numbered AS (
  SELECT *, 1 + row_number() OVER (PARTITION BY source_sheet
            ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS source_row
  FROM sheets),
firsts AS (
  SELECT * FROM numbered QUALIFY row_number() OVER (
    PARTITION BY "Country", "Customer ID", "Description", "Invoice", "InvoiceDate", "Price", "Quantity", "StockCode"
    ORDER BY sheet_no, source_row) = 1)"""
LINES_TYPED = f"""
line_cells AS (
  SELECT source_sheet, source_row, trim("Invoice", ' ' || chr(9)) AS invoice, trim("StockCode") AS stock,
         coalesce(trim("Description"), 'Description unavailable') AS product_name,
         coalesce(trim("Country"), 'Unknown') AS country,
         TRY_CAST("Quantity" AS DOUBLE) AS quantity, TRY_CAST("InvoiceDate" AS TIMESTAMP) AS event_time,
         TRY_CAST("Price" AS DOUBLE) AS price, TRY_CAST("Customer ID" AS DOUBLE) AS customer_number
  FROM firsts),
line_reasons AS (
  SELECT *, CASE WHEN customer_number IS NULL THEN 'missing_customer_id'
                 WHEN event_time IS NULL THEN 'invalid_invoice_date'
                 WHEN invoice IS NULL OR invoice = '' THEN 'missing_invoice'
                 WHEN stock IS NULL OR stock = '' THEN 'missing_stock_code'
                 WHEN quantity IS NULL OR quantity = 0 THEN 'invalid_quantity'
                 WHEN price IS NULL OR price < 0 THEN 'invalid_price'
                 WHEN upper(invoice) LIKE 'C%' AND quantity > 0 THEN 'positive_cancellation' END AS reason
  FROM line_cells),
line_events AS (
  SELECT 'UCI-' || substr(source_sheet, 6) || '-' || source_row AS event_id, invoice AS order_id,
         'UCI-' || CAST(customer_number AS BIGINT) AS customer_id, stock AS product_id, product_name, country, event_time,
         CASE WHEN quantity < 0 THEN 'return' ELSE 'sale' END AS event_type,
         CAST(quantity AS BIGINT) AS signed_quantity, price AS unit_price,
         {_minor("CAST(quantity AS BIGINT) * price", 10000)} / 10000::DOUBLE AS net_revenue
  FROM line_reasons WHERE reason IS NULL)"""
CLEAN_LINES = f"WITH {LINES},{LINES_TYPED}"
LINE_QUALITY = f"""{CLEAN_LINES},
counts AS (
  SELECT (SELECT count(*) FROM numbered) AS raw_rows,
         (SELECT count(*) FROM numbered) - (SELECT count(*) FROM firsts) AS exact_duplicates_removed,
         (SELECT count(*) FROM line_reasons WHERE reason IS NOT NULL) AS quarantined_rows,
         count(*) AS accepted_rows, count(DISTINCT customer_id) AS known_customers, count(DISTINCT product_id) AS products,
         count(DISTINCT CASE WHEN event_type = 'sale' THEN order_id END) AS sale_orders,
         count(*) FILTER (WHERE event_type = 'return') AS return_rows,
         count(*) FILTER (WHERE unit_price = 0) AS zero_price_rows_accepted
  FROM line_events)"""

# ----------------------------------------------------------------------- snapshots


def _cutoffs(cutoffs) -> str:
    rows = ", ".join(f"(TIMESTAMP '{c}')" for c in cutoffs)
    return f"cutoffs AS (SELECT * FROM (VALUES {rows}) AS t(c))"


def _days(start: str, end: str) -> str:
    return f"date_diff('microsecond', {start}, {end}) / 86400000000::DOUBLE"


PAST = "event_time >= c - INTERVAL 365 DAY AND event_time < c"
SOLD = f"{PAST} AND event_type = 'sale'"
RECENT = "event_time >= c - INTERVAL 90 DAY AND event_time < c"
PREVIOUS = "event_time >= c - INTERVAL 180 DAY AND event_time < c - INTERVAL 90 DAY"
FUTURE = "event_time >= c AND event_time < c + INTERVAL 90 DAY"


def _orders(condition: str) -> str:
    return f"count(DISTINCT order_id) FILTER (WHERE {condition})"


def _panel(cutoffs, revenue: bool = False) -> str:
    """Feature and label columns of every eligible customer as CTE ``panel``."""
    scale, value = ("10000::DOUBLE", "net_minor") if revenue else (CENTS, "margin_minor")
    shared = f"""max(event_time) FILTER (WHERE {SOLD}) AS last_sale,
         min(event_time) FILTER (WHERE event_type = 'sale' AND event_time < c) AS first_sale,
         {_orders(SOLD)} AS frequency_365, {_orders(RECENT + " AND event_type = 'sale'")} AS frequency_90,
         {_orders(PREVIOUS + " AND event_type = 'sale'")} AS frequency_previous90,
         {_sum("net_minor", PAST)} / {scale} AS net_revenue_365, {_sum("net_minor", RECENT)} / {scale} AS net_revenue_90,
         {_sum("net_minor", SOLD)} / {scale} AS gross_365,
         count(*) FILTER (WHERE {FUTURE} AND event_type = 'sale') AS future_sales,
         {_sum(value, FUTURE)} / {scale} AS value_next"""
    if revenue:
        source = "rev"
        own = f"""count(DISTINCT product_id) FILTER (WHERE {SOLD}) AS product_count,
         CAST(sum(signed_quantity) FILTER (WHERE {SOLD}) AS BIGINT) AS units_365,
         -{_sum("net_minor", PAST + " AND event_type = 'return'")} / CAST({_sum("net_minor", SOLD)} AS DOUBLE) AS raw_rate"""
        columns = """product_count, units_365,
         CASE WHEN gross_365 = 0 THEN 0 ELSE greatest(raw_rate, 0) END AS return_value_rate"""
    else:
        source = "ev LEFT JOIN products USING (product_id)"
        own = f"""{_sum("margin_minor", PAST)} / {CENTS} AS gross_margin_365,
         count(DISTINCT category) FILTER (WHERE {SOLD}) AS category_count,
         count(DISTINCT brand) FILTER (WHERE {SOLD}) AS brand_count,
         count(*) FILTER (WHERE {SOLD}) AS sale_lines,
         count(*) FILTER (WHERE {SOLD} AND channel = 'online') AS online_lines,
         count(*) FILTER (WHERE {SOLD} AND discount_rate > 0) AS discount_lines,
         sum(quantity) FILTER (WHERE {SOLD}) AS sold_units,
         coalesce(sum(quantity) FILTER (WHERE {PAST} AND event_type = 'return'), 0) AS returned_units"""
        columns = """gross_margin_365, category_count, brand_count,
         online_lines / sale_lines::DOUBLE AS online_share, discount_lines / sale_lines::DOUBLE AS discount_share,
         returned_units / sold_units AS return_unit_rate"""
    # Whole history up to the end of the last outcome window takes part.
    return f"""{EV},{PRODUCTS},{_cutoffs(cutoffs)},
sums AS (
  SELECT c, customer_id, {shared}, {own}
  FROM {source} JOIN cutoffs ON event_time < c + INTERVAL 90 DAY GROUP BY c, customer_id),
panel AS (
  SELECT customer_id, CAST(c AS DATE) AS snapshot_date, {_days("last_sale", "c")} AS recency_days,
         {_days("first_sale", "c")} AS tenure_days, frequency_365, frequency_90, frequency_previous90,
         net_revenue_365, net_revenue_90, gross_365 / frequency_365 AS average_order_value,
         {columns}, (frequency_90 + 1) / (frequency_previous90 + 1)::DOUBLE AS order_trend,
         CASE WHEN future_sales = 0 THEN 1 ELSE 0 END AS inactive_next90, value_next
  FROM sums WHERE last_sale IS NOT NULL AND {_days("last_sale", "c")} <= 180)"""


SPLIT = "CASE CAST(snapshot_date AS VARCHAR) " + " ".join(
    f"WHEN '{cutoff}' THEN '{name}'" for cutoff, name in CONFIG.splits.items()
) + " END"


def _graded(column: str, comparison: str, limits) -> str:
    cases = " ".join(f"WHEN {column} {comparison} {limit} THEN {5 - i}" for i, limit in enumerate(limits))
    return f"CASE {cases} ELSE 1 END"


def _segment(rules, names) -> str:
    cases = " ".join(f"WHEN {rule} THEN '{name}'" for rule, name in zip(rules, names))
    return f"CASE {cases} ELSE '{names[-1]}' END"


FIXED = f"""
graded AS (
  SELECT *, {_graded("recency_days", "<=", LIMITS.recency)} AS r_score,
         {_graded("frequency_365", ">=", LIMITS.frequency)} AS f_score,
         {_graded("net_revenue_365", ">=", LIMITS.money)} AS m_score FROM panel),
segmented AS (
  SELECT *, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score, {_segment([
      "r_score >= 4 AND f_score >= 4 AND m_score >= 4", "recency_days > 90 AND f_score >= 3",
      "tenure_days <= 60 AND frequency_365 <= 2", "f_score >= 4 AND recency_days <= 90", "recency_days > 60",
  ], rfm.FIXED_SEGMENTS)} AS segment FROM graded)"""


def _fifth(column: str) -> str:
    return f"""greatest(1, CAST(ceil((row_number() OVER (ORDER BY {column}, customer_id) - 1) * 5
            / (count(*) OVER () - 1)::DOUBLE) AS INTEGER))"""


QUINTILES = f"""
graded AS (
  SELECT *, 6 - {_fifth("recency_days")} AS r_score, {_fifth("frequency_365")} AS f_score,
         {_fifth("net_revenue_365")} AS m_score FROM panel),
segmented AS (
  SELECT *, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score, {_segment([
      "r_score >= 4 AND f_score >= 4 AND m_score >= 4", "r_score <= 2 AND f_score >= 4",
      "tenure_days <= 90 AND frequency_365 <= 2", "f_score >= 4 AND r_score >= 3", "r_score <= 2",
  ], rfm.QUINTILE_SEGMENTS)} AS segment FROM graded)"""
LTV_FACTOR = f"{campaign.ltv_factor()!r}::DOUBLE"
VALUE = _r2("gross_margin_365 * 90 / 365::DOUBLE")


def _portfolio(*cutoffs: str) -> str:
    """CTE ``scores``: segmented customers with the simple risk and value."""
    return f"""{_panel(cutoffs)},{FIXED},
valued AS (SELECT *, recency_days / 180::DOUBLE AS inactive_risk90, {VALUE} AS expected_margin90 FROM segmented),
scores AS (SELECT *, {_r2(f"expected_margin90 * {LTV_FACTOR} - 0")} AS ltv_3year_scenario FROM valued)"""


SCORE, TEST = CONFIG.score_cutoff, CONFIG.test_cutoff
HELD_OUT = f"""{_panel([TEST])},
held AS (SELECT *, recency_days / 180::DOUBLE AS risk, {VALUE} AS expected FROM panel)"""
SALES_YEAR = f"event_type = 'sale' AND event_time >= TIMESTAMP '{SCORE}' - INTERVAL 365 DAY AND event_time < TIMESTAMP '{SCORE}'"


def _favourite(facet: str) -> str:
    return f"""fav_{facet} AS (
  SELECT customer_id, facet_key AS top_{facet} FROM (
    SELECT customer_id, CAST({facet} AS VARCHAR) AS facet_key, sum(net_minor) AS revenue
    FROM ev JOIN products USING (product_id) WHERE {SALES_YEAR} GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY revenue DESC, facet_key) = 1)"""


FAVOURITES = f"""{_favourite("category")}, {_favourite("brand")}, {_favourite("product_id")},
favourites AS (
  SELECT * FROM fav_category JOIN fav_brand USING (customer_id) JOIN fav_product_id USING (customer_id))"""
PROFILES = """
profiles AS (SELECT CAST(record_id AS BIGINT) AS customer_id, city, marketing_consent, identity_review_required FROM audit)"""
PROFILED = f"""WITH {_portfolio(SCORE)},{IDENTITY},{PROFILES},{FAVOURITES},
profiled AS (
  SELECT * FROM scores JOIN profiles USING (customer_id) LEFT JOIN favourites USING (customer_id))"""
CAMPAIGN = f"""{PROFILED},
listed AS (
  SELECT *, inactive_risk90 * greatest(expected_margin90, 0) AS priority_score FROM profiled
  WHERE marketing_consent AND NOT identity_review_required AND expected_margin90 > 0 AND recency_days >= 30
    AND inactive_risk90 >= 0.5
  ORDER BY priority_score DESC, customer_id LIMIT {CONFIG.campaign_capacity}),
drawn AS (
  SELECT *, row_number() OVER (ORDER BY md5('{CONFIG.seed}' || customer_id)) AS place, count(*) OVER () AS n FROM listed),
candidates AS (
SELECT customer_id, snapshot_date, segment, city, top_category, top_brand, recency_days,
       round(inactive_risk90, 6) AS inactive_risk90, expected_margin90, round(priority_score, 6) AS priority_score,
       CASE WHEN n < 2 THEN 'insufficient_sample'
            WHEN place <= least(n - 1, greatest(1, round_even(n * {CONFIG.control_fraction}::DOUBLE, 0))) THEN 'control'
            ELSE 'treatment' END AS experiment_group,
       '{campaign.BUSINESS_REASON}' AS business_reason, '{campaign.SUGGESTED_ACTION}' AS suggested_action FROM drawn)"""
REVENUE_SCORES = f"""WITH {_panel([SCORE], revenue=True)},{QUINTILES},
tops AS (
  SELECT customer_id, top_product_id, top_product_name FROM (
    SELECT customer_id, CAST(product_id AS VARCHAR) AS top_product_id, product_name AS top_product_name,
           sum(net_minor) AS revenue
    FROM rev JOIN products USING (product_id) WHERE {SALES_YEAR} GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY revenue DESC, top_product_id, top_product_name) = 1),
valued AS (
  SELECT *, recency_days / 180::DOUBLE AS inactive_risk90, {_r2("net_revenue_365 * 90 / 365::DOUBLE")} AS expected_revenue90
  FROM segmented LEFT JOIN tops USING (customer_id)),
scores AS (
  SELECT *, false AS activation_eligible, '{campaign.EXCLUSION_REASON}' AS activation_exclusion_reason,
         inactive_risk90 * greatest(expected_revenue90, 0) AS analysis_priority FROM valued)"""


def _evaluated(source: str, label: str, score: str, ties: str, group: str = "1") -> str:
    """CTE ``evaluated``: ranking metrics of ``source`` per ``group`` by brute definition."""
    return f"""
given AS (SELECT {group} AS g, {label} AS y, CAST({score} AS DOUBLE) AS s,
          row_number() OVER (PARTITION BY {group} ORDER BY {score} DESC, {ties}) AS place,
          count(*) OVER (PARTITION BY {group}) AS n FROM {source}),
cuts AS (SELECT g, s, count(*) AS k, sum(y) AS hits FROM given GROUP BY g, s),
curve AS (SELECT *, sum(k) OVER w AS seen, sum(hits) OVER w AS found FROM cuts
          WINDOW w AS (PARTITION BY g ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
areas AS (SELECT g, sum(hits) AS positives, sum(k) AS total, sum(hits * found / seen::DOUBLE) AS ap_sum,
          sum((k - hits) * (found - hits + 0.5::DOUBLE * hits)) AS won FROM curve GROUP BY g),
heads AS (SELECT g, avg(y::DOUBLE) AS head_precision FROM given
          WHERE place <= greatest(1, ceil(n * 0.2::DOUBLE)) GROUP BY g),
losses AS (SELECT g, avg((s - y) * (s - y)) AS brier FROM given GROUP BY g),
evaluated AS (
  SELECT g, CAST(total AS BIGINT) AS n, positives / total::DOUBLE AS prevalence, ap_sum / nullif(positives, 0)::DOUBLE AS average_precision,
         won / nullif(positives * (total - positives), 0)::DOUBLE AS roc_auc, brier,
         head_precision AS precision_at_20pct, head_precision / nullif(positives / total::DOUBLE, 0) AS lift_at_20pct
  FROM areas JOIN heads USING (g) JOIN losses USING (g))"""


RISK_TIES = "snapshot_date, customer_id"
RANKED = f"WITH {HELD_OUT},{_evaluated('held', 'inactive_next90', 'risk', RISK_TIES)}"
RANK_COLUMNS = ("prevalence", "average_precision", "roc_auc", "brier", "precision_at_20pct", "lift_at_20pct")


def _rounded(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def _regression(actual: str, predicted: str) -> str:
    return f"""count(*) AS n, avg(abs({actual} - {predicted})) AS mae,
       sum(abs({actual} - {predicted})) / nullif(sum(abs({actual})), 0) AS wape,
       1 - sum(({actual} - {predicted}) * ({actual} - {predicted})) / nullif(var_pop({actual}) * count(*), 0) AS r2,
       sum({actual}) AS actual_sum, sum({predicted}) AS predicted_sum,
       sum({predicted}) / nullif(sum({actual}), 0) - 1 AS bias"""


ALL_PANEL = _panel(CONFIG.labelled_cutoffs)
MODEL_MART = f"""WITH {ALL_PANEL},
developed AS (SELECT avg(inactive_next90::DOUBLE) AS prior, avg(value_next) AS mean FROM panel
              WHERE {SPLIT} IN ('train', 'validation')),
held AS (SELECT panel.*, recency_days / 180::DOUBLE AS risk, {VALUE} AS expected, mean, prior
         FROM panel, developed WHERE {SPLIT} = 'test'),
{_evaluated('held', 'inactive_next90', 'risk', RISK_TIES).strip()},
value_errors AS (SELECT avg(abs(value_next - expected)) AS mae, avg(abs(value_next - mean)) AS base_mae FROM held),
mart AS (
  SELECT 'average_precision' AS metric, 'Inactivity average precision' AS label, average_precision AS value,
         prevalence AS baseline, 'ratio' AS unit FROM evaluated
  UNION ALL SELECT 'roc_auc', 'Inactivity ROC-AUC', roc_auc, 0.5, 'ratio' FROM evaluated
  UNION ALL SELECT 'lift_at_20pct', 'Top-20% lift', lift_at_20pct, lift_at_20pct, 'multiple' FROM evaluated
  UNION ALL SELECT 'revenue_mae', '90-day revenue MAE', mae, base_mae, 'GBP' FROM value_errors)"""

SALE = "event_type = 'sale'"
RETURN = "event_type = 'return'"
SALE_ORDERS = f"count(DISTINCT CASE WHEN {SALE} THEN order_id END)"
BUYERS = f"count(DISTINCT CASE WHEN {SALE} THEN customer_id END)"
MONTH = "strftime(event_time, '%Y-%m')"
IN_PERIOD = f"{SALE} AND event_time >= TIMESTAMP '{PERIOD[0]}' AND event_time < TIMESTAMP '{PERIOD[1]}'"
CALENDAR = f"""
calendar AS (
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         strftime(d, '%Y-%m') AS year_month
  FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(o_orderdate)) FROM orders),
                                      TIMESTAMP '{SCORE}' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d))"""
COHORTS = f"""
bought AS (SELECT DISTINCT customer_id, year(event_time) * 12 + month(event_time) - 1 AS m FROM ev
           WHERE {SALE} AND event_time < TIMESTAMP '{SCORE}'),
cohorts AS (SELECT customer_id, min(m) AS c FROM bought GROUP BY customer_id),
sizes AS (SELECT c, count(*) AS cohort_size FROM cohorts GROUP BY c),
active AS (SELECT c, m - c AS age, count(*) AS active FROM bought JOIN cohorts USING (customer_id) GROUP BY ALL),
grid AS (SELECT c, cohort_size, unnest(generate_series(0, 2001 * 12 + 6 - c)) AS age FROM sizes),
retention AS (
  SELECT printf('%04d-%02d', c // 12, c % 12 + 1) AS cohort, CAST(age AS INTEGER) AS month_index, cohort_size,
         coalesce(active, 0) AS active_customers, coalesce(active, 0) / cohort_size::DOUBLE AS retention_rate
  FROM grid LEFT JOIN active USING (c, age))"""
FEATURES = """recency_days, tenure_days, frequency_365, frequency_90, frequency_previous90, net_revenue_365,
  net_revenue_90, gross_margin_365, average_order_value, category_count, brand_count, online_share, discount_share,
  return_unit_rate, order_trend"""


def _orphans(name: str, key: str, parent: str, parent_key: str) -> str:
    return f"""SELECT '{name}' AS reference, count(DISTINCT {key}) AS orphan_keys, count(*) AS orphan_rows
  FROM keyed_raw WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})"""


def _keys(name: str, source: str, key: str) -> str:
    return f"""SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count,
  count(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(0 AS BIGINT) AS null_keys
  FROM (SELECT count(*) AS n FROM {source} GROUP BY {key})"""


def _contract_row(name: str, source: str, matches: bool) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, CAST(0 AS BIGINT) AS null_keys,
  {str(matches).lower()} AS header_matches FROM {source}"""


def _split_rows() -> str:
    rows = []
    for cutoff, name in CONFIG.splits.items():
        at = f"TIMESTAMP '{cutoff}'"
        rows.append(f"""SELECT DATE '{cutoff}' AS cutoff, '{name}' AS split,
  count(*) FILTER (WHERE o_orderdate >= {at} - INTERVAL 365 DAY AND o_orderdate < {at}) AS history_orders,
  count(*) FILTER (WHERE o_orderdate >= {at} AND o_orderdate < {at} + INTERVAL 90 DAY) AS outcome_orders,
  max(o_orderdate) < TIMESTAMP '{CONFIG.observed_until}' AS data_before_end FROM orders""")
    return " UNION ALL ".join(rows)


def _score_measures(name: str, group: str) -> str:
    def one(x: str) -> str:
        return f"CASE WHEN count(DISTINCT snapshot_date) = 1 THEN {x} END"

    return f"""SELECT {name} AS snapshot_date, {one("count(DISTINCT customer_id)")} AS scored_customers,
  round({one("avg(inactive_risk90)")}, 6) AS average_risk, round({one("sum(expected_margin90)")}, 2) AS expected_margin90,
  round({one("sum(ltv_3year_scenario)")}, 2) AS ltv_total,
  {one("count(DISTINCT CASE WHEN inactive_risk90 >= 0.5 THEN customer_id END)")} AS high_risk_customers,
  round({one("avg(recency_days)")}, 6) AS average_recency, CAST(0 AS BIGINT) AS activation_eligible_customers
  FROM scores {group}"""


ORACLE_SQL: dict[str, str] = {
    "segment_overview": f"""WITH {_panel([TEST])},{FIXED}
SELECT segment, count(*) AS customers, round(sum(net_revenue_365), 2) AS net_revenue_365,
       round(avg(recency_days), 6) AS average_recency FROM segmented GROUP BY segment""",
    "scan_union_provenance": f"""WITH {LINES}
SELECT source_sheet, source_row, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM numbered""",
    "scan_csv_roundtrip": f"""
SELECT CAST(c_custkey AS VARCHAR) AS record_id, CASE WHEN c_custkey % 2 = 0 THEN 'web' ELSE 'store' END AS source,
       CASE WHEN member THEN 'L' || c_custkey ELSE '' END AS loyalty_id,
       CASE WHEN member THEN 'True' ELSE 'False' END AS loyalty_verified,
       ' C' || (c_custkey // 3) || '@Example.invalid' AS email,
       CASE WHEN c_custkey % 7 <> 0 THEN 'true' ELSE 'false' END AS email_verified,
       '(P) ' || (c_custkey // 6) AS phone, '1' AS phone_verified, n_name AS city,
       CASE WHEN c_custkey % 5 <> 0 THEN '1' ELSE '0' END AS marketing_consent
FROM (SELECT *, ((c_custkey // 3) % 4 = 0 AND c_custkey % 3 = 0) OR ((c_custkey // 3) % 4 = 1 AND c_custkey % 3 <= 1) AS member
      FROM customer) LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "dim_date": f"WITH {CALENDAR} SELECT * FROM calendar",
    "calendar_hierarchy": """
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_no,
       strftime(d, '%B') AS month, CAST(quarter(d) AS INTEGER) AS quarter_no, 'Qtr ' || quarter(d) AS quarter,
       CAST(day(d) AS INTEGER) AS day
FROM (SELECT unnest(generate_series(date_trunc('year', min(l_shipdate)),
                                    date_trunc('year', max(l_shipdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                    INTERVAL 1 DAY)) AS d FROM lineitem)""",
    "mart_fact_sales": f"""WITH {EV}
SELECT event_id, CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
       CAST(product_id AS VARCHAR) AS product_id, event_type, channel, signed_quantity,
       CAST(net_revenue AS DECIMAL(18,2)) AS net_revenue, CAST(margin_minor / {CENTS} AS DECIMAL(18,2)) AS gross_margin,
       CAST(event_time AS DATE) AS event_date, {MONTH} AS year_month FROM ev""",
    "mart_fact_sales_revenue": f"""WITH {EV}
SELECT event_id, CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
       CAST(product_id AS VARCHAR) AS product_id, event_type, signed_quantity,
       CAST(unit_price AS DECIMAL(18,4)) AS unit_price, CAST(net_minor / 10000::DOUBLE AS DECIMAL(18,4)) AS net_revenue,
       CAST(event_time AS DATE) AS event_date, {MONTH} AS year_month FROM rev""",
    "mart_dim_customer": f"WITH {IDENTITY} SELECT * FROM dim",
    "mart_dim_product": f"""WITH {PRODUCTS}
SELECT CAST(product_id AS VARCHAR) AS product_id, product_name, category, brand,
       CAST(list_price AS DECIMAL(18,2)) AS list_price, CAST(unit_cost AS DECIMAL(18,2)) AS unit_cost FROM products""",
    "mart_dim_date": f"WITH {CALENDAR} SELECT * FROM calendar",
    "mart_customer_scores": f"""{PROFILED}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, snapshot_date, segment, rfm_score, r_score, f_score, m_score,
       recency_days, frequency_365, CAST(net_revenue_365 AS DECIMAL(18,2)) AS net_revenue_365,
       CAST(gross_margin_365 AS DECIMAL(18,2)) AS gross_margin_365, inactive_risk90,
       CAST(expected_margin90 AS DECIMAL(18,2)) AS expected_margin90,
       CAST(ltv_3year_scenario AS DECIMAL(18,2)) AS ltv_3year_scenario, top_category, top_brand, top_product_id
FROM profiled""",
    "mart_customer_scores_revenue": f"""{REVENUE_SCORES}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, snapshot_date, segment, rfm_score, r_score, f_score, m_score,
       recency_days, frequency_365, CAST(net_revenue_365 AS DECIMAL(18,4)) AS net_revenue_365, inactive_risk90,
       CAST(expected_revenue90 AS DECIMAL(18,4)) AS expected_revenue90, top_product_id, top_product_name,
       activation_eligible, activation_exclusion_reason, CAST(analysis_priority AS DECIMAL(18,4)) AS analysis_priority
FROM scores""",
    "mart_cohort_retention": f"WITH {EV},{COHORTS} SELECT * FROM retention",
    "load_reconcile": f"""WITH {CALENDAR}
SELECT 'dim_product' AS table_name, count(*) AS rows_sent, count(*) AS rows_loaded FROM part
UNION ALL SELECT 'dim_date', count(*), count(*) FROM calendar
UNION ALL SELECT 'fact_sales', count(*), count(*) FROM lineitem""",
    "export_escaped": """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '''=' WHEN 2 THEN '''+' WHEN 3 THEN '''@' ELSE '''-' END || p_name
         AS product_name, CAST(p_retailprice AS VARCHAR) AS list_price FROM part""",
    "monthly_channel_performance": f"""WITH {EV}
SELECT {MONTH} AS year_month, channel, {_money("net_minor")} AS net_revenue, {_money("margin_minor")} AS gross_margin,
       {SALE_ORDERS} AS sale_orders, {BUYERS} AS purchasing_customers FROM ev GROUP BY ALL""",
    "monthly_performance": f"""WITH {EV}
SELECT {MONTH} AS year_month, {_money("net_minor")} AS net_revenue, {_money("margin_minor")} AS gross_margin,
       {SALE_ORDERS} AS sale_orders, {BUYERS} AS purchasing_customers FROM ev GROUP BY ALL""",
    "monthly_revenue": f"""WITH {EV}
SELECT {MONTH} AS month, {_money("net_minor")} AS net_revenue, {_money("margin_minor")} AS gross_margin
FROM ev GROUP BY ALL""",
    "category_revenue": f"""WITH {EV},{PRODUCTS}
SELECT category, {_money("net_minor")} AS net_revenue FROM ev JOIN products USING (product_id) GROUP BY category""",
    "category_brand_contribution": f"""WITH {EV},{PRODUCTS}
SELECT category, brand, {_money("net_minor")} AS net_revenue, {_money("margin_minor")} AS gross_margin
FROM ev JOIN products USING (product_id) GROUP BY category, brand""",
    "portfolio_totals": f"""WITH {EV}
SELECT {_money("net_minor")} AS net_revenue, {_money("margin_minor")} AS gross_margin, {SALE_ORDERS} AS sale_orders,
       count(*) AS event_lines FROM ev""",
    "top_products": f"""WITH {EV},{PRODUCTS}
SELECT product_id, product_name, {_money("net_minor")} AS net_revenue FROM ev JOIN products USING (product_id)
GROUP BY product_id, product_name ORDER BY net_revenue DESC, product_id LIMIT 8""",
    "repeat_customer_share": f"""WITH {EV}, per AS (
  SELECT customer_id, count(DISTINCT order_id) AS orders FROM ev WHERE {IN_PERIOD} GROUP BY customer_id)
SELECT count(*) AS purchasing_customers, count(*) FILTER (WHERE orders >= 2) AS repeat_customers,
       round(count(*) FILTER (WHERE orders >= 2) / nullif(count(*), 0)::DOUBLE, 6) AS repeat_share FROM per""",
    "omnichannel_buyers": f"""WITH {EV}, per AS (
  SELECT customer_id, count(DISTINCT channel) AS channels FROM ev WHERE {IN_PERIOD} GROUP BY customer_id)
SELECT count(*) AS buyers, count(*) FILTER (WHERE channels = 2) AS omnichannel_buyers FROM per""",
    "sales_star": f"""WITH {EV},{PRODUCTS},{CALENDAR}
SELECT event_id, CAST(event_time AS DATE) AS event_date, year_month, n_name AS country, category, brand, event_type,
       net_revenue, margin_minor / {CENTS} AS gross_margin
FROM ev JOIN products USING (product_id) JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN calendar ON calendar.date = CAST(event_time AS DATE)""",
    "measures_revenue": f"""WITH {EV}
SELECT channel, {_money("net_minor")} AS net_revenue, {_money("margin_minor")} AS gross_margin,
       round(sum(margin_minor) / nullif(sum(net_minor), 0)::DOUBLE, 6) AS margin_rate,
       {SALE_ORDERS} AS sale_orders, {BUYERS} AS purchasing_customers,
       round(({_money("net_minor")}) / nullif({SALE_ORDERS}, 0), 6) AS net_average_order_value
FROM ev GROUP BY channel""",
    "measures_returns": f"""WITH {EV}
SELECT channel, -{_money("net_minor", RETURN)} AS return_value, {_money("net_minor", SALE)} AS gross_sale_value,
       round(-{_sum("net_minor", RETURN)} / nullif({_sum("net_minor", SALE)}, 0)::DOUBLE, 6) AS return_value_rate
FROM ev GROUP BY channel""",
    "repeat_purchase_rate": f"""WITH {EV}, per AS (
  SELECT channel, customer_id, count(DISTINCT order_id) AS orders FROM ev WHERE {SALE} GROUP BY ALL)
SELECT channel, count(*) AS buyers, count(*) FILTER (WHERE orders >= 2) AS repeat_buyers,
       round(count(*) FILTER (WHERE orders >= 2) / count(*)::DOUBLE, 6) AS repeat_purchase_rate FROM per GROUP BY channel""",
    "dedup_exact": f"WITH {RAW} SELECT DISTINCT event_id, order_id, event_type, event_time, quantity, unit_price FROM raw",
    "dedup_keep_first": f"""WITH {LINES}
SELECT source_sheet, source_row, "Invoice", "StockCode", "Quantity" FROM firsts""",
    "quarantine_events": f"""{CLEAN}
SELECT event_id, rejection_reason FROM outcome WHERE rejection_reason IS NOT NULL""",
    "quarantine_reason_counts": f"""{CLEAN}
SELECT rejection_reason AS reason, count(*) AS row_count FROM outcome WHERE rejection_reason IS NOT NULL GROUP BY ALL""",
    "enrich_events": f"""{CLEAN},
signed AS (
  SELECT *, CAST(quantity * CASE event_type WHEN 'sale' THEN 1 WHEN 'return' THEN -1 ELSE 0 END AS BIGINT) AS signed_quantity
  FROM outcome WHERE rejection_reason IS NULL),
revenue AS (SELECT *, {_r2("signed_quantity * unit_price * (1 - discount_rate)")} AS net_revenue FROM signed)
SELECT event_id, customer_id, category, brand, event_type, signed_quantity, net_revenue,
       {_r2("net_revenue - signed_quantity * unit_cost")} AS gross_margin FROM revenue""",
    "quality_report": f"""{CLEAN}
SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM raw) - count(*) AS exact_duplicates_removed,
       count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS quarantined_rows,
       count(*) FILTER (WHERE rejection_reason IS NULL) AS accepted_rows,
       count(*) FILTER (WHERE rejection_reason IS NULL AND {RETURN}) AS return_rows,
       count(*) FILTER (WHERE rejection_reason IS NULL AND event_type = 'cancelled') AS cancelled_rows,
       true AS reconciled FROM outcome""",
    "return_reference_check": f"""WITH RECURSIVE {EV},
firsts AS (SELECT order_id, min(event_id) AS origin_event_id FROM ev WHERE {SALE} GROUP BY order_id),
candidates AS (
  SELECT f.origin_event_id, r.event_id, r.event_time, r.quantity, s.quantity AS sold
  FROM ev r JOIN firsts f ON r.order_id = f.order_id JOIN ev s ON s.event_id = f.origin_event_id
  WHERE r.{RETURN} AND r.customer_id = s.customer_id),
{GREEDY.strip()}
SELECT step.event_id, step.origin_event_id, quantity, accepted FROM step JOIN candidates USING (event_id)""",
    "quarantine_lines": f"""{CLEAN_LINES}
SELECT source_sheet, source_row, reason AS quarantine_reason FROM line_reasons WHERE reason IS NOT NULL""",
    "type_and_key_lines": f"{CLEAN_LINES} SELECT * FROM line_events",
    "dim_customer_mode": f"""{CLEAN_LINES}
SELECT customer_id, country FROM (SELECT customer_id, country, count(*) AS n FROM line_events GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, country) = 1""",
    "dim_product_mode": f"""{CLEAN_LINES}
SELECT product_id, product_name FROM (SELECT product_id, product_name, count(*) AS n FROM line_events GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY n DESC, product_name) = 1""",
    "data_quality_metrics": f"""{LINE_QUALITY}
SELECT metric, label, value, unit, status FROM (
  SELECT unnest([
    {{'metric': 'raw_rows', 'label': 'Raw transaction rows', 'value': raw_rows, 'unit': 'rows', 'status': 'observed'}},
    {{'metric': 'exact_duplicates_removed', 'label': 'Exact duplicates removed', 'value': exact_duplicates_removed, 'unit': 'rows', 'status': 'observed'}},
    {{'metric': 'quarantined_rows', 'label': 'Quarantined rows', 'value': quarantined_rows, 'unit': 'rows', 'status': 'observed'}},
    {{'metric': 'accepted_rows', 'label': 'Accepted transaction rows', 'value': accepted_rows, 'unit': 'rows', 'status': 'observed'}},
    {{'metric': 'known_customers', 'label': 'Identified customers', 'value': known_customers, 'unit': 'customers', 'status': 'observed'}},
    {{'metric': 'products', 'label': 'Distinct products', 'value': products, 'unit': 'products', 'status': 'observed'}},
    {{'metric': 'sale_orders', 'label': 'Sale orders', 'value': sale_orders, 'unit': 'orders', 'status': 'observed'}},
    {{'metric': 'return_rows', 'label': 'Return rows', 'value': return_rows, 'unit': 'rows', 'status': 'observed'}},
    {{'metric': 'zero_price_rows_accepted', 'label': 'Accepted zero-price rows', 'value': zero_price_rows_accepted, 'unit': 'rows', 'status': 'review'}},
    {{'metric': 'reconciled', 'label': 'Row reconciliation', 'value': 1, 'unit': 'boolean', 'status': 'pass'}}
  ], recursive := true) FROM counts)
UNION ALL
SELECT 'quarantine_' || reason, 'Quarantine: ' || replace(reason, '_', ' '), count(*), 'rows', 'observed'
FROM line_reasons WHERE reason IS NOT NULL GROUP BY reason""",
    "measures_quality": f"""{LINE_QUALITY}
SELECT accepted_rows, quarantined_rows, CAST(1 AS BIGINT) AS reconciliation_passed FROM counts""",
    "identity_resolution": f"""WITH {IDENTITY}
SELECT customer_id, match_rule, count(*) AS records, min(record_id) AS first_record FROM audit GROUP BY ALL""",
    "identity_audit": f"WITH {IDENTITY} SELECT * FROM audit",
    "dim_customer": f"WITH {IDENTITY} SELECT * FROM dim",
    "identity_stats": f"""WITH {IDENTITY}
SELECT CAST(sum(source_records) AS BIGINT) AS raw_customer_records, count(*) AS unified_customers,
       CAST(sum(source_records) - count(*) AS BIGINT) AS collapsed_records,
       count(*) FILTER (WHERE identity_review_required) AS identity_review_customers FROM dim""",
    "pk_violations": f"""WITH {EV},{CALENDAR}
{_keys("dim_customer", "customer", "c_custkey")} UNION ALL {_keys("dim_product", "part", "p_partkey")}
UNION ALL {_keys("dim_date", "calendar", "date")} UNION ALL {_keys("fact_sales", "ev", "event_id")}
UNION ALL {_keys("line_numbers", "lineitem", "l_orderkey, l_linenumber")}""",
    "fk_violations": f"""WITH {RAW},{CALENDAR},
people AS (SELECT CAST(c_custkey AS VARCHAR) AS k FROM customer),
goods AS (SELECT CAST(p_partkey AS VARCHAR) AS k FROM part),
keyed_raw AS (SELECT *, CAST(TRY_CAST(event_time AS TIMESTAMP) AS DATE) AS event_date FROM raw)
{_orphans("events.customer_record_id", "customer_record_id", "people", "k")}
UNION ALL {_orphans("events.product_id", "product_id", "goods", "k")}
UNION ALL {_orphans("events.event_date", "event_date", "calendar", "date")}""",
    "check_violations": f"""WITH {RAW}
SELECT unnest(['event_type_domain', 'channel_domain', 'discount_between_0_and_1', 'quantity_positive',
               'quantity_present', 'price_positive', 'event_time_present']) AS rule,
       unnest([count(*) FILTER (WHERE event_type NOT IN ('sale', 'return', 'cancelled')),
               count(*) FILTER (WHERE channel NOT IN ('online', 'store')),
               count(*) FILTER (WHERE NOT TRY_CAST(discount_rate AS DOUBLE) BETWEEN 0 AND 1),
               count(*) FILTER (WHERE TRY_CAST(quantity AS DOUBLE) <= 0),
               count(*) FILTER (WHERE TRY_CAST(quantity AS DOUBLE) IS NULL),
               count(*) FILTER (WHERE TRY_CAST(unit_price AS DOUBLE) <= 0),
               count(*) FILTER (WHERE TRY_CAST(event_time AS TIMESTAMP) IS NULL)]) AS violations FROM raw""",
    "contract_report": f"""WITH {EV},{CALENDAR},{COHORTS},{IDENTITY}
{_contract_row("dim_product", "part", True)} UNION ALL {_contract_row("dim_date", "calendar", True)}
UNION ALL {_contract_row("fact_sales", "lineitem", True)} UNION ALL {_contract_row("cohort_retention", "retention", True)}
UNION ALL {_contract_row("dim_customer", "dim", False)}""",
    "string_normalise": """
SELECT CAST(c_custkey AS VARCHAR) AS record_id, 'c' || (c_custkey // 3) || '@example.invalid' AS email,
       'p' || (c_custkey // 6) AS phone,
       ((c_custkey // 3) % 4 = 0 AND c_custkey % 3 = 0) OR ((c_custkey // 3) % 4 = 1 AND c_custkey % 3 <= 1) AS loyalty_verified,
       c_custkey % 5 <> 0 AS marketing_consent, 'C' || substr(sha256('record:' || c_custkey), 1, 16) AS surrogate,
       CAST(c_custkey // 6 AS VARCHAR) AS phone_digits FROM customer""",
    "lenient_casts": f"""WITH {RAW}, typed AS (
  SELECT event_id, TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(unit_price AS DOUBLE) AS unit_price,
         TRY_CAST(discount_rate AS DOUBLE) AS d, TRY_CAST(event_time AS TIMESTAMP) AS event_time FROM raw)
SELECT event_id, quantity, unit_price, event_time,
       quantity IS NOT NULL AND unit_price IS NOT NULL AND d IS NOT NULL AS all_finite,
       coalesce(quantity = floor(quantity), false) AS whole_quantity FROM typed""",
    "date_parts": f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, strftime(o_orderdate, '%Y-%m') AS year_month,
       CAST(l_shipdate AS DATE) AS ship_day,
       CAST((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS INTEGER) AS months_to_ship,
       {_days("o_orderdate", "l_shipdate")} AS days_to_ship
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "snapshot_features": f"WITH {_panel([TEST])} SELECT customer_id, snapshot_date, {FEATURES} FROM panel",
    "snapshot_features_revenue": f"""WITH {_panel([TEST], revenue=True)}
SELECT * EXCLUDE (inactive_next90, value_next) FROM panel""",
    "snapshot_labels": f"""WITH {_panel([TEST])}
SELECT customer_id, snapshot_date, inactive_next90, value_next AS margin_next90 FROM panel""",
    "snapshot_labels_revenue": f"""WITH {_panel([TEST], revenue=True)}
SELECT customer_id, snapshot_date, inactive_next90, value_next AS revenue_next90 FROM panel""",
    "labeled_snapshots": f"""WITH {ALL_PANEL}
SELECT customer_id, snapshot_date, {FEATURES}, inactive_next90, value_next AS margin_next90, {SPLIT} AS split FROM panel""",
    "split_plan": _split_rows(),
    "rfm_fixed_segments": f"""WITH {_panel([TEST])},{FIXED}
SELECT customer_id, snapshot_date, r_score, f_score, m_score, rfm_score, segment FROM segmented""",
    "rfm_quintiles": f"""WITH {_panel([TEST], revenue=True)},{QUINTILES}
SELECT customer_id, r_score, f_score, m_score FROM segmented""",
    "rfm_quintile_segments": f"""WITH {_panel([TEST], revenue=True)},{QUINTILES}
SELECT customer_id, snapshot_date, rfm_score, segment FROM segmented""",
    "cohort_retention": f"WITH {EV},{COHORTS} SELECT * FROM retention",
    "cohort_matrix": f"WITH {EV},{COHORTS} SELECT cohort, " + ", ".join(
        f"round(max(retention_rate) FILTER (WHERE month_index = {age}), 6) AS age_{age}"
        for age in range((2001 - 1995) * 12 + 7)
    ) + " FROM retention GROUP BY cohort",
    "customer_affinity": f"WITH {EV},{PRODUCTS},{FAVOURITES} SELECT * FROM favourites",
    "top_product": f"{REVENUE_SCORES} SELECT * FROM tops",
    "ltv_scenario": f"WITH {_portfolio(SCORE)} SELECT customer_id, expected_margin90, ltv_3year_scenario FROM scores",
    "mean_ltv": f"WITH {_portfolio(SCORE)} SELECT round(avg(expected_margin90) * {LTV_FACTOR}, 4) AS mean_ltv FROM scores",
    "campaign_candidates": f"{CAMPAIGN} SELECT * FROM candidates",
    "campaign_group_counts": f"{CAMPAIGN} SELECT experiment_group, count(*) AS customers FROM candidates GROUP BY ALL",
    "analysis_priority": f"""{REVENUE_SCORES}
SELECT customer_id, round(inactive_risk90, 6) AS inactive_risk90, expected_revenue90, activation_eligible,
       activation_exclusion_reason, round(analysis_priority, 6) AS analysis_priority FROM scores""",
    "customer_scores": f"""{PROFILED}
SELECT customer_id, snapshot_date, segment, rfm_score, r_score, f_score, m_score, recency_days, frequency_365,
       net_revenue_365, gross_margin_365, round(inactive_risk90, 6) AS inactive_risk90, expected_margin90,
       ltv_3year_scenario, top_category, top_brand, top_product_id FROM profiled""",
    "segment_counts": f"WITH {_portfolio(SCORE)} SELECT segment, count(*) AS customers FROM scores GROUP BY segment",
    "segment_value_latest": f"""WITH {_portfolio(TEST, SCORE)}
SELECT segment, count(*) AS customers, round(avg(inactive_risk90), 6) AS average_risk,
       round(sum(expected_margin90), 2) AS expected_margin90
FROM scores WHERE snapshot_date = (SELECT max(snapshot_date) FROM scores) GROUP BY segment""",
    "customer_360": f"""WITH {_portfolio(SCORE)},{IDENTITY},{PROFILES}
SELECT customer_id, snapshot_date, segment, rfm_score, recency_days, net_revenue_365, city, marketing_consent,
       identity_review_required FROM scores JOIN profiles USING (customer_id)""",
    "customer_search": f"""WITH {_portfolio(SCORE)}
SELECT customer_id, segment, round(inactive_risk90, 6) AS inactive_risk90 FROM scores
WHERE segment = '{rfm.FIXED_SEGMENTS[3]}' AND CAST(customer_id AS VARCHAR) LIKE '%1%' AND inactive_risk90 >= 0.1""",
    "top_risk_customers": f"""WITH {_portfolio(SCORE)}
SELECT customer_id, segment, recency_days, round(inactive_risk90, 6) AS inactive_risk90 FROM scores
ORDER BY scores.inactive_risk90 DESC, customer_id LIMIT 200""",
    **{name: f"""WITH {_portfolio(TEST, SCORE)}
SELECT customer_id, segment, sum(recency_days) AS recency_days, CAST(sum(frequency_365) AS BIGINT) AS frequency_365,
       round(sum(net_revenue_365), 2) AS net_revenue_365, round(sum(inactive_risk90), 6) AS inactive_risk90
FROM scores WHERE snapshot_date = DATE '{date}' GROUP BY customer_id, segment"""
       for name, date in (("customer_detail", SCORE), ("customer_detail_at", TEST))},
    "scatter_recency_value": f"""WITH {_portfolio(TEST, SCORE)}
SELECT customer_id, snapshot_date, min(segment) AS segment, sum(recency_days) AS recency_days,
       round(sum(net_revenue_365), 2) AS net_revenue_365, round(avg(inactive_risk90), 6) AS inactive_risk90
FROM scores GROUP BY customer_id, snapshot_date""",
    "scatter_recency_value_at": f"""WITH {_portfolio(TEST, SCORE)}
SELECT customer_id, min(segment) AS segment, sum(recency_days) AS recency_days,
       round(sum(net_revenue_365), 2) AS net_revenue_365, round(avg(inactive_risk90), 6) AS inactive_risk90
FROM scores WHERE snapshot_date = DATE '{TEST}' GROUP BY customer_id""",
    "scatter_risk_value": f"""{REVENUE_SCORES}
SELECT customer_id, min(segment) AS segment, round(sum(inactive_risk90), 4) AS inactive_risk90,
       round(sum(expected_revenue90), 4) AS expected_revenue90, round(sum(analysis_priority), 4) AS analysis_priority
FROM scores GROUP BY customer_id""",
    "measures_scores": f"""WITH {_portfolio(TEST, SCORE)}
{_score_measures("snapshot_date", "GROUP BY snapshot_date")} UNION ALL {_score_measures("CAST(NULL AS DATE)", "")}""",
    "split_population": f"""WITH {ALL_PANEL}
SELECT {SPLIT} AS split, count(*) AS row_count, CAST(sum(inactive_next90) AS BIGINT) AS positives,
       count(*) >= 30 AND sum(inactive_next90) > 0 AND sum(inactive_next90) < count(*) AS evaluable
FROM panel GROUP BY 1""",
    "baseline_predictions": f"""WITH {ALL_PANEL},
developed AS (SELECT avg(inactive_next90::DOUBLE) AS prior, avg(value_next) AS mean FROM panel
              WHERE {SPLIT} IN ('train', 'validation'))
SELECT customer_id, inactive_next90, value_next AS margin_next90, round(prior, 6) AS prior_risk,
       round(mean, 4) AS mean_margin90 FROM panel, developed WHERE {SPLIT} = 'test'""",
    "classification_metrics": f"{RANKED} SELECT n, {_rounded(RANK_COLUMNS)} FROM evaluated",
    "classification_metrics_by_group": "WITH scored AS (SELECT *, n_chars / (n_chars + 1000)::DOUBLE AS score "
    "FROM labels JOIN documents USING (doc_id)),"
    + _evaluated("scored", "quality", "score", "doc_id", "lang")
    + f" SELECT g AS lang, n, {_rounded(RANK_COLUMNS)} FROM evaluated",
    "average_precision": f"{RANKED} SELECT n, {_rounded(['average_precision'])} FROM evaluated",
    "roc_auc": f"{RANKED} SELECT n, {_rounded(['roc_auc'])} FROM evaluated",
    "lift_at_20pct": f"{RANKED} SELECT n, {_rounded(['prevalence', 'precision_at_20pct', 'lift_at_20pct'])} FROM evaluated",
    "recency_ranking": f"WITH {HELD_OUT},{_evaluated('held', 'inactive_next90', 'recency_days', RISK_TIES)} "
    f"SELECT {_rounded(['average_precision', 'precision_at_20pct', 'lift_at_20pct'])} FROM evaluated",
    "regression_metrics": f"""WITH {HELD_OUT}, errors AS (SELECT {_regression("value_next", "expected")} FROM held)
SELECT n, {_rounded(["mae", "actual_sum", "predicted_sum"], 2)}, {_rounded(["wape", "r2", "bias"])} FROM errors""",
    "model_metrics": f"""{MODEL_MART}
SELECT metric, label, round(value, 4) AS value, round(baseline, 4) AS baseline, unit, 'held_out_test' AS split FROM mart""",
    "measures_model": f"""{MODEL_MART}, shown AS (
  SELECT metric, round(value, 4) AS value, round(baseline, 4) AS baseline FROM mart)
SELECT max(value) FILTER (WHERE metric = 'average_precision') AS average_precision,
       max(value) FILTER (WHERE metric = 'roc_auc') AS roc_auc,
       max(value) FILTER (WHERE metric = 'lift_at_20pct') AS lift_at_20pct,
       max(value) FILTER (WHERE metric = 'revenue_mae') AS mae,
       round((max(baseline) FILTER (WHERE metric = 'revenue_mae') - max(value) FILTER (WHERE metric = 'revenue_mae'))
             / max(baseline) FILTER (WHERE metric = 'revenue_mae'), 6) AS mae_improvement
FROM shown""",
    "selection_candidates": """SELECT task, model, true AS measured, CAST(1 AS BIGINT) AS selected_of_task FROM (VALUES
  ('risk', 'prior_baseline'), ('risk', 'logistic_regression'), ('risk', 'gradient_boosting'),
  ('value', 'mean_baseline'), ('value', 'gradient_boosting')) AS candidates(task, model)""",
    "scored_keys": f"""WITH {_panel([SCORE])}
SELECT customer_id, snapshot_date, true AS risk_in_range, true AS value_given FROM panel""",
    "test_prediction_labels": f"""WITH {_panel([TEST])}
SELECT customer_id, snapshot_date, inactive_next90, round(value_next, 2) AS margin_next90, true AS risk_in_range,
       true AS value_given FROM panel""",
}

# Queries that bring the same rows by another way, and label reports over the marts.
ORACLE_SQL |= {
    **{f"text_{name}": ORACLE_SQL[name]
       for name in ("mart_customer_scores", "mart_dim_customer", "mart_dim_product", "mart_dim_date")},
    "text_mart_fact_sales": f"SELECT * EXCLUDE (year_month) FROM ({ORACLE_SQL['mart_fact_sales']})",
    "sorted_event_sink": f"WITH {EV} SELECT count(*) AS event_rows, CAST(0 AS BIGINT) AS rows_out_of_order FROM ev",
    "export_customers": f"""WITH {_portfolio(SCORE)}
SELECT CAST(customer_id AS VARCHAR) AS customer_id, segment, rfm_score, CAST(frequency_365 AS VARCHAR) AS frequency_365 FROM scores
WHERE segment = '{rfm.FIXED_SEGMENTS[3]}' AND CAST(customer_id AS VARCHAR) LIKE '%1%' AND inactive_risk90 >= 0.1""",
    "headline_cards": f"""WITH {EV}
SELECT {_money("net_minor")} AS net_revenue, {SALE_ORDERS} AS sale_orders, {BUYERS} AS purchasing_customers,
       round(-{_sum("net_minor", RETURN)} / {_sum("net_minor", SALE)}::DOUBLE, 6) AS return_value_rate FROM ev""",
    "model_metric_labels": f"SELECT label, round(sum(value), 4) AS value, round(sum(baseline), 4) AS baseline FROM ({ORACLE_SQL['model_metrics']}) GROUP BY label",
    "quality_metric_labels": f"SELECT label, CAST(sum(value) AS BIGINT) AS value FROM ({ORACLE_SQL['data_quality_metrics']}) GROUP BY label",
}
