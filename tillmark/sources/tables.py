"""Readers for the star of parquet tables and the views the operators consume.

``sales_events`` is the canonical line-event view. The ``raw_*`` views turn the
same tables into untreated input (text columns, copies, defects at fixed keys)
so that the cleaning operators have something to reject.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.money import from_minor, round_cents, to_minor
from ..session import apply_runtime_defaults

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet table under ``root`` with its declared schema, never an inferred one."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}.parquet")


def _line_orders(spark: SparkSession, root: str) -> DataFrame:
    apply_runtime_defaults(spark)
    lines = read_table(spark, root, "lineitem")
    orders = read_table(spark, root, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _event_id(order: str = "l_orderkey") -> Column:
    return F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in (order, "l_linenumber", "l_partkey", "l_suppkey")],
        F.to_date("l_shipdate").cast("string"),
    )


def customer_countries(spark: SparkSession, root: str) -> DataFrame:
    """customer_id, country."""
    customer = read_table(spark, root, "customer")
    nation = read_table(spark, root, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country")
    )


def products(spark: SparkSession, root: str) -> DataFrame:
    """Product dimension with its commercial attributes."""
    return read_table(spark, root, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("list_price"),
        round_cents(0.6 * F.col("p_retailprice")).alias("unit_cost"),
    )


def sales_events(spark: SparkSession, root: str, attributes: Iterable[str] = ()) -> DataFrame:
    """Signed, priced line events: one row per order line.

    ``attributes`` names the dimension columns to attach (``country``,
    ``product_name``, ``category``, ``brand``). A dimension is joined only when
    one of its columns is asked for, so a plan never pays for an unused join.
    """
    unit_price = round_cents(F.col("l_extendedprice") / F.col("l_quantity"))
    events = (
        _line_orders(spark, root)
        .select(
            _event_id().alias("event_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("product_id"),
            F.when(F.col("l_linestatus") == "F", "store").otherwise("online").alias("channel"),
            F.col("o_orderdate").alias("event_time"),
            F.when(F.col("l_returnflag") == "R", "return").otherwise("sale").alias("event_type"),
            F.col("l_quantity").alias("quantity"),
            unit_price.alias("unit_price"),
            F.col("l_discount").alias("discount_rate"),
            round_cents(0.6 * unit_price).alias("unit_cost"),
        )
    )
    events = with_accounting(events)
    wanted = set(attributes)
    product_columns = [c for c in ("product_name", "category", "brand") if c in wanted]
    if product_columns:
        events = events.join(products(spark, root).select("product_id", *product_columns), "product_id", "left")
    if "country" in wanted:
        events = events.join(customer_countries(spark, root), "customer_id", "left")
    return events


def with_accounting(events: DataFrame) -> DataFrame:
    """Sign, net revenue and gross margin of each line.

    A sale counts plus, a return minus, a cancellation nothing. Margin is taken
    from the already rounded revenue.
    """
    sign = F.when(F.col("event_type") == "sale", 1).when(F.col("event_type") == "return", -1).otherwise(0)
    return (
        events.withColumn("signed_quantity", (F.col("quantity") * sign).cast("bigint"))
        .withColumn(
            "net_minor", to_minor(F.col("signed_quantity") * F.col("unit_price") * (1 - F.col("discount_rate")))
        )
        .withColumn("net_revenue", from_minor(F.col("net_minor")))
        .withColumn(
            "margin_minor", to_minor(F.col("net_revenue") - F.col("signed_quantity") * F.col("unit_cost"))
        )
        .withColumn("gross_margin", from_minor(F.col("margin_minor")))
    )


def revenue_events(spark: SparkSession, root: str, attributes: Iterable[str] = ()) -> DataFrame:
    """The same lines as the revenue track prices them: no discount, no cost, four digits."""
    wanted = set(attributes)
    events = sales_events(spark, root, wanted)
    keep = ["event_id", "order_id", "customer_id", "product_id", "event_time", "event_type"]
    extra = [c for c in ("product_name", "country") if c in wanted]
    return with_plain_revenue(events.select(*keep, *extra, "signed_quantity", "unit_price"))


def with_plain_revenue(events: DataFrame) -> DataFrame:
    """Revenue of a line is its signed quantity times its price, kept to four digits."""
    return events.withColumn(
        "net_minor", to_minor(F.col("signed_quantity") * F.col("unit_price"), 4)
    ).withColumn("net_revenue", from_minor(F.col("net_minor"), 4))


def customer_records(spark: SparkSession, root: str) -> DataFrame:
    """Source-system customer records with shared e-mails, phones and loyalty ids.

    Three consecutive customers share an e-mail, six share a phone; some of
    them are unverified and some carry loyalty ids that disagree.
    """
    customer = read_table(spark, root, "customer")
    nation = read_table(spark, root, "nation")
    k = F.col("c_custkey")
    group = F.floor(k / 3).cast("bigint")
    place = k % 3
    has_loyalty = ((group % 4 == 0) & (place == 0)) | ((group % 4 == 1) & (place <= 1))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        k.cast("string").alias("record_id"),
        F.when(k % 2 == 0, "web").otherwise("store").alias("source"),
        F.when(has_loyalty, F.concat(F.lit("L"), k.cast("string"))).otherwise("").alias("loyalty_id"),
        F.when(has_loyalty, "True").otherwise("False").alias("loyalty_verified"),
        F.concat(F.lit(" C"), group.cast("string"), F.lit("@Example.invalid")).alias("email"),
        F.when(k % 7 != 0, "true").otherwise("false").alias("email_verified"),
        F.concat(F.lit("(P) "), F.floor(k / 6).cast("string")).alias("phone"),
        F.lit("1").alias("phone_verified"),
        F.col("n_name").alias("city"),
        F.when(k % 5 != 0, "1").otherwise("0").alias("marketing_consent"),
    )


def raw_events(spark: SparkSession, root: str) -> DataFrame:
    """Untreated margin-track events: text columns, copies, one defect kind per key family."""
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    is_return = F.col("l_returnflag") == "R"
    price = round_cents(F.col("l_extendedprice") / F.col("l_quantity"))
    clock = F.when(is_return, F.greatest("o_orderdate", "l_shipdate")).otherwise(F.col("o_orderdate"))
    apply_runtime_defaults(spark)
    # Joined by the text of the order key: later steps by order find their rows where they are.
    lines = read_table(spark, root, "lineitem").withColumn("order_id", order.cast("string")).drop("l_orderkey")
    orders = read_table(spark, root, "orders").withColumn("order_id", F.col("o_orderkey").cast("string"))
    order = F.col("order_id").cast("bigint")
    base = lines.join(orders, "order_id").select(
        _event_id("order_id").alias("event_id"),
        "order_id",
        F.when(F.col("o_custkey") % 61 == 0, F.concat(F.lit("X"), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_record_id"),
        F.when(part % 67 == 0, F.concat(F.lit("X"), part.cast("string")))
        .otherwise(part.cast("string"))
        .alias("product_id"),
        F.when(order % 71 == 0, "no time").otherwise(clock.cast("string")).alias("event_time"),
        F.when(is_return, "return")
        .when(supplier % 73 == 0, "gift")
        .when(supplier % 37 == 0, "cancelled")
        .otherwise("sale")
        .alias("event_type"),
        F.when(part % 83 == 0, "n/a")
        .when(part % 89 == 0, "0")
        .when(part % 97 == 0, "2.5")
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.when(part % 101 == 0, "-1").otherwise(price.cast("string")).alias("unit_price"),
        F.when(supplier % 83 == 0, "1.5").otherwise(F.col("l_discount").cast("string")).alias("discount_rate"),
        round_cents(0.6 * price).cast("string").alias("unit_cost"),
        F.when(supplier % 79 == 0, "kiosk")
        .when(F.col("l_linestatus") == "F", "store")
        .otherwise("online")
        .alias("channel"),
        (order % 50 == 0).alias("copied"),
    )
    sale_id = F.when(F.col("event_type") == "sale", F.col("event_id"))
    return (
        base.withColumn("first_sale_id", F.min(sale_id).over(Window.partitionBy("order_id")))
        .withColumn(
            "origin_event_id",
            F.when(F.col("event_type") == "return", F.coalesce("first_sale_id", F.lit(""))).otherwise(""),
        )
        .withColumn("copy", F.explode(F.when(F.col("copied"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select(
            "event_id", "order_id", "customer_record_id", "product_id", "event_time", "event_type",
            "quantity", "unit_price", "discount_rate", "unit_cost", "channel", "origin_event_id",
        )
    )


def raw_products(spark: SparkSession, root: str) -> DataFrame:
    """Product records with a text key, as the raw events reference them."""
    return products(spark, root).withColumn("product_id", F.col("product_id").cast("string"))


# Total order of the lines of one part, standing for their order in a sheet.
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def raw_line_parts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Two overlapping parts of untreated revenue-track lines, by part name.

    The overlap of half a year repeats rows in both parts, as a yearly export
    with a shared month does.
    """
    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    is_return = F.col("l_returnflag") == "R"
    whole = F.col("l_quantity").cast("int")
    quantity = F.when(is_return & (supplier % 29 != 0), -whole).otherwise(whole)
    apply_runtime_defaults(spark)
    # Names join the lines of all parts once, countries the orders, of which there are fewer than lines.
    named = read_table(spark, root, "lineitem").join(
        products(spark, root), F.col("l_partkey") == F.col("product_id"), "left"
    )
    placed = read_table(spark, root, "orders").join(
        customer_countries(spark, root), F.col("o_custkey") == F.col("customer_id"), "left"
    )
    rows = named.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(order % 89 == 0, F.lit(None))
        .when(is_return, F.concat(F.lit(" c"), order.cast("string")))
        .otherwise(F.concat(order.cast("string"), F.lit("\t")))
        .alias("Invoice"),
        F.when(part % 97 == 0, "  ").otherwise(part.cast("string")).alias("StockCode"),
        F.when(part % 11 != 0, F.concat(F.lit(" "), F.col("product_name"))).alias("Description"),
        F.when(supplier % 53 == 0, "x").when(supplier % 59 == 0, "0").otherwise(quantity.cast("string")).alias("Quantity"),
        F.when(order % 71 == 0, "unknown").otherwise(F.col("o_orderdate").cast("string")).alias("InvoiceDate"),
        F.when(part % 83 == 0, "0")
        .when(part % 101 == 0, "-2.5")
        .otherwise(round_cents(F.col("l_extendedprice") / F.col("l_quantity")).cast("string"))
        .alias("Price"),
        F.when(F.col("o_custkey") % 7 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("Customer ID"),
        F.when(F.col("o_custkey") % 13 != 0, F.col("country")).alias("Country"),
        *LINE_ORDER,
        "o_orderdate",
    )
    early = F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return {
        "Year 1995-1998": rows.where(early).drop("o_orderdate"),
        "Year 1998-2001": rows.where(late).drop("o_orderdate"),
    }
