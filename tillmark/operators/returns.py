"""Returns must point to an earlier sale that still has units left.

Returns of one sale are taken by (time, id); one that asks for more than what
is left is refused and uses nothing up, so a running sum cannot decide it.

Sales are told apart by an aggregate first: where all returns together ask for no
more than was sold, all of them are accepted and none is looked at in sequence.

For the others: the units left never grow. Hence among returns of the same size
the accepted ones come first, and no more than ``sold // size`` of them can be
accepted. Only that many per sale and size need to be looked at in sequence, a
number bounded by the sold quantity and not by how many returns point to the sale.
The cut is made per salt first, so that a sale that most returns point to is spread
over tasks, and then per sale and size.

For the same reason the sequence is decided by one number, the units used, and by
the few returns that were refused at a smaller size than all refused before: a
return is refused exactly if one of at most its size was refused before it or it
does not fit itself, which makes it such a return or follows one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, stored, stored_in_turn

# Commercial fields a return shares with its sale.
SHARED_FIELDS = ("customer_record_id", "product_id", "order_id", "unit_price", "unit_cost", "discount_rate")
_SALTS = 32


def matching_returns(events: DataFrame, shared: Sequence[str] = SHARED_FIELDS) -> DataFrame:
    """Returns that meet every condition but the remaining units, with the sold quantity."""
    sales = events.where(F.col("event_type") == "sale").select(
        F.col("event_id").alias("origin_event_id"),
        F.col("event_time").alias("_sold_at"),
        F.col("quantity").alias("sold_quantity"),
        *[F.col(c).alias(f"_sold_{c}") for c in shared],
    )
    returns = events.where((F.col("event_type") == "return") & (F.col("origin_event_id") != ""))
    matched = returns.select("event_id", "event_time", "quantity", "origin_event_id", *shared).join(
        sales, "origin_event_id"
    )
    fits = (F.col("event_time") >= F.col("_sold_at")) & (F.col("quantity") <= F.col("sold_quantity"))
    for name in shared:
        fits = fits & (F.col(name) == F.col(f"_sold_{name}"))
    return matched.where(fits).select("origin_event_id", "event_id", "event_time", "quantity", "sold_quantity")


def _serve(state: Column, item: Column) -> Column:
    """Units used so far, and refused returns each smaller than those before (no more than there are sizes)."""
    size = item["quantity"]
    fits = state["used"] + size <= item["sold_quantity"]
    smallest = ~fits & (size < state["least"])
    refusal = F.struct(item["event_time"].alias("event_time"), item["event_id"].alias("event_id"), size.alias("quantity"))
    return F.struct(
        F.when(fits, state["used"] + size).otherwise(state["used"]).alias("used"),
        F.when(smallest, size).otherwise(state["least"]).alias("least"),
        F.when(smallest, F.concat(state["refused"], F.array(refusal))).otherwise(state["refused"]).alias("refused"),
    )


def _of_sales(events: DataFrame, slice_: int, slices: int) -> DataFrame:
    """Sales of one slice by hash, with all events that point to them."""
    sale = F.when(F.col("event_type") == "return", F.col("origin_event_id")).otherwise(F.col("event_id"))
    return events.where(F.pmod(F.xxhash64(sale), F.lit(slices)) == slice_) if slices > 1 else events


def accepted_returns(events: DataFrame, shared: Sequence[str] = SHARED_FIELDS, slices: int = 1) -> DataFrame:
    """``event_id`` of every return that its sale can still cover; sales are matched in ``slices`` turns."""
    matched = stored_in_turn(matching_returns(_of_sales(events, i, slices), shared) for i in range(slices))
    wanted = matched.groupBy("origin_event_id").agg(F.sum("quantity").alias("wanted"), F.max("sold_quantity").alias("sold"))
    short = wanted.where("wanted > sold").select("origin_event_id")
    covered = matched.join(short, "origin_event_id", "left_anti").select("event_id")

    def nth(*keys: str) -> Column:
        return F.row_number().over(Window.partitionBy("origin_event_id", "quantity", *keys).orderBy("event_time", "event_id"))

    possible = F.floor(F.col("sold_quantity") / F.col("quantity"))
    candidates = (
        matched.join(short, "origin_event_id", "left_semi")
        .withColumn("_salt", F.pmod(F.xxhash64("event_id"), F.lit(_SALTS)))
        .withColumn("_nth", nth("_salt")).where(F.col("_nth") <= possible)
        .withColumn("_nth", nth()).where(F.col("_nth") <= possible)
    )
    events_type = {f.name: f.dataType.simpleString() for f in matched.schema.fields}
    refused = f"array<struct<event_time:{events_type['event_time']},event_id:{events_type['event_id']},quantity:{events_type['quantity']}>>"
    start = F.struct(
        F.lit(0).cast(events_type["quantity"]).alias("used"), F.lit(float("inf")).cast("double").alias("least"),
        F.array().cast(refused).alias("refused"),
    )
    queue = F.array_sort(F.collect_list(F.struct("event_time", "event_id", "quantity", "sold_quantity")))
    # Decided once per sale, before the queue is taken apart again.
    served = (
        candidates.groupBy("origin_event_id").agg(queue.alias("queue"))
        .withColumn("refused", F.aggregate("queue", start, _serve, lambda state: state["refused"]))
        .select(F.explode("queue").alias("item"), "refused")
    )
    place = F.struct(F.col("item.event_time").alias("event_time"), F.col("item.event_id").alias("event_id"))
    blocked = F.exists(
        "refused",
        lambda x: (x["quantity"] <= F.col("item.quantity")) & (F.struct(x["event_time"].alias("event_time"), x["event_id"].alias("event_id")) <= place),
    )
    decided = stored(covered.unionByName(served.where(~blocked).select(F.col("item.event_id").alias("event_id"))))
    discard(matched)
    return decided
