"""Global order without a single-task window.

A window without PARTITION BY moves all rows to one task. Here rows are range
partitioned by the wanted order, sorted inside each partition and written to
the checkpoint folder together with their position. Ranks and running totals
then need only one offset per partition, a table no longer than the number of
partitions (times groups). A large table can be laid out in turns, one range of
the order after another, so that the disk holds the shuffle files of one range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..session import stored, stored_in_turn

# monotonically_increasing_id: partition number above bit 33, row position below.
_POSITION_BITS = 33
# Partition numbers have 31 bits; the number of the range stands above them.
_PARTITION_BITS = 31
_BROADCAST_ROWS = 100_000


def _small(offsets: DataFrame, group: Sequence[str]) -> DataFrame:
    """Broadcast the offsets where that is safe.

    Without groups there is one row per partition. With groups their number is
    counted first; beyond the limit the planner joins by shuffle.
    """
    if not group or offsets.limit(_BROADCAST_ROWS + 1).count() <= _BROADCAST_ROWS:
        return F.broadcast(offsets)
    return offsets


def ranges(column: str, cuts: Sequence) -> list[Column]:
    """Conditions that part rows by ``column`` at ascending ``cuts``, in ascending order with nulls first."""
    at = F.col(column)
    if not cuts:
        return []
    inner = [(at > low) & (at <= high) for low, high in zip(cuts, cuts[1:])]
    return [at.isNull() | (at <= cuts[0]), *inner, at > cuts[-1]]


def _laid_out(
    df: DataFrame, group: Sequence[str], order: Sequence[Column],
    turns: Sequence[Column] = (), columns: Sequence[str] | None = None,
) -> DataFrame:
    keys = [F.col(c) for c in group] + list(order)

    def one(number: int, rows: DataFrame) -> DataFrame:
        ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        ordered = ordered.withColumn("_at", F.monotonically_increasing_id())
        part = F.shiftright("_at", _POSITION_BITS) + F.lit(number << _PARTITION_BITS)
        return ordered.select(*(columns or df.columns), "_at", part.alias("_part"))

    return stored_in_turn(one(i, df.where(turn)) for i, turn in enumerate(turns)) if turns else stored(one(0, df))


def global_rank(
    df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), name: str = "rank",
    turns: Sequence[Column] = (), columns: Sequence[str] | None = None,
) -> DataFrame:
    """Add the 1-based row number in ``order``, within each ``group`` when given.

    ``order`` must be total (end it with a unique key) for a repeatable result.
    ``turns`` are conditions that hold one after another in ``order`` within each
    group and part the rows; each is laid out apart. ``columns`` are those to keep
    (default: all), the group's among them.
    """
    ordered = _laid_out(df, group, order, turns, columns)
    pieces = ordered.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *group, "_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    ranked = ordered.join(_small(stored(offsets), group), [*group, "_part"])
    return ranked.withColumn(name, F.col("_before") + F.col("_at") - F.col("_first") + 1).drop(
        "_at", "_part", "_first", "_before"
    )


def totals_so_far(df: DataFrame, order: Sequence[Column], columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Add inclusive running sums ``<column>_so_far`` in ``order`` and the sum ``<column>_in_all``, within each ``group``.

    Totals of the partitions are taken first. Without groups they are one row per
    partition, which the driver turns into literals; with groups they are joined
    by group and partition, so that a large group is spread like its rows.
    """
    ordered = _laid_out(df, group, order)
    pieces = ordered.groupBy(*group, "_part").agg(*[F.sum(c).alias(f"_p_{c}") for c in columns])
    inside = Window.partitionBy(*group, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = ordered.withColumns({f"_r_{c}": F.sum(c).over(inside) for c in columns})
    if group:
        earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = pieces.select(
            *group, "_part",
            *[F.coalesce(F.sum(f"_p_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in columns],
            *[F.sum(f"_p_{c}").over(Window.partitionBy(*group)).alias(f"{c}_in_all") for c in columns],
        )
        # The window has already placed the rows by these keys, so only the offsets move.
        summed = summed.join(offsets, [*group, "_part"])
    else:
        found = sorted(pieces.collect(), key=lambda row: row["_part"])
        for c in columns:
            starts, total = [], 0
            for row in found:
                starts += [F.lit(row["_part"]), F.lit(total)]
                total += row[f"_p_{c}"]
            before = F.element_at(F.create_map(*starts), F.col("_part")) if starts else F.lit(0)
            summed = summed.withColumns({f"_b_{c}": before, f"{c}_in_all": F.lit(total)})
    return summed.select(
        *df.columns, *[(F.col(f"_b_{c}") + F.col(f"_r_{c}")).alias(f"{c}_so_far") for c in columns], *[f"{c}_in_all" for c in columns]
    )


def rows_at_ranks(
    df: DataFrame, order: Sequence[Column], ranks_of: Callable[[int], Iterable[int]]
) -> tuple[int, dict[int, Row]]:
    """The row count and the rows that stand at chosen ranks of the global order.

    ``ranks_of`` maps the row count to the wanted ranks; it must name a small
    fixed number of them, since those rows come to the driver.
    """
    ordered = _laid_out(df, (), order)
    pieces = ordered.groupBy("_part").agg(F.min("_at").alias("first"), F.count("*").alias("rows")).collect()
    pieces.sort(key=lambda piece: piece["_part"])
    total = sum(piece["rows"] for piece in pieces)
    places: dict[int, int] = {}
    for rank in sorted(set(ranks_of(total))):
        left = rank
        for piece in pieces:
            if left <= piece["rows"]:
                places[piece["first"] + left - 1] = rank
                break
            left -= piece["rows"]
    found = ordered.where(F.col("_at").isin(list(places))).collect() if places else []
    return total, {places[row["_at"]]: row for row in found}
