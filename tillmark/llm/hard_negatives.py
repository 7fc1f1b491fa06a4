"""Hard negatives of anchor vectors by threshold joins over an inverted index.

Every anchor first needs its best rows of the same label, then for each of these
positives the best rows of other labels whose score lies in a window below the
positive's. Both are threshold joins: given a score each anchor asks for, find
all rows that reach it.

Rows are dealt into blocks of a fixed number of rows, anchors into blocks of
their own, and every (anchor block, row block) is one group of a co-grouped
map. Inside a group

* rows are indexed by dimension, but leave out the leading dimensions that a
  suffix of norms covers: if the norm of a row's first k values times the largest
  anchor norm stays below the least threshold, a pair can reach it only with help
  of a later dimension. Rows with the same k share posting lists, kept as one
  matrix with a line for each dimension;
* partial scores are accumulated list by list, in steps of several dimensions.
  After each step a pair is dropped when its partial score plus the product of
  the norms of what remains (covered dimensions included) misses the threshold;
* what survives is completed with the covered dimensions, so scores are exact.

Thresholds start high: where the wanted number of rows is to be expected if scores
were normally distributed, with moments from a bounded seed of rows. Anchors whose
windows are not full after a round ask again with a lower threshold, down to one
that is sure (for positives the wanted rank among the seed, or no limit; for
negatives the lower end of the window). Anchors that have enough leave the join.
The seed and the moments decide how much is found per round and never the result.

A task passes on at most the wanted number of rows per anchor and window, so what
is shuffled is bounded by anchors x blocks, and in practice close to the number of
rows that reach a threshold.

Scores are integers. Sums are exact in 32-bit floats while norms multiply to less
than 2^24, in 64-bit floats to 2^53, then in 64-bit integers; beyond 2^62 a
``ValueError`` is raised.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; vectors of other lengths count as filled up with zeros;
rows with the anchor's id are never its own positives; every other row counts,
repeated ones each; ties go by the smaller id, then in any order; an anchor
without another row of its label has no positives; a label alone in the table has
no negatives; an anchor row that is repeated gives its rows again; other columns
are left out, so their names cannot clash; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

POSITIVES, NEGATIVES = 5, 5
# Rows of a block, anchors of a block, rows that thresholds are guessed from.
ROW_BLOCK, ANCHOR_BLOCK, SEED_ROWS = 4_096, 8_192, 4_096
# Dimensions accumulated between two prunings, and anchors scored at once.
STEP, ANCHORS_AT_ONCE = 32, 256
# Rows expected above the first threshold, for each wanted one.
MARGIN = 4
NO_LIMIT = -(1 << 62)


def whole_vectors(table: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows that take part, with components floor(scale * x): vec_id, label, ints."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (
        table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & sound)
        .select(
            F.col("vec_id").cast("long"), F.col("label").cast("long"),
            F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale))).alias("ints"),
        )
    )


def mine(
    rows: DataFrame, is_anchor: Column, low: int = 80, positives: int = POSITIVES, negatives: int = NEGATIVES,
    row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK, seed_rows: int = SEED_ROWS,
) -> DataFrame:
    """Negatives of rows (vec_id, label, ints) per anchor and positive.

    Negatives score at most as much as the positive and at least ``low`` percent of it.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    rows = stored(rows.withColumn("norm", _norm("ints")))
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_anchor.cast("long")).alias("anchors"), F.max("norm").alias("norm"),
        F.coalesce(F.max(F.array_max(F.transform("ints", lambda x: F.abs(x)))), F.lit(0)).alias("most"),
    ).first()
    if facts["n"] and (facts["norm"] * facts["norm"] >= 2.0**62):
        raise ValueError("scores would not fit in 64 bits")
    kind = "array<smallint>" if facts["most"] < 1 << 15 else "array<bigint>"
    n_rows, n_anchors = -(-facts["n"] // row_block) or 1, -(-(facts["anchors"] or 0) // anchor_block) or 1
    narrow = rows.withColumn("ints", F.col("ints").cast(kind))
    blocks = stored(narrow.repartition(n_rows).withColumn("row_block", F.spark_partition_id()))
    anchors = narrow.where(is_anchor).repartition(n_anchors).select(
        F.monotonically_increasing_id().alias("anchor"), F.spark_partition_id().alias("anchor_block"), "vec_id", "label", "ints", "norm"
    )
    # The first rows by the hash of their id: a bounded seed that does not depend on the layout.
    seed = blocks.orderBy(F.xxhash64("vec_id"), "vec_id").limit(seed_rows).select("label", "ints").toArrow()
    of_label = rows.groupBy("label").agg(F.count(F.lit(1)).alias("of_label"))
    anchors = stored(_with_guesses(anchors.join(of_label, "label"), seed, positives))

    found = stored(_positives(blocks, anchors, n_rows, n_anchors, positives))
    windows = stored(
        found.select("anchor", "score").distinct().join(
            anchors.select("anchor", "anchor_block", "vec_id", "label", "ints", "norm", "other_mean", "other_sd", "of_label"), "anchor"
        )
    )
    mined = _negatives(blocks, windows, n_rows, n_anchors, facts["n"], negatives, low)
    return (
        found.withColumnsRenamed({"found_id": "positive_id", "score": "positive_score"})
        .join(mined.withColumnsRenamed({"upper": "positive_score", "found_id": "negative_id", "score": "negative_score"}), ["anchor", "positive_score"])
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _norm(column: str) -> Column:
    return F.sqrt(F.aggregate(column, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


# ---------------------------------------------------------------------- thresholds


def _with_guesses(anchors: DataFrame, seed: pa.Table, positives: int) -> DataFrame:
    """First and sure thresholds for positives and the moments of other labels' scores, from a bounded seed of rows."""
    seed_labels = seed.column("label").to_numpy()
    seed_matrix = _matrix(seed.column("ints").combine_chunks(), np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, of_label = batch.column("label").to_numpy(), batch.column("of_label").to_numpy()
            scores = _product(_matrix(batch.column("ints"), np.float64), seed_matrix)
            first, sure, mean, sd = (np.zeros(len(labels)) for _ in range(4))
            for i, label in enumerate(labels):
                same, other = scores[i, seed_labels == label], scores[i, seed_labels != label]
                # the anchor itself may be in the seed, so one more row is asked for
                sure[i] = np.sort(same)[-positives - 1] if len(same) > positives else NO_LIMIT
                share = min(0.5, MARGIN * (positives + 1) / of_label[i])
                first[i] = max(sure[i], math.floor(_reached(same, share))) if len(same) > 1 else sure[i]
                mean[i], sd[i] = (other.mean(), other.std()) if len(other) > 1 else (0.0, 0.0)
            extra = [pa.array(first.astype(np.int64)), pa.array(sure.astype(np.int64)), pa.array(mean), pa.array(sd)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "first", "sure", "other_mean", "other_sd"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
    return anchors.mapInArrow(run, f"{kinds}, first bigint, sure bigint, other_mean double, other_sd double")


def _reached(scores: np.ndarray, share: float) -> float:
    """The score that a share of rows should reach."""
    return scores.mean() + scores.std() * NormalDist().inv_cdf(1 - share)


def _positives(blocks: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, positives: int) -> DataFrame:
    """Best rows of the anchor's label: anchor, found_id, score. Thresholds fall until every anchor has its number."""
    wanted = F.least(F.lit(positives), F.col("of_label") - 1)
    asking = anchors.select(
        "anchor", "anchor_block", "vec_id", "label", "ints", "norm", "of_label", "sure", F.col("first").alias("threshold"),
        F.lit(None).cast("bigint").alias("upper"), wanted.alias("wanted"),
    )
    done = []
    while True:
        best = stored(_best(_joined(blocks, asking, n_rows, n_anchors, True, positives), positives).drop("rank", "upper"))
        counts = best.groupBy("anchor").agg(F.count(F.lit(1)).alias("filled"))
        state = stored(asking.join(counts, "anchor", "left").withColumn("filled", F.coalesce("filled", F.lit(0))))
        open_ = (F.col("filled") < F.col("wanted")) & (F.col("threshold") > NO_LIMIT)
        done.append(best.join(state.where(open_).select("anchor"), "anchor", "left_anti"))
        # below the sure threshold only an anchor of repeated ids is open, and a threshold without limit ends the search
        asking = state.where(open_).withColumn(
            "threshold", F.when(F.col("threshold") > F.col("sure"), F.col("sure")).otherwise(F.lit(NO_LIMIT))
        ).drop("filled")
        if asking.isEmpty():
            break
    return _union(done)


def _negatives(blocks: DataFrame, windows: DataFrame, n_rows: int, n_anchors: int, n: int, negatives: int, low: int) -> DataFrame:
    """Best rows of other labels in each window: anchor, upper, found_id, score, rank."""

    @F.pandas_udf("bigint")
    def guessed(upper: pd.Series, mean: pd.Series, sd: pd.Series, others: pd.Series) -> pd.Series:
        """The score that the wanted number of rows below ``upper`` should reach, some to spare."""
        normal, found = NormalDist(), []
        for u, m, s, share in zip(upper, mean, sd, MARGIN * negatives / others.clip(lower=1)):
            share += 1 - normal.cdf((u - m) / s) if s else 1
            found.append(math.floor(m + s * normal.inv_cdf(1 - share)) if 0 < share < 1 else NO_LIMIT)
        return pd.Series(found, dtype="int64")

    # the least whole score with 100 * score >= low * upper; below zero no score fits
    lower = F.call_function("div", F.col("upper").cast("decimal(20,0)") * F.lit(low) + F.lit(99), F.lit(100))
    guess = guessed("upper", "other_mean", "other_sd", F.lit(n) - F.col("of_label"))
    asking = (
        windows.where("score >= 0").withColumnRenamed("score", "upper").withColumn("lower", lower)
        .withColumn("threshold", F.greatest("lower", F.least("upper", guess)))
    )
    done = []
    while True:
        best = stored(_best(_joined(blocks, asking, n_rows, n_anchors, False, negatives), negatives))
        counts = best.groupBy("anchor", "upper").agg(F.count(F.lit(1)).alias("filled"))
        state = stored(asking.join(counts, ["anchor", "upper"], "left").withColumn("filled", F.coalesce("filled", F.lit(0))))
        open_ = (F.col("filled") < negatives) & (F.col("threshold") > F.col("lower"))
        done.append(best.join(state.where(open_).select("anchor", "upper"), ["anchor", "upper"], "left_anti"))
        asking = state.where(open_).withColumn("threshold", F.col("lower")).drop("filled")
        if asking.isEmpty():
            break
    return _union(done)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _best(found: DataFrame, most: int) -> DataFrame:
    """The best rows of each anchor and window; a window holds at most ``most`` rows of each block."""
    order = Window.partitionBy("anchor", "upper").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


# ------------------------------------------------------------------ threshold joins


def _joined(blocks: DataFrame, asking: DataFrame, n_rows: int, n_anchors: int, same: bool, most: int) -> DataFrame:
    """Rows that reach the threshold of an anchor, each row block against each anchor block."""
    left = blocks.select("row_block", "vec_id", "label", "ints", "norm").withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))))
    right = asking.select("anchor_block", "anchor", "vec_id", "label", "ints", "norm", "threshold", "upper").withColumn(
        "row_block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1)))
    )

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        return threshold_join(rows, anchors, same, most)

    keys = ["anchor_block", "row_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "anchor bigint, upper bigint, found_id bigint, score bigint")


def threshold_join(rows: pa.Table, anchors: pa.Table, same: bool, most: int) -> pa.Table:
    """Rows of one block that reach the thresholds of one block of anchors, at most ``most`` per anchor and window.

    ``same``: rows of the anchor's label and another id, else rows of another label that score at most ``upper``.
    """
    out: list[tuple[np.ndarray, ...]] = []
    if rows.num_rows and anchors.num_rows:
        index = Index(rows, float(np.max(anchors.column("norm").to_numpy())))
        # Windows of one anchor are neighbours, and anchors that ask for much share a step.
        anchors = anchors.sort_by([("threshold", "descending"), ("anchor", "ascending")])
        for start in range(0, anchors.num_rows, ANCHORS_AT_ONCE):
            part = anchors.slice(start, ANCHORS_AT_ONCE).combine_chunks()
            out += index.reached(part, same, most)
    columns = [np.concatenate([x[k] for x in out]) if out else np.empty(0, np.int64) for k in range(4)]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor", "upper", "found_id", "score"])


class Index:
    """Posting lists of a block of rows, without the leading dimensions that norms cover."""

    def __init__(self, rows: pa.Table, largest: float):
        self.ids, self.labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        product = largest * float(np.max(rows.column("norm").to_numpy()))
        self.kind = np.float32 if product < 2**24 else np.float64 if product < 2**53 else np.int64
        self.values = _matrix(rows.column("ints").combine_chunks(), self.kind)
        squares = np.square(self.values.astype(np.float64))
        # prefix[:, k]: norm of the first k dimensions of each row
        self.prefix = np.sqrt(np.concatenate([np.zeros((len(squares), 1)), np.cumsum(squares, axis=1)], axis=1))
        self.largest = largest

    def lists(self, threshold: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Groups of rows by the number of dimensions left out: that number, the rows, one line per indexed dimension."""
        dims = self.values.shape[1]
        covered = np.sum(_slack(self.prefix[:, 1:] * self.largest) < threshold, axis=1) if threshold > 0 else np.zeros(len(self.ids), int)
        # whole steps are left out, so that few groups remain
        covered = np.where(covered == dims, dims, covered // STEP * STEP)
        for left_out in np.unique(covered):
            if left_out < dims:
                members = np.flatnonzero(covered == left_out)
                yield int(left_out), members, np.ascontiguousarray(self.values[members, left_out:].T)

    def reached(self, anchors: pa.Table, same: bool, most: int) -> list[tuple[np.ndarray, ...]]:
        threshold = anchors.column("threshold").to_numpy()
        numbers, upper = anchors.column("anchor").to_numpy(), anchors.column("upper").fill_null(0).to_numpy()
        own, labels = anchors.column("vec_id").to_numpy(), anchors.column("label").to_numpy()
        queries = _matrix(anchors.column("ints").combine_chunks(), self.kind, self.values.shape[1])
        squares = np.square(queries.astype(np.float64))
        before = np.sqrt(np.concatenate([np.zeros((len(squares), 1)), np.cumsum(squares, axis=1)], axis=1))
        after = np.sqrt(np.maximum(before[:, -1:] ** 2 - before**2, 0.0))
        dims, found = self.values.shape[1], []
        for left_out, members, lists in self.lists(int(threshold.min())):
            rows_before = self.prefix[members]
            rows_after = np.sqrt(np.maximum(rows_before[:, -1:] ** 2 - rows_before**2, 0.0))
            scores = np.zeros((len(queries), len(members)), self.kind)
            alive = None
            for at in range(left_out, dims, STEP):
                stop = min(at + STEP, dims)
                if alive is None:
                    scores += _product(queries[:, at:stop], lists[at - left_out : stop - left_out].T)
                else:
                    q, r = alive
                    scores[q, r] += np.einsum("ij,ij->i", queries[q, at:stop], lists[at - left_out : stop - left_out, r].T)
                if stop == dims and not left_out:
                    break
                # what is still to come: covered dimensions and those after this step
                rest = before[:, left_out, None] * rows_before[None, :, left_out] + after[:, stop, None] * rows_after[None, :, stop]
                hope = np.nonzero(scores + _slack(rest) >= threshold[:, None])
                if alive is not None:
                    keep = scores[alive] + _slack(rest[alive]) >= threshold[alive[0]]
                    alive = alive[0][keep], alive[1][keep]
                elif 16 * len(hope[0]) < scores.size:
                    alive = hope
            q, r = np.nonzero(scores >= threshold[:, None]) if alive is None and not left_out else alive or np.nonzero(np.ones(scores.shape, bool))
            exact = scores[q, r]
            if left_out and len(q):
                exact = exact + np.einsum("ij,ij->i", queries[q, :left_out], self.values[members[r], :left_out])
            row = members[r]
            exact = exact.astype(np.int64)
            fits = (exact >= threshold[q]) & ((labels[q] == self.labels[row]) == same)
            fits &= (own[q] != self.ids[row]) if same else (exact <= upper[q])
            found.append((q[fits], row[fits], exact[fits]))
        q, row, score = (np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64) for k in range(3))
        order = np.lexsort((self.ids[row], -score, q))
        q, row, score = q[order], row[order], score[order]
        begin = np.searchsorted(q, q, side="left")
        first = np.arange(len(q)) - begin < most
        q, row, score = q[first], row[first], score[first]
        return [(numbers[q], upper[q], self.ids[row], score)]


def _slack(bound: np.ndarray) -> np.ndarray:
    """A bound with room for rounding."""
    return bound * (1 + 1e-9) + 1e-3


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed; the narrower side is filled up with zeros."""
    width = min(a.shape[1], b.shape[1])
    return a[:, :width] @ b[:, :width].T


def _matrix(lists: pa.ListArray, kind: type, width: int | None = None) -> np.ndarray:
    """Lists as rows of a matrix, filled up with zeros or cut where all others end."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    dims = int(sizes.max(initial=0))
    if len(values) == dims * len(sizes):
        matrix = values.reshape(len(sizes), dims).astype(kind)
    else:
        matrix = np.zeros((len(sizes), dims), kind)
        matrix[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    if width is None or width == dims:
        return matrix
    return np.pad(matrix, ((0, 0), (0, max(0, width - dims))))[:, :width]
