"""Divergence of sources from each other and from their language, by a frequent-pattern tree of term rows.

Per language the terms found in enough documents are kept. A source's share of a
term is a smoothed integer p. Two sources differ by the sum of abs(p - q) over all
kept terms, which would be terms x sources^2 work. Most counts are zero, so

    sum = terms * |z - z'| + one-sided corrections + pair corrections,

where z is a source's p of a term it never uses. A one-sided correction of a
source needs only how many of its terms have each count. A pair correction
concerns a term that both sources use, and here the tree comes in: every term is
a row of its nonzero (source, count) items in source order, equal rows are
counted once with their multiplicity, and rows are sorted, so that a shared
beginning is a shared path of the tree. Multiplicities add up along the path, and
each node's correction with each of its ancestors is computed once for all terms
below it, however many they are. Sums over subtrees add up, so tasks hold trees of
a bounded number of rows and Spark adds their sums.

All arithmetic is in integers: shares in decimals until they are divided, then in
64 bits (a sum is below 10^9 times the number of kept terms).

Defined results: null text, language and source are ''; a text without terms
counts its group and nothing else; a language without kept terms has pairs of
value 0 and no term rows; a language of one source has no pairs; ties go by the
UTF-8 order of the item; repeated rows are documents of their own, as no id is
read; other columns are left out, so their names cannot clash; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import raw_texts, slices, stored

MIN_DOCUMENTS = 30
SCALE, SMOOTHING = 1_000_000_000, 5
TERM_RANKS = 50
_TERMS = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Distinct (language, source, term) a task holds before it passes its counts on.
HELD = 400_000
# Items of the rows that one tree holds.
TREE_ITEMS = 200_000


def divergence(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, term_ranks: int = TERM_RANKS, tree_items: int = TREE_ITEMS
) -> DataFrame:
    """Ranks of other sources (part 'pair') and of typical terms (part 'term') per language and source of (text, lang, source)."""
    named = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    terms = stored(kept_terms(named, min_documents))
    groups = stored(group_totals(named, terms))
    pairs = pair_distances(terms, groups, tree_items)
    return _ranked(pairs, "pair").unionByName(_ranked(typical_terms(terms, groups), "term", term_ranks))


# ------------------------------------------------------------------------- counts


def kept_terms(named: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Terms in enough documents of their language, each with its (source, n) items in source order: lang, term, items."""
    counted = (
        named.mapInArrow(_count_terms, "lang string, term string, documents bigint, items array<struct<source:string,n:bigint>>")
        .repartition("lang", "term")
        .select("lang", "term", "documents", F.posexplode("items").alias("place", "item"))
        .groupBy("lang", "term", "item.source")
        .agg(F.sum("item.n").alias("n"), F.sum(F.when(F.col("place") == 0, F.col("documents"))).alias("documents"))
    )
    # both groupings keep the partitioning by (lang, term), so only the first exchange moves rows
    return (
        counted.groupBy("lang", "term")
        .agg(F.sum("documents").alias("documents"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("items"))
        .where(F.col("documents") >= min_documents)
        .select("lang", "term", "items")
    )


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language and term: documents that hold it, and occurrences per source, added up over the task."""
    holders: dict[str, Counter] = defaultdict(Counter)
    counts: dict[str, dict[bytes, dict[str, int]]] = defaultdict(dict)
    held = 0
    for batch in slices(batches, "text"):
        rows = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), raw_texts(batch))
        for lang, source, text in rows:
            found = Counter(_TERMS.findall(text.translate(_FOLD)))
            holders[lang].update(found.keys())
            of_lang = counts[lang]
            for term, n in found.items():
                per_source = of_lang.get(term)
                if per_source is None:
                    of_lang[term] = {source: n}
                    held += 1
                elif source in per_source:
                    per_source[source] += n
                else:
                    per_source[source] = n
                    held += 1
        if held > HELD:
            yield from _count_batches(holders, counts)
            holders.clear()
            counts.clear()
            held = 0
    yield from _count_batches(holders, counts)


def _count_batches(holders: dict[str, Counter], counts: dict[str, dict[bytes, dict[str, int]]]) -> Iterator[pa.RecordBatch]:
    for lang, of_lang in counts.items():
        terms = list(of_lang)
        for start in range(0, len(terms), 20_000):
            part = terms[start : start + 20_000]
            per_source = [of_lang[t] for t in part]
            items = pa.StructArray.from_arrays(
                [
                    pa.array([s for x in per_source for s in x], pa.string()),
                    pa.array([n for x in per_source for n in x.values()], pa.int64()),
                ],
                ["source", "n"],
            )
            ends = pa.array(np.cumsum([0, *map(len, per_source)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([holders[lang][t] for t in part], pa.int64()), pa.ListArray.from_arrays(ends, items),
                ],
                ["lang", "term", "documents", "items"],
            )


def group_totals(named: DataFrame, terms: DataFrame) -> DataFrame:
    """Every (lang, source) of the documents: total of its counts, kept terms of the language, p of a zero count.

    The row with null source is the language itself.
    """
    occurring = named.select("lang", "source").distinct()
    totals = terms.select("lang", F.explode("items").alias("item")).groupBy("lang", "item.source").agg(F.sum("item.n").alias("total"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    sources = occurring.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"))
    langs = sources.groupBy("lang").agg(F.sum("total").alias("total")).select("lang", F.lit(None).cast("string").alias("source"), "total")
    return (
        sources.unionByName(langs).join(kept, "lang", "left")
        .select("lang", "source", "total", F.coalesce("kept", F.lit(0)).alias("kept"))
        .withColumn("zero", F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept"))))
    )


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)) without rounding."""
    above = (count.cast("decimal(20,0)") + F.lit(SMOOTHING)) * F.lit(SCALE).cast("decimal(10,0)")
    below = (total.cast("decimal(20,0)") + kept.cast("decimal(18,0)") * F.lit(SMOOTHING)).cast("decimal(21,0)")
    return F.call_function("div", above.cast("decimal(35,0)"), below) + F.lit(1)


# -------------------------------------------------------------------------- terms


def typical_terms(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Terms of a group with a larger share than in the language: lang, source, item, value."""
    sources = groups.where("source IS NOT NULL").select("lang", "source", "total", "kept")
    langs = groups.where("source IS NULL").select("lang", F.col("total").alias("lang_total"))
    in_lang = F.aggregate("items", F.lit(0).cast("long"), lambda whole, item: whole + item["n"])
    return (
        terms.select("lang", "term", in_lang.alias("lang_n"), F.explode("items").alias("item"))
        .select("lang", F.col("item.source").alias("source"), "term", "lang_n", F.col("item.n").alias("n"))
        .join(sources, ["lang", "source"]).join(langs, "lang")
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
        .withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("kept")))
        .where("p > q")
        .select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    )


def _ranked(found: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked.where(F.col("rank") <= most) if most else ranked


# -------------------------------------------------------------------------- pairs


def pair_distances(terms: DataFrame, groups: DataFrame, tree_items: int = TREE_ITEMS) -> DataFrame:
    """Sum of abs(p - q) over all kept terms for each source and each other source of its language."""
    sources = groups.where("source IS NOT NULL").select("lang", "source", "total", "kept", "zero")
    shares = (
        terms.select("lang", "term", F.explode("items").alias("item"))
        .select("lang", "term", F.col("item.source").alias("source"), F.col("item.n").alias("n"))
        .join(sources, ["lang", "source"])
        .select("lang", "term", "source", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), "zero")
    )
    rows = (
        shares.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "zero"))).alias("path"))
        .groupBy("lang", "path").agg(F.count(F.lit(1)).alias("times"))
    )

    def trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _tree_sums(batches, tree_items)

    both = (
        rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
        .mapInArrow(trees, "lang string, source string, other string, value bigint")
    )
    others = sources.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"))
    used = shares.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("times"))
    one_sided = used.join(others, "lang").where("source <> other").select(
        "lang", "source", "other",
        (F.col("times") * (F.abs(F.col("p") - F.col("other_zero")) - F.abs(F.col("zero") - F.col("other_zero")))).alias("value"),
    )
    unused = sources.join(others, "lang").where("source <> other").select(
        "lang", "source", "other",
        F.coalesce(F.col("kept") * F.abs(F.col("zero") - F.col("other_zero")), F.lit(0)).cast("long").alias("value"),
    )

    def turned(found: DataFrame) -> DataFrame:
        return found.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value")

    every = unused.unionByName(one_sided).unionByName(turned(one_sided)).unionByName(both).unionByName(turned(both))
    return every.groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))


def _tree_sums(batches: Iterable[pa.RecordBatch], tree_items: int) -> Iterator[pa.RecordBatch]:
    """Pair corrections (lang, source, other, value) of sorted rows (lang, path, times), tree by tree."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        codes = langs.indices.to_numpy()
        sizes = np.diff(batch.column("path").offsets.to_numpy())
        # A new tree where the language changes or the items are enough for one.
        room = np.cumsum(sizes) // tree_items
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(room) != 0)) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(codes)]):
            if stop > start:
                part = batch.slice(start, stop - start)
                yield from _sums_of_tree(part, langs.dictionary[int(codes[start])].as_py())


def _sums_of_tree(rows: pa.RecordBatch, lang: str) -> Iterator[pa.RecordBatch]:
    """Insert the rows of one language in order and add each node's corrections with its ancestors."""
    paths = rows.column("path")
    items = paths.flatten()
    names = items.field("source").dictionary_encode()
    source = names.indices.to_numpy().astype(np.int64)
    share_, zero = items.field("p").to_numpy(), items.field("zero").to_numpy()
    sizes = np.diff(paths.offsets.to_numpy())
    starts = np.cumsum(sizes) - sizes
    times = rows.column("times").to_numpy()
    # Length of the path that a row shares with the row before: rows are sorted, so equal beginnings are neighbours.
    depth = int(sizes.max(initial=0))
    shared = np.zeros(len(sizes), np.int64)
    same = np.arange(1, len(sizes))
    for level in range(depth):
        same = same[np.minimum(sizes[same], sizes[same - 1]) > level]
        a, b = starts[same] + level, starts[same - 1] + level
        same = same[(source[a] == source[b]) & (share_[a] == share_[b])]
        shared[same] += 1
    sums: dict[int, int] = defaultdict(int)
    width = len(names.dictionary)
    for level in range(1, depth):
        # Nodes of this level: rows that reach it; a node begins where a row shares less than its whole path up to here.
        deep = np.flatnonzero(sizes > level)
        # rows between two deep ones may end above this level, so what they share is the least of what lies between
        first = np.concatenate([[True], _least_between(shared, deep) <= level])
        heads = np.flatnonzero(first)
        weight = np.add.reduceat(times[deep], heads)
        node = starts[deep[heads]] + level
        for above in range(level):
            ancestor = node - level + above
            p, q, z, w = share_[ancestor], share_[node], zero[ancestor], zero[node]
            correction = (np.abs(p - q) - np.abs(p - w) - np.abs(q - z) + np.abs(z - w)) * weight
            keys = source[ancestor] * width + source[node]
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            for key, value in zip(keys[begin].tolist(), np.add.reduceat(correction[order], begin).tolist()):
                sums[key] += value
    found = [(k, v) for k, v in sums.items() if v]
    text = names.dictionary.to_pylist()
    for start in range(0, len(found), 50_000):
        part = found[start : start + 50_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(part), pa.string()), pa.array([text[k // width] for k, _ in part], pa.string()),
                pa.array([text[k % width] for k, _ in part], pa.string()), pa.array([v for _, v in part], pa.int64()),
            ],
            ["lang", "source", "other", "value"],
        )


def _least_between(shared: np.ndarray, deep: np.ndarray) -> np.ndarray:
    """Least entry of ``shared`` after each row of ``deep`` up to and with the next one."""
    bounds = np.stack([deep[:-1] + 1, deep[1:] + 1], axis=1).ravel()
    padded = np.append(shared, np.iinfo(np.int64).max)
    return np.minimum.reduceat(padded, bounds)[::2]
