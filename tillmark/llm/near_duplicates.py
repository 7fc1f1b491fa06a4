"""Connected classes of an exact n-gram Jaccard threshold, with rare-first prefixes.

A document's set holds its distinct word shingles (ASCII case folded; words are
runs of anything but space and \\t..\\r). Documents link when the Jaccard
similarity of their sets reaches a percentage.

How it works

1. One pass hashes each set. Equal sets form a class; from here on a class
   stands for all of its copies. The same pass counts shingles into a table of
   fixed size, which only serves to find hot ones.
2. A second pass deals the shingles of each class, packed, into buckets whose
   number grows with the corpus. A bucket counts in how many classes each of its
   shingles occurs; a shingle of a hot cell takes the count of the cell instead, so
   that no bucket gets more than its share and that of an unsettled cell. Shingles of
   one class can meet nothing and end there.
   The others return to their classes, which order them rare-first: by count, then by
   hash, after those that occur once. The first ``n - ceil(t n) + 1`` shingles are the prefix,
   and the shared ones in it become rows. Very frequent ones are salted.
3. Shingles met by two classes form the posting lists. In a list of two rows the
   filters of step 4 apply at once. Classes are first tried
   against one hub of each list, in rounds with different hubs, which joins large
   groups with a linear number of pairs. All remaining pairs of different
   components that share a prefix shingle are then tried, without a cap.
4. A pair is tried after length and positional filters and a bound from the
   number of shared prefix shingles, counted or, for the remaining pairs, bounded from the
   first shared one on. Verification applies a suffix filter and
   then counts the intersection, once per pair.
5. Links are closed by alternating stars (``components``).

Pairs whose classes are already connected are not tried. So the operator returns
classes only: ``spanning_links`` connects each of them, but is not the list of
all similar pairs, and says nothing about the number of links of a document.

Shingles and sets are identified by 64-bit hashes.

Defined results: null, empty and blank texts have no shingles and link with
nothing; fewer words than the shingle size give the whole sequence as one
shingle; repeated rows are kept and fall into one class; an empty table gives
an empty result; null ids stay rows and never represent a group that has an id.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import collect_counts, count_rows, gram_hashes, raw_texts, shielded, slices, stored, with_ids, word_hashes
from .components import components

FREQUENCY_CELLS = 1 << 16
# Shingles in more classes than this many times the mean of the cells are salted into parts of that size.
SALT_ABOVE = 8
# Rounds with hubs before all remaining pairs are tried, while a round adds one link to every so many found before.
HUB_ROUNDS = 4
HUB_GAIN = 4
# Times the rows of lists of two are tried against the counts of their classes.
MATE_ROUNDS = 2
# 64-bit words of the signature that bounds what two classes share in the last join.
SIGNATURE_WORDS = 8


def shingles(text: bytes, words_each: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word windows of a text."""
    words = text.lower().split()
    if len(words) < words_each:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)] if words else [], np.uint64)
    return np.unique(gram_hashes(word_hashes(words), words_each))


def prefix_size(n, percent: int):
    """Shingles of the prefix, of one size or an array of sizes."""
    return n - (percent * n + 99) // 100 + 1


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64) & (FREQUENCY_CELLS - 1)


def _set_key(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).view(np.int64))


SETS = "doc_id bigint, n_shingles bigint, class bigint, cell bigint, hits bigint"


def _scan_sets(words_each: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(FREQUENCY_CELLS, np.int64)
        for batch in slices(batches, "text"):
            sizes, keys = [], []
            for text in raw_texts(batch):
                found = shingles(text, words_each)
                sizes.append(len(found))
                keys.append(_set_key(found) if len(found) else None)
                table += np.bincount(_cell(found), minlength=FREQUENCY_CELLS)
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), none, none],
                ["doc_id", "n_shingles", "class", "cell", "hits"],
            )
        for cells, hits in count_rows(table):
            none = pa.nulls(len(cells), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.array(cells, pa.int64()), pa.array(hits, pa.int64())],
                ["doc_id", "n_shingles", "class", "cell", "hits"],
            )

    return run


# Packed rows: 64-bit shingles of many sets with the class of each, in one bucket of shingles or of classes. The sizes of
# the sets travel once per class, as rows of their own (sized, n), and not with every shingle.
PACKED = "part bigint, token binary, class binary, sized binary, n binary"
SHARED = "home bigint, token binary, class binary, hits binary, sized binary, n binary"
PREFIXES = "token bigint, class bigint, n int, place int, salt int"
# Shingles (occurrences) a bucket is laid out for, which bounds the memory of its task, and classes a task remembers to have sent.
BUCKET_ROWS = 1 << 19
REMEMBERED_CLASSES = 1 << 16
# Cells fuller than this (or than SALT_ABOVE times the mean) are hot: their count stands for that of their shingles.
HOT_LEAST = 1000.0


def _hot_limit(table: np.ndarray) -> float:
    return max(HOT_LEAST, SALT_ABOVE * float(table.mean()))


def _dealt(part: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """The columns cut by ``part``."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for start, stop in zip(starts, np.r_[starts[1:], len(part)]):
        rows = order[start:stop]
        yield int(part[start]), [c[rows].tobytes() for c in columns]


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _packed(rows: list[tuple[int, list[bytes]]], schema: str) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    columns = [pa.array([part for part, _ in rows], pa.int64())]
    columns += [pa.array([found[k] for _, found in rows], pa.binary()) for k in range(len(names) - 1)]
    return pa.RecordBatch.from_arrays(columns, names)


def _scan_buckets(words_each: int, table: np.ndarray, buckets: int):
    """Shingles of each class by bucket; those of hot cells and the sizes by class, since their count is known."""
    hot = table > _hot_limit(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # only spares work: a class sent twice is reduced in its buckets
        for batch in slices(batches, "text"):
            tokens, keys, sizes = [], [], []
            for text in raw_texts(batch):
                found = shingles(text, words_each)
                key = _set_key(found) if len(found) else None
                if key is None or key in seen:
                    continue
                if len(seen) >= REMEMBERED_CLASSES:
                    seen.clear()
                seen.add(key)
                tokens.append(found)
                keys.append(key)
                sizes.append(len(found))
            if tokens:
                token, size, key = np.concatenate(tokens), np.array(sizes, np.int32), np.array(keys, np.int64)
                of = np.repeat(key, size)
                part = (token % np.uint64(buckets)).astype(np.int64)
                known = hot[_cell(token)]
                part[known] = buckets + of[known] % buckets
                rows = [(at, [*found, b"", b""]) for at, found in _dealt(part, [token, of])]
                rows += [(at, [b"", b"", *found]) for at, found in _dealt(buckets + key % buckets, [key, size])]
                yield _packed(rows, PACKED)

    return run


def _count_bucket(table: np.ndarray, buckets: int):
    """Keeps shingles that two classes hold, with the number of classes, and deals them by class."""

    def run(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        token, of = (_joined(rows, c, t) for c, t in (("token", np.uint64), ("class", np.int64)))
        order = np.lexsort((of, token))
        token, of = token[order], of[order]
        first = np.ones(len(token), bool)
        first[1:] = (token[1:] != token[:-1]) | (of[1:] != of[:-1])
        token, of = token[first], of[first]
        if part >= buckets:
            hits = table[_cell(token)]
        else:
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            runs = np.diff(np.r_[starts, len(token)])
            hits = np.repeat(runs, runs).astype(np.int64)
            met = hits > 1
            token, of, hits = token[met], of[met], hits[met]
        out = [(at, [*found, b"", b""]) for at, found in _dealt(of % buckets, [token, of, hits])] if len(token) else []
        if part >= buckets:
            sized, first = np.unique(_joined(rows, "sized", np.int64), return_index=True)
            n = _joined(rows, "n", np.int32)[first]
            out += [(at, [b"", b"", b"", *found]) for at, found in _dealt(sized % buckets, [sized, n])] if len(sized) else []
        return pa.Table.from_batches([_packed(out, SHARED)])

    return run


def _cut_prefixes(percent: int, limit: float):
    """Shared shingles within the prefixes of the classes; those that occur once come before them and need no row."""

    def run(rows: pa.Table) -> pa.Table:
        kinds = (("token", np.uint64), ("class", np.int64), ("hits", np.int64), ("sized", np.int64), ("n", np.int32))
        token, of, hits, sized, sizes = (_joined(rows, c, t) for c, t in kinds)
        order = np.lexsort((token, hits, of))
        token, of, hits = token[order], of[order], hits[order]
        order = np.argsort(sized)
        n = sizes[order[np.searchsorted(sized, of, sorter=order)]] if len(of) else sizes[:0]
        starts = np.flatnonzero(np.diff(of, prepend=of[:1] - 1))
        held = np.diff(np.r_[starts, len(of)])
        alone = n[starts] - held
        place = np.arange(len(of)) - np.repeat(starts - alone, held) + 1
        kept = place <= prefix_size(n.astype(np.int64), percent)
        token, of, n, hits, place = token[kept], of[kept], n[kept], hits[kept], place[kept]
        split = np.ceil(hits / limit).astype(np.int64).clip(1)
        salt = np.where(split > 1, 1 + of.view(np.uint64) % split.astype(np.uint64), 0)
        return pa.table({
            "token": token.view(np.int64), "class": of, "n": n, "place": place.astype(np.int32), "salt": salt.astype(np.int32),
        })

    return run


def shared_prefixes(docs: DataFrame, words_each: int, percent: int, table: np.ndarray) -> DataFrame:
    """(token, class, n, place, salt): the prefix shingles that can meet another class, in order of exact frequency."""
    buckets = max(8, int(table.sum()) // BUCKET_ROWS + 1)
    packed = docs.mapInArrow(_scan_buckets(words_each, table, buckets), PACKED)
    shared = packed.groupBy("part").applyInArrow(_count_bucket(table, buckets), SHARED)
    return shared.groupBy("home").applyInArrow(_cut_prefixes(percent, _hot_limit(table)), PREFIXES)


def _scan_members(words_each: int):
    """Texts of the wanted classes; a row that shares the id of a member but not its set is passed over."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = (shingles(text, words_each) for text in raw_texts(batch))
            same = [len(found) > 0 and _set_key(found) == key for found, key in zip(sets, batch.column("class").to_pylist())]
            yield batch.select(["class", "text"]).filter(pa.array(same, pa.bool_()))

    return run


def distance_floor(x: np.ndarray, y: np.ndarray, depth: int = 2) -> int:
    """Suffix filter: a lower bound of the symmetric difference of two sorted sets."""
    if not len(x) or not len(y) or not depth:
        return abs(len(x) - len(y))
    pivot = y[len(y) // 2]
    i, j = np.searchsorted(x, pivot), len(y) // 2
    own = int(i < len(x) and x[i] == pivot)
    return (
        distance_floor(x[:i], y[:j], depth - 1) + distance_floor(x[i + own :], y[j + 1 :], depth - 1) + (1 - own)
    )


def _verify(words_each: int, percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            kept = []
            # Texts travel, since they compress and hashes do not; a hub's set is made once per slice.
            sets: dict[bytes, np.ndarray] = {}
            for x, y in zip(raw_texts(batch, "text_a"), raw_texts(batch, "text_b")):
                x = sets[x] if x in sets else sets.setdefault(x, shingles(x, words_each))
                y = shingles(y, words_each)
                total = len(x) + len(y)
                # 100 i >= p (total - i), and i = (total - distance) / 2
                if (100 + percent) * (total - distance_floor(x, y)) < 2 * percent * total:
                    kept.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * both >= percent * (total - both))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(kept, pa.bool_())) for c in (batch.column("a"), batch.column("b"))], ["a", "b"]
            )

    return run


def sided(condition: str, **names: str) -> str:
    """A filter on n_a, n_b, i, j, m_a, m_b with other expressions in their places."""
    return re.sub(r"\b(n_a|n_b|i|j|m_a|m_b)\b", lambda found: names[found[0]], condition)


class JaccardJoin:
    """The join over one table of documents, up to the links that connect its components.

    ``classes`` and ``documents()`` are whole; ``spanning_links`` are similar pairs
    of classes that connect every component, without most pairs inside it.
    """

    def __init__(self, docs: DataFrame, words_each: int = 5, percent: int = 75):
        self.percent = percent
        self.words_each = words_each
        self.docs = docs.select("doc_id", "text")
        scanned = stored(self.docs.mapInArrow(_scan_sets(words_each), SETS))
        self.rows = scanned.where("cell is null").select("doc_id", "n_shingles", "class")
        self.classes = self.rows.where("class is not null").groupBy("class").agg(
            F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n")
        )
        table = collect_counts(scanned.select("cell", "hits"), "cell", "hits", FREQUENCY_CELLS)
        prefixes = shared_prefixes(self.docs, words_each, percent, table)
        lists = Window.partitionBy("token", "salt")
        # In a list of two rows the other one is known: its length and place are the sums less the own.
        prefixes = prefixes.withColumns({
            "hub": F.min("class").over(lists), "top": F.max("class").over(lists), "rows": F.count("*").over(lists),
            "n_all": F.sum("n").over(lists), "places": F.sum("place").over(lists),
        }).withColumn("mate_n", F.when(F.col("rows") == 2, F.col("n_all") - F.col("n")))
        near = sided(self._near(), n_a="n", n_b="mate_n", i="place", j="(places - place)")
        met = (
            prefixes.where(f"salt > 0 or hub <> top and (mate_n is null or {near})")
            .drop("top", "rows", "n_all", "places").dropDuplicates(["token", "salt", "class"])
        )
        # Shared prefix shingles of each class: no pair of it can share more. Rows in lists of two
        # that leave no room even so are dropped, which lowers the counts again.
        room = sided(self._room("m"), n_a="n", n_b="mate_n")
        held = F.count("*").over(Window.partitionBy("class"))
        for _ in range(MATE_ROUNDS):
            met = met.withColumn("m", held).where(f"salt > 0 or mate_n is null or {room}")
        self.postings = stored(met.drop("mate_n").withColumn("m", held))
        self.sizes = stored(self.postings.groupBy("class").agg(F.first("n").alias("n"), F.first("m").alias("m")))
        self.spanning_links = self._spanning_links()

    def _spanning_links(self) -> DataFrame:
        self.roots = links = tried = None
        step = 0
        while True:
            last = step > HUB_ROUNDS
            pairs = self._open_pairs() if last else self._hub_pairs(step)
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = stored(pairs)
            tried = pairs if tried is None else tried.union(pairs)
            found = self._verified(pairs)
            none = found is None or found.isEmpty()
            if not none:
                # Roots stand for the links found before: a star has the same components.
                edges = found if self.roots is None else found.union(self.roots.select("node", "root"))
                self.roots = stored(components(edges))
                links = found if links is None else links.union(found)
            if last:
                return links
            spent = none or HUB_GAIN * found.count() < links.count()
            step = HUB_ROUNDS + 1 if spent and step else step + 1

    def _open_postings(self) -> DataFrame:
        """Postings of tokens that still meet in two or more components; others never open again."""
        postings = self.postings.select("token", "class", "n", "place", "m")
        if self.roots is None:
            labelled = postings.withColumn("component", F.col("class"))
        else:
            roots = self.roots.withColumnRenamed("node", "class")
            labelled = postings.join(roots, "class", "left").withColumn("component", F.coalesce("root", "class")).drop("root")
        mixed = labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        rows = stored(labelled.join(mixed.where("low <> high").select("token"), "token", "left_semi"))
        self.postings = rows.drop("component")
        return rows

    def _hub_pairs(self, step: int) -> DataFrame:
        """Each class with one hub of each list: first the least class, later one drawn from the list."""
        if not step:
            hubs = self.postings.where("salt > 0").groupBy("token").agg(F.min("hub").alias("chief"))
            within = self.postings.select(F.col("hub").alias("x"), F.col("class").alias("y"))
            across = self.postings.where("salt > 0").select("token", "hub").distinct().join(hubs, "token").select(
                F.col("chief").alias("x"), F.col("hub").alias("y")
            )
            pairs = within.union(across).where("x <> y")
        else:
            rows = self._open_postings()
            # A row drawn by hash lies in a component as often as the component has rows in the list.
            pick = F.struct(F.xxhash64("class", "token", F.lit(step)), F.col("component").alias("home"), F.col("class").alias("x"), "n", "place", "m")
            hubs = rows.groupBy("token").agg(F.min(pick).alias("pick")).select("token", "pick.home", "pick.x", "pick.n", "pick.place", "pick.m")
            fits = sided(
                f"{self._near()} and {self._room('least(m_a, m_b)')}",
                n_a="a.n", n_b="b.n", i="a.place", j="b.place", m_a="a.m", m_b="b.m",
            )
            pairs = rows.alias("a").join(
                hubs.alias("b"), F.expr(f"a.token = b.token and a.component <> b.home and {fits}")
            ).select("b.x", F.col("a.class").alias("y"))
        pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        for side in "ab":
            pairs = pairs.join(self.sizes.select(*(F.col(c).alias(f"{c}_{side}") for c in ("class", "n", "m"))).withColumnRenamed(f"class_{side}", side), side)
        pairs = stored(pairs.where(self._room("least(m_a, m_b)")).select("a", "b"))
        return self._promising(
            pairs.join(self._side("a", "i", self.postings), "a").join(self._side("b", "j", self.postings), ["b", "token"])
        )

    @staticmethod
    def _side(side: str, place: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            "token", F.col("class").alias(side), F.col("place").alias(place), *(F.col(c).alias(f"{c}_{side}") for c in ("n", "m"))
        )

    def _open_pairs(self) -> DataFrame:
        """All remaining pairs (a, b) of different components that have room."""
        return self._open_matches().distinct()

    def _open_matches(self) -> DataFrame:
        rows = self._open_postings()
        # All classes order shingles alike, so behind the first shingle that a pair shares lie all others it shares.
        # Each row knows what its class holds from there on: the number, and one bit per token, which lets the join
        # itself bound what a pair can share from this shingle on. A shared token has its bit on both sides, and
        # ``slack`` makes up for tokens of a class that fall on one bit. So the row of the first shared shingle passes
        # for every pair with room, and the rows of later ones mostly do not.
        words = [f"word{k}" for k in range(SIGNATURE_WORDS)]
        behind = Window.partitionBy("class").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns({"m": F.count("*").over(behind)} | {
            word: F.expr(
                f"bit_or(if((shiftright(token, 6) & {SIGNATURE_WORDS - 1}) = {k}, shiftleft(1L, cast(token & 63 as int)), 0L))"
            ).over(behind) for k, word in enumerate(words)
        })
        rows = stored(rows.withColumn("slack", F.col("m") - F.expr(" + ".join(f"bit_count({w})" for w in words))))
        # Both sides are the same rows under the same names, so that they are dealt out once.
        shared = " + ".join(f"bit_count(a.{w} & b.{w})" for w in words) + " + least(a.slack, b.slack)"
        names = {"n_a": "a.n", "n_b": "b.n", "i": "a.place", "j": "b.place", "m_a": "a.m", "m_b": "b.m"}

        met = rows.alias("a").join(rows.alias("b"), F.expr(
            "a.token = b.token and a.class < b.class and a.component <> b.component and "
            + sided(
                f"{self._near()} and {self._room('least(m_a, m_b)')} and {self._room(f'least(m_a, m_b, {shared})')}", **names
            )
        ))
        return met.selectExpr("a.class as a", "b.class as b")

    def _near(self) -> str:
        """Length filter, and the positional filter for a shingle at places i and j."""
        p = self.percent
        return (
            f"100 * cast(least(n_a, n_b) as bigint) >= {p} * cast(greatest(n_a, n_b) as bigint) and "
            f"{100 + p} * (least(i, j) + cast(least(n_a - i, n_b - j) as bigint)) >= {p} * (cast(n_a as bigint) + n_b)"
        )

    def _room(self, shared: str) -> str:
        """Length filter, and whether so many shared prefix shingles leave room for the needed intersection.

        Shared shingles beyond the prefixes lie beyond the end of the shorter-ending
        prefix of one side, so at most ``ceil(t n) - 1`` of them exist.
        """
        p = self.percent
        beyond = f"cast(floor(({p} * cast(greatest(n_a, n_b) as bigint) + 99) / 100) as bigint) - 1"
        return (
            f"100 * cast(least(n_a, n_b) as bigint) >= {p} * cast(greatest(n_a, n_b) as bigint) and "
            f"{100 + p} * ({shared} + {beyond}) >= {p} * (cast(n_a as bigint) + n_b)"
        )

    def _promising(self, met: DataFrame) -> DataFrame:
        """Pairs (a, b) that share enough prefix shingles."""
        counted = met.where(self._near()).groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared"))
        return counted.where(self._room("shared")).select("a", "b")

    def _verified(self, pairs: DataFrame) -> DataFrame | None:
        """Pairs (a, b) that reach the similarity; None when there is nothing to try."""
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        ids = stored(wanted.join(self.classes, "class").select(F.col("first_id").alias("doc_id"), "class"))
        if ids.isEmpty():
            return None
        texts = stored(with_ids(self.docs, ids, "inner").select("class", "text").mapInArrow(
            _scan_members(self.words_each), "class bigint, text string"
        ))
        if texts.count() > ids.count():  # repeated rows
            texts = stored(texts.dropDuplicates(["class"]))
        met = (
            pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
        )
        return stored(met.mapInArrow(_verify(self.words_each, self.percent), "a bigint, b bigint"))

    def documents(self) -> DataFrame:
        """(doc_id, n_shingles, component_id) for every row of the input."""
        classes = self.classes
        if self.roots is not None:
            roots = self.roots.withColumnRenamed("node", "class")
            homes = classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")).select("class", "first_id", "root")
            lowest = homes.groupBy("root").agg(F.min("first_id").alias("component_id"))
            homes = homes.join(lowest, "root").select("class", "component_id")
        else:
            homes = classes.select("class", F.col("first_id").alias("component_id"))
        joined = self.rows.join(homes, "class", "left")
        return joined.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, words_each: int = 5, percent: int = 75) -> DataFrame:
    """Each document (doc_id, text) with its set size and the smallest id its links reach."""
    return JaccardJoin(docs, words_each, percent).documents()


def keep_one(docs: DataFrame, words_each: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one document of each linked group: that with the smallest id.

    All columns stay. Rows are told apart by id and text: rows without an id take
    part and stay where no row with an id links to them; rows that share an id but
    have unlinked texts all stay; rows equal in id and text are reduced to one
    (those without an id only if their text has a word).
    """
    docs, restored = shielded(docs)
    keyed = docs.withColumn("tm_key", F.xxhash64("doc_id", "text"))
    linked = stored(near_duplicates(keyed.select(F.col("tm_key").alias("doc_id"), "text"), words_each, percent))
    ids = keyed.select("tm_key", "doc_id").distinct()
    homes = linked.select(F.col("doc_id").alias("tm_key"), "n_shingles", F.col("component_id").alias("tm_home")).distinct()
    members = stored(homes.join(ids, "tm_key"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tm_key"))
    first = members.groupBy("tm_home").agg(F.min_by("tm_key", order).alias("tm_first"))
    gone = members.join(first, "tm_home").where("tm_key <> tm_first").select("tm_key").distinct()
    kept = with_ids(keyed, stored(gone), "left_anti", "tm_key")
    repeated = stored(
        linked.where("component_id is not null").groupBy(F.col("doc_id").alias("tm_key")).count().where("count > 1")
        .join(members.where("doc_id is not null or n_shingles > 0"), "tm_key").join(gone, "tm_key", "left_anti").select("tm_key").distinct()
    )
    if not repeated.isEmpty():
        once = with_ids(kept, repeated, "inner", "tm_key").dropDuplicates(["tm_key"])
        kept = with_ids(kept, repeated, "left_anti", "tm_key").unionByName(once)
    return restored(kept.drop("tm_key"))
