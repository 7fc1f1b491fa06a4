"""Benchmark decontamination with a generalised suffix automaton.

Items are normalised (ASCII case folded; words are runs of ASCII letters,
digits and non-ASCII characters) and all their words go into one suffix
automaton, built once on the driver from the item table and sent to the tasks.
Every document streams through it whole. The automaton tracks the longest match
that ends at each word. A match of ``window`` words or more, or a whole shorter
item, marks its words as hit.

Items are dealt into blocks of at most ``MAX_ITEM_WORDS`` words, which bounds each
automaton (at most two states a word). An item longer than that is cut into
pieces that share a window less one word, so every window lies whole in one of
them. With more than one block, every document streams through each block in a
pass of its own; the ranges and items met are united per document before
anything is counted or cut.

Defined results: null, empty and wordless texts have no words and no hits; an
empty item table hits nothing; equal items (repeated rows) are all listed, ids
once; words of an item without an id count as hit, but it is not listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts, shielded, slices, stored

MAX_ITEM_WORDS = 200_000

# Words are split at ASCII characters other than letters and digits; A-Z are folded.
FOLDED = bytes(
    b if b >= 128 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(FOLDED).split()


class ItemAutomaton:
    """Suffix automaton over the words of all items, with the items behind each state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = 13):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.at: list[set[int]] = [set()]
        sequences = [[self.ids.setdefault(w, len(self.ids)) for w in words] for _, words in items]
        for number, sequence in enumerate(sequences):
            state = 0
            for word in sequence:
                state = self._extend(state, word)
                self.at[state].add(number)
        # Items reach the states of their suffixes; longer states come first.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.at[self.link[state]] |= self.at[state]
        # Items shorter than the window count as a whole: (length, items) at their state.
        self.whole: dict[int, dict[int, set[int]]] = {}
        for number, sequence in enumerate(sequences):
            if 0 < len(sequence) < window:
                state = 0
                for word in sequence:
                    state = self.next[state][word]
                self.whole.setdefault(state, {}).setdefault(len(sequence), set()).add(number)
        self.least = min([window, *(len(s) for s in sequences if s)])
        self.wholes = [False] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.wholes[state] = state in self.whole or self.wholes[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        step = self.next[last].get(word)
        if step is not None:
            return step if self.length[step] == self.length[last] + 1 else self._split(last, word, step)
        state = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            step = self.next[at][word]
            self.link[state] = step if self.length[step] == self.length[at] + 1 else self._split(at, word, step)
        return state

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(-1)
        self.at.append(set())
        return len(self.link) - 1

    def _split(self, at: int, word: int, step: int) -> int:
        half = self._state(self.length[at] + 1, dict(self.next[step]))
        self.link[half], self.link[step] = self.link[step], half
        while at >= 0 and self.next[at].get(word) == step:
            self.next[at][word] = half
            at = self.link[at]
        return half

    def lengths(self, codes: list[int]) -> Iterator[tuple[int, int]]:
        """(state, longest match) after each word; all codes are known words."""
        following, link, length = self.next, self.link, self.length
        state = matched = 0
        for code in codes:
            step = following[state].get(code)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = following[state].get(code)
            if step is not None:
                state, matched = step, matched + 1
            yield state, matched

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit word ranges (start, end), merged and in order, and the numbers of the items met."""
        codes = np.fromiter((self.ids.get(w, -1) for w in words), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([0], (codes >= 0).astype(np.int8), [0]))))
        spans: list[tuple[int, int]] = []
        met: set[int] = set()
        # A word that no item has resets the automaton, so runs of known words are scanned apart.
        for first, stop in known.reshape(-1, 2):
            if stop - first < self.least:
                continue
            for end, (state, matched) in enumerate(self.lengths(codes[first:stop].tolist()), int(first) + 1):
                reach = 0
                if matched >= self.window:
                    reach, at = matched, state
                    while self.length[self.link[at]] >= self.window:
                        at = self.link[at]
                    met |= self.at[at]
                if self.wholes[state]:
                    at = state
                    while at > 0 and self.wholes[at]:
                        for size, numbers in self.whole.get(at, {}).items():
                            if size <= matched:
                                reach = max(reach, size)
                                met |= numbers
                        at = self.link[at]
                if reach:
                    start = end - reach
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, end))
        return spans, met


def item_blocks(items: DataFrame, window: int = 13) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """``items`` (item_id, text) as lists of (id, words) with ``MAX_ITEM_WORDS`` words at most, one held at a time."""
    most = max(MAX_ITEM_WORDS, window)
    block, held = [], 0
    for row in items.select(F.col("item_id").cast("string").alias("item_id"), "text").toLocalIterator():
        words = normal_words((row["text"] or "").encode())
        for start in range(0, max(len(words) - window + 1, 1), most - window + 1):
            piece = words[start : start + most]
            if block and held + len(piece) > most:
                yield block
                block, held = [], 0
            if piece:
                block.append((row["item_id"], piece))
                held += len(piece)
    if block:
        yield block


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, with those that meet or overlap as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            start, end = out[-1][0], max(end, out.pop()[1])
        out.append((start, end))
    return out


def _united_hits(docs: DataFrame, blocks: Iterable[list[tuple[str | None, list[bytes]]]], window: int) -> DataFrame:
    """(tm_id, tm_hash, tm_spans, tm_names) of the documents hit, from a pass for each block.

    Rows are known by id and text hash; rows that agree in both have the same hits.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tm_hash"))
    schema = f"tm_id {docs.schema['doc_id'].dataType.simpleString()}, tm_hash bigint, tm_spans array<bigint>, tm_names array<string>"

    def scan(automaton: ItemAutomaton):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                hit, spans, names = [], [], []
                for text in raw_texts(batch):
                    found, met = automaton.scan(normal_words(text))
                    hit.append(bool(found))
                    if found:
                        spans.append([place for span in found for place in span])
                        names.append(sorted({n for m in met if (n := automaton.names[m]) is not None}))
                kept = batch.select(["doc_id", "tm_hash"]).filter(pa.array(hit, pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(spans, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string()))],
                    ["tm_id", "tm_hash", "tm_spans", "tm_names"],
                )

        return run

    parts = None
    for block in blocks:
        found = stored(keyed.mapInArrow(scan(ItemAutomaton(block, window)), schema).dropDuplicates(["tm_id", "tm_hash"]))
        parts = found if parts is None else parts.union(found)
    return stored(parts.groupBy("tm_id", "tm_hash").agg(
        F.flatten(F.collect_list("tm_spans")).alias("tm_spans"), F.array_distinct(F.flatten(F.collect_list("tm_names"))).alias("tm_names")
    ))


def _with_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """``rows`` (doc_id, tm_key and any others) with tm_spans and tm_names, null where nothing is hit."""
    return rows.join(hits, F.col("doc_id").eqNullSafe(F.col("tm_id")) & (F.col("tm_key") == F.col("tm_hash")), "left").drop("tm_id", "tm_hash", "tm_key")


def _spans_of(flat: list[int] | None) -> list[tuple[int, int]]:
    return merged(zip(flat[::2], flat[1::2])) if flat else []


def _dealt(items: DataFrame, window: int):
    """The automaton when one block holds all items, else None; and the blocks."""
    blocks = item_blocks(items, window)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return ItemAutomaton(first, window), None
    return None, chain([first, second], blocks)


def over_limit(hit: int, total: int, percent: int) -> bool:
    return hit > 0 and 100 * hit >= percent * total


FOUND = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _judged(ids: pa.Array, found: Iterable[tuple[int, list[tuple[int, int]], Iterable[str]]], percent: int) -> pa.RecordBatch:
    """Result rows from (words, ranges, distinct names) of each document."""
    rows = []
    for total, spans, names in found:
        hit, names = sum(b - a for a, b in spans), sorted(names)
        rows.append((total, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), over_limit(hit, total, percent)))
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays(
        [ids] + [pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.string(), pa.bool_()))],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    )


def find_contamination(docs: DataFrame, items: DataFrame, window: int = 13, percent: int = 5) -> DataFrame:
    """Words, hit words and items met of each document (doc_id, text)."""
    automaton, blocks = _dealt(items, window)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = []
            for text in raw_texts(batch):
                words = normal_words(text)
                spans, met = automaton.scan(words)
                found.append((len(words), spans, {n for m in met if (n := automaton.names[m]) is not None}))
            yield _judged(batch.column("doc_id"), found, percent)

    if blocks is None:
        return docs.select("doc_id", "text").mapInArrow(run, FOUND)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes = pa.array([len(normal_words(text)) for text in raw_texts(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tm_key"), sizes], ["doc_id", "tm_key", "n_words"])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(*(batch.column(c).to_pylist() for c in ("n_words", "tm_spans", "tm_names")))
            yield _judged(batch.column("doc_id"), [(n, _spans_of(flat), names or ()) for n, flat, names in found], percent)

    hits = _united_hits(docs, blocks, window)
    sizes = docs.select("doc_id", "text", F.xxhash64("text").alias("tm_key")).mapInArrow(count, "doc_id bigint, tm_key bigint, n_words bigint")
    return _with_hits(sizes, hits).mapInArrow(judge, FOUND)


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given word ranges; what separated the words around a range stays."""
    folded, place, start, ends = text.translate(FOLDED), 0, [], []
    for word in folded.split():
        place = folded.index(word, place)
        start.append(place)
        place += len(word)
        ends.append(place)
    kept, last = [], 0
    for first, stop in spans:
        kept.append(text[last : start[first]])
        last = ends[stop - 1]
    return b"".join(kept) + text[last:]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 13, percent: int = 5) -> DataFrame:
    """``docs`` without benchmark passages, all columns kept.

    Spans of ``window`` words or more (or whole shorter items) are cut out of the
    text. Documents of which they make up ``percent`` or more go. ``n_chars`` is
    the new length where that column exists. Columns may have any names, the
    operator's own included.
    """
    automaton, blocks = _dealt(items, window)
    docs, restored = shielded(docs)
    schema, names = docs.schema, docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            kept, changed = [], {}
            united = batch.column("tm_spans").to_pylist() if automaton is None else None
            for row, text in enumerate(raw_texts(batch)):
                if united is not None and not united[row]:
                    kept.append(True)
                    continue
                words = normal_words(text)
                spans = automaton.scan(words)[0] if united is None else _spans_of(united[row])
                over = over_limit(sum(b - a for a, b in spans), len(words), percent)
                kept.append(not over)
                if spans and not over:
                    changed[row] = cut_words(text, spans)
            yield replaced(batch.select(names), changed).filter(pa.array(kept, pa.bool_()))

    if blocks is None:
        return restored(docs.mapInArrow(run, schema))
    docs = stored(docs)  # read once for each block
    marked = _with_hits(docs.withColumn("tm_key", F.xxhash64("text")), _united_hits(docs, blocks, window))
    return restored(marked.mapInArrow(run, schema))


def replaced(batch: pa.RecordBatch, texts: dict[int, bytes]) -> pa.RecordBatch:
    """The batch with new texts in some rows, and their lengths in ``n_chars`` if it has that column."""
    if not texts:
        return batch
    at = batch.schema.get_field_index("text")
    values = batch.column(at).to_pylist()
    for row, text in texts.items():
        values[row] = text.decode()
    new = pa.array(values, batch.schema.field(at).type)
    columns = [new if i == at else c for i, c in enumerate(batch.columns)]
    size = batch.schema.get_field_index("n_chars")
    if size >= 0:
        lengths = columns[size].to_pylist()
        counted = pc.utf8_length(new).to_pylist()
        columns[size] = pa.array([counted[i] if i in texts else n for i, n in enumerate(lengths)], batch.schema.field(size).type)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)
