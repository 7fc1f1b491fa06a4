"""Log-bilinear language model trained with noise-contrastive estimation.

Tokens are words (ASCII case folded; runs of anything but space and \\t..\\r) and
one end per text. All training tokens are counted. Every frequent word has its
own vectors, and so have the end token and one symbol for all other words;
context is the two tokens before (the end token before the start).

The score of symbol w after h1 h2 is q_w . (r_h1 C1 + r_h2 C2) + b_w. Symbols fall
into about sqrt(n) groups by frequency, which have vectors of their own. Both are
trained with noise-contrastive estimation, words and groups against noise drawn
from their unigrams. Equal contexts of a slice of texts learn and are scored
together: noise and normalisers are computed once for each. P(w) = P(group) P(w in group), each a softmax over all its
members, by batched matrix products. Within the other words a word w has
probability (c+1)/(N'+V'+1), with its count c and the N' tokens of V' words
outside the list, which leaves one share for unseen words.

Training goes in rounds over disjoint shares of the texts, by the hash of the id,
each share as large as all before it. In a round tasks train on all of their tokens
from common vectors and pass on what they changed; changes are averaged per row by
use. An average of many tasks moves less far than one task would, so it is also tried
times some powers of the number of tasks, and not at all; what gives a bounded
sample of training texts the highest probability is taken. So no number of tasks
makes the vectors overshoot, and the driver holds the vectors and that sample only,
whatever the corpus. A task gets ``TASK_TOKENS`` or more, so small partitions train
together. The model still depends a little on how texts are dealt to tasks.

Words counted at least as often as some power of two, ``FREQUENT`` at most, go
to every task; the rest meet their counts in a join. So what is broadcast is
bounded, and what is counted and passed on grows with the corpus.

Words are cut out and numbered per slice by Arrow, and only distinct ones meet the
vocabulary, so no Python object is made for a word.

Defined results: null text is empty and has one token, its end; repeated rows
are scored alike; without training documents every count is 0 and the model is
uniform over its symbols; an empty table gives an empty result.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, raw_texts, slices, stored

FREQUENT = 100_000
DIMENSION, NOISE, STEPS, RATE = 24, 16, 150, 0.1
# Contexts of one training step, those of a block that meet the same noise, and how much that is.
BATCH, BLOCK, DRAWN = 4096, 128, 32
# Shares of the texts, in eighths, that one round after the other trains on.
ROUND_PARTS, ROUNDS = 8, (1, 1, 2, 4)
# Tokens that a task trains on at least, so that its vectors settle before they are averaged.
TASK_TOKENS = 1_000_000
# Powers of the number of tasks tried as factors of an average, and training tokens that judge them.
FURTHER, JUDGED = (0.0, 0.25, 0.5, 0.75), 20_000
# Rows of vectors that travel together, and scores normalised together, few enough for a core's cache.
TOGETHER, NORMALISED = 256, 1 << 18
# Scores within this need no shift before they are exponentiated.
UNSHIFTED = 80.0
# Text bytes scored together: the more, the more contexts are equal.
SCORED_BYTES = 1 << 22
# Distinct words of slices that a task holds before it sums and passes them on.
HELD = 1_000_000
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def words_of(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of some texts, numbered, and how many there are up to the end of each text."""
    codes = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    inside = ~SPACE[codes]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    kept = codes[inside]
    offsets = np.append(np.flatnonzero(begins[inside]), len(kept)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    stops = np.cumsum([len(t) + 1 for t in texts]) - 1
    return words.dictionary_encode(), np.searchsorted(np.flatnonzero(begins), stops)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over the whole texts."""

    def summed(held: list[pa.Table]) -> list[pa.RecordBatch]:
        sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
        return pa.table({"word": sums.column("word").cast(pa.string()), "c": sums.column("c_sum")}).to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in slices(batches, "text", SCORED_BYTES):
            words, _ = words_of(raw_texts(batch))
            times = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            held.append(pa.table({"word": words.dictionary, "c": pa.array(times, pa.int64())}))
            if sum(map(len, held)) > HELD:
                yield from summed(held)
                held.clear()
        if held:
            yield from summed(held)

    return texts.select("text").mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def _packed(classes: int, h1: np.ndarray, h2: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, int]:
    """Trigrams as one number each, and the bits of a symbol."""
    bits = max(1, (classes - 1).bit_length())
    return (h1 << 2 * bits) | (h2 << bits) | w, bits


def _summed(places: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Sums of the rows of ``values`` by place."""
    width = values.shape[1]
    sums = np.zeros(count * width, np.float32)
    np.add.at(sums, (places[:, None] * width + np.arange(width)).ravel(), values.ravel())
    return sums.reshape(count, width)


class LogBilinear:
    """Vectors of the symbols and their groups, as rows: r, then q and b, then those of the groups, then C1 and C2."""

    def __init__(self, classes: int, counts: np.ndarray | None = None, seed: int = 7):
        d = DIMENSION
        self.classes = classes
        self._divide(np.zeros(classes) if counts is None else counts)
        self.rows = np.zeros((2 * classes + self.groups + 2 * d, d + 1), np.float32)
        self.rows[:classes, :d] = np.random.default_rng(seed).normal(0, 0.3, (classes, d))
        self.rows[-2 * d : -d, :d], self.rows[-d:, :d] = np.eye(d) * 0.5, np.eye(d)
        self._biases()

    def _divide(self, counts: np.ndarray) -> None:
        """Unigrams, and groups of neighbours with about equal sums of square roots."""
        self.unigram = (counts + 1.0) / (counts.sum() + self.classes)
        root = np.sqrt(self.unigram)
        place = np.floor((np.cumsum(root) - root) / root.sum() * math.ceil(math.sqrt(self.classes)))
        self.group = np.unique(place, return_inverse=True)[1].reshape(-1)
        self.groups = int(self.group[-1]) + 1
        self.starts = np.searchsorted(self.group, np.arange(self.groups + 1))
        self.noise = []
        for base, chance in ((self.classes, self.unigram), (2 * self.classes, np.bincount(self.group, self.unigram))):
            self.noise.append((base, np.cumsum(chance) / chance.sum(), np.log(NOISE * chance).astype(np.float32)))

    def _biases(self) -> None:
        for base, _, log_noise in self.noise:
            self.rows[base : base + len(log_noise), -1] = log_noise - math.log(NOISE)

    def ready(self, seed: int = 11) -> None:
        """Before steps: no slopes seen, no rows used."""
        self.squares = np.full(len(self.rows), 0.1, np.float32)
        self.used = np.zeros(len(self.rows), np.int64)
        self.chance = np.random.default_rng(seed)

    def context(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        d = DIMENSION
        return self.rows.take(h1, 0)[:, :d] @ self.rows[-2 * d : -d, :d] + self.rows.take(h2, 0)[:, :d] @ self.rows[-d:, :d]

    def _move(self, ids: np.ndarray, slopes: np.ndarray) -> None:
        """Move rows by the sums of their slopes."""
        order = np.argsort(ids)
        new = np.diff(ids[order], prepend=-1) > 0
        places = np.empty(len(ids), np.int64)
        places[order] = np.cumsum(new) - 1
        ids = ids[order[new]]
        slopes = _summed(places, slopes, len(ids))
        squares = np.einsum("ij,ij->i", slopes, slopes)
        squares /= slopes.shape[1]
        squares += self.squares.take(ids)
        self.squares[ids] = squares
        slopes *= (RATE / np.sqrt(squares))[:, None]
        slopes += self.rows.take(ids, 0)
        self.rows[ids] = slopes

    def use(self, h1: np.ndarray, h2: np.ndarray, w: np.ndarray) -> None:
        """Count the rows that the steps over these tokens use."""
        for ids in (h1, h2, self.classes + w, 2 * self.classes + self.group[w]):
            self.used += np.bincount(ids, minlength=len(self.used))
        self.used[-2 * DIMENSION :] += len(w)

    def learn(self, h1: np.ndarray, h2: np.ndarray, of: np.ndarray, w: np.ndarray, weight: np.ndarray) -> None:
        """One step up the noise-contrastive objective of words and groups.

        Word w[i] follows the context of[i] with that weight. A context meets noise once, by the weight of its words;
        contexts of a block share the noise. Draws are spread evenly over the unigrams.
        """
        d, size, count = DIMENSION, len(self.rows), len(h1)
        x1, x2 = self.rows.take(h1, 0)[:, :d], self.rows.take(h2, 0)[:, :d]
        c1, c2 = self.rows[-2 * d : -d, :d], self.rows[-d:, :d]
        # Blocks of equal size; what fills up the last one has no share.
        blocks = np.zeros((-(-count // BLOCK), BLOCK, d + 1), np.float32)
        full = blocks.reshape(-1, d + 1)
        full[:count, :d], full[:count, d] = x1 @ c1 + x2 @ c2, 1.0
        mine = full.take(of, 0)
        at, pulled = np.zeros_like(blocks), np.zeros_like(mine)
        share = (-NOISE / DRAWN) * np.bincount(of, weight, len(full)).astype(np.float32).reshape(-1, BLOCK, 1)
        moves = []
        for (base, cumulated, log_noise), target in zip(self.noise, (w, self.group[w])):
            drawn = np.searchsorted(cumulated, (np.arange(DRAWN) + self.chance.random((len(blocks), DRAWN))) / DRAWN)
            drawn = np.minimum(drawn, len(log_noise) - 1)
            real, noise = self.rows.take(base + target, 0), self.rows.take(base + drawn, 0)
            score = np.einsum("ij,ij->i", mine, real) - log_noise.take(target)
            error = (weight / (1.0 + np.exp(np.clip(score, -60, 60))))[:, None]
            slopes = np.empty((len(target) + drawn.size, d + 1), np.float32)
            np.multiply(error, mine, out=slopes[: len(target)])
            real *= error
            pulled += real
            against = -noise
            against[:, :, -1] += log_noise.take(drawn)
            # In place, since these arrays take much of the time; what overflows has no error.
            errors = blocks @ against.transpose(0, 2, 1)
            with np.errstate(over="ignore"):
                np.exp(errors, out=errors)
            errors += 1.0
            np.divide(share, errors, out=errors)
            at += errors @ noise
            np.matmul(errors.transpose(0, 2, 1), blocks, out=slopes[len(target) :].reshape(noise.shape))
            moves.append((np.concatenate([target, drawn.ravel()]) + base, slopes))
        at = at.reshape(full.shape)[:count, :d] + _summed(of, pulled, count)[:, :d]
        ids = np.concatenate([h1, h2, np.arange(size - 2 * d, size)])
        slopes = np.zeros((len(ids), d + 1), np.float32)
        slopes[:, :d] = np.concatenate([at @ c1.T, at @ c2.T, x1.T @ at, x2.T @ at])
        for move in (*moves, (ids, slopes)):
            self._move(*move)

    def learn_all(self, h1: np.ndarray, h2: np.ndarray, w: np.ndarray) -> None:
        """Steps over all these tokens, equal ones and equal contexts together, in random order of the contexts."""
        self.use(h1, h2, w)
        key, bits = _packed(self.classes, h1, h2, w)
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        weight = np.diff(first, append=len(key)).astype(np.float32)
        key = key[first]
        before, w = key >> bits, key & (1 << bits) - 1
        first = np.flatnonzero(np.diff(before, prepend=-1))
        place, at = self.chance.permutation(len(first)), np.empty(len(first), np.int64)
        at[place] = np.arange(len(first))
        sizes = np.diff(first, append=len(w))[at]
        first, of = first[at], np.repeat(np.arange(len(at)), sizes)
        order = np.arange(len(w)) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
        h1, h2 = before[first] >> bits, before[first] & (1 << bits) - 1
        w, weight = w[order], weight[order]
        for start in range(0, len(h1), BATCH):
            i, j = np.searchsorted(of, (start, start + BATCH))
            contexts = slice(start, start + BATCH)
            self.learn(h1[contexts], h2[contexts], of[i:j] - start, w[i:j], weight[i:j])

    def train(self, counts: np.ndarray, steps: int = STEPS) -> None:
        """Steps over all cells of a dense table of (h1, h2, w)."""
        if not counts.sum():
            return
        self.__init__(self.classes, counts.reshape(-1, self.classes).sum(0).astype(float))
        cells = np.flatnonzero(counts)
        before, w = np.divmod(cells, self.classes)
        h1, h2 = np.divmod(before, self.classes)
        self.ready()
        for _ in range(steps):
            self.learn(h1, h2, np.arange(len(w)), w, counts[cells].astype(np.float32))

    def log10(self, h1: np.ndarray, h2: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Normalised log10 P(w | h1 h2) of each row. Equal contexts, and equal groups after them, are normalised once."""
        n = self.classes
        key, bits = _packed(n, h1, h2, w)
        order = np.argsort(key)
        key = key[order]
        new = np.diff(key, prepend=-1) > 0
        key, row = key[new], np.cumsum(new) - 1
        before, w = key >> bits, key & (1 << bits) - 1
        new = np.diff(before, prepend=-1) > 0
        of, before = np.cumsum(new) - 1, before[new]
        context = np.ones((len(before), DIMENSION + 1), np.float32)
        for start in range(0, len(before), BATCH):
            some = before[start : start + BATCH]
            context[start : start + BATCH, :-1] = self.context(some >> bits, some & (1 << bits) - 1)
        longest = float(np.sqrt(np.einsum("ij,ij->i", context, context).max(initial=0.0)))
        logs = np.zeros(len(w))

        def add(rows: np.ndarray | slice, contexts: np.ndarray | slice, at: np.ndarray, vectors: np.ndarray, target: np.ndarray) -> None:
            """Normalise over ``vectors`` after some contexts, for rows that name their context by ``at``."""
            score = context[contexts] @ vectors.T
            if longest * float(np.sqrt((vectors * vectors).sum(axis=1).max())) > UNSHIFTED:
                score -= score.max(axis=1, keepdims=True)
            chosen = score[at, target]
            logs[rows] += chosen - np.log(np.exp(score, out=score) @ np.ones(len(vectors), np.float32))[at]

        group, step = self.group[w], max(1, NORMALISED // self.groups)
        for start in range(0, len(context), step):
            i, j = np.searchsorted(of, (start, start + step))
            add(slice(i, j), slice(start, start + step), of[i:j] - start, self.rows[2 * n : 2 * n + self.groups], group[i:j])
        by_group = np.argsort(group.astype(np.uint16) if self.groups < 1 << 16 else group, kind="stable")
        ends = np.searchsorted(group[by_group], np.arange(self.groups + 1))
        for g in np.flatnonzero(np.diff(ends)):
            first, stop = self.starts[g], self.starts[g + 1]
            if stop - first > 1:
                rows = by_group[ends[g] : ends[g + 1]]
                new = np.diff(of[rows], prepend=-1) > 0
                at, contexts, step = np.cumsum(new) - 1, of[rows[new]], max(1, NORMALISED // int(stop - first))
                for start in range(0, len(contexts), step):
                    i, j = np.searchsorted(at, (start, start + step))
                    add(rows[i:j], contexts[start : start + step], at[i:j] - start, self.rows[n + first : n + stop], w[rows[i:j]] - first)
        found = np.empty(len(row))
        found[order] = logs[row]
        return found / math.log(10)

    def log10_table(self) -> np.ndarray:
        """log10 P(w | h1 h2) of all symbols, one row per context in the order of (h1, h2)."""
        n = self.classes
        cells = np.arange(n**3)
        return self.log10(cells // (n * n), cells // n % n, cells % n).reshape(n * n, n)


class Vocabulary:
    """Frequent words by falling counts, then the end and the symbol for all other words."""

    def __init__(self, words: list[tuple[str, int]], ends: int):
        ordered = sorted(words, key=lambda x: (-x[1], x[0]))
        self.end, self.other = len(ordered), len(ordered) + 1
        self.classes = self.other + 1
        self.words = pa.array([w.encode() for w, _ in ordered], pa.binary())
        self.counts = np.array([c for _, c in ordered], float)
        self.log_count = np.log10(np.append(self.counts, 0.0) + 1.0)
        self.ends = ends

    def numbers(self, words: pa.DictionaryArray) -> np.ndarray:
        """Number of each word, -1 if it is not frequent."""
        known = pc.index_in(words.dictionary, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        return known.astype(np.int64)[words.indices.to_numpy()]

    def trigrams(self, numbers: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(h1, h2, w) of all tokens of some texts, whose words up to ``stops`` have these numbers."""
        ends = stops + np.arange(len(stops))
        w = np.full(len(numbers) + len(stops), self.end)
        inside = np.ones(len(w), bool)
        inside[ends] = False
        w[inside] = np.where(numbers >= 0, numbers, self.other)
        h2 = np.concatenate(([self.end], w[:-1]))
        h1 = np.concatenate(([self.end], h2[:-1]))
        # The token before the first of a text is an end anyway, the one before that is made one.
        h1[0] = h1[ends[:-1] + 1] = self.end
        return h1, h2, w

    def of_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(h1, h2, w) of all tokens of some texts, one text at least."""
        words, stops = words_of(texts)
        return self.trigrams(self.numbers(words), stops)


def frequent_words(counts: DataFrame, most: int = FREQUENT) -> list[tuple[str, int]]:
    """All words counted at least 2^k times, for the least k that leaves ``most`` at most."""
    level = F.floor(F.log2("c")).cast("int")
    held = {r["level"]: r["words"] for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()}
    total, least = 0, None
    for k in sorted(held, reverse=True):
        total += held[k]
        if total > most:
            break
        least = k
    return [(r["word"], r["c"]) for r in counts.where(F.col("c") >= (1 << least)).collect()] if least is not None else []


def _train_round(texts: DataFrame, vocabulary: Vocabulary, model: LogBilinear, sample: tuple) -> None:
    """Tasks learn from all tokens of ``texts``, each from the rows of ``model``, which then take up the changes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.copy(model)
        own.rows = model.rows.copy()
        own.ready()
        for batch in slices(batches, "text"):
            own.learn_all(*vocabulary.of_texts(raw_texts(batch)))
        changed = np.flatnonzero(own.used)
        for part in np.split(changed, np.flatnonzero(np.diff(changed // TOGETHER)) + 1) if len(changed) else []:
            values = [
                (part % TOGETHER).astype(np.uint8), own.used[part].astype(np.float32),
                (own.rows[part] - model.rows[part]).astype(np.float16),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(part[0]) // TOGETHER], pa.int64()), *(pa.array([v.tobytes()], pa.binary()) for v in values)],
                ["block", "places", "used", "moved"],
            )

    def unite(rows: pa.Table) -> pa.Table:
        total = np.zeros((TOGETHER, DIMENSION + 1))
        uses, squared = np.zeros(TOGETHER), np.zeros(TOGETHER)
        for places, used, moved in zip(*(rows.column(c).to_pylist() for c in ("places", "used", "moved"))):
            places, used = np.frombuffer(places, np.uint8), np.frombuffer(used, np.float32).astype(float)
            total[places] += used[:, None] * np.frombuffer(moved, np.float16).reshape(-1, DIMENSION + 1)
            uses[places] += used
            squared[places] += used * used
        alike = np.maximum(1, uses * uses / np.maximum(squared, 1))  # tasks, when all use a row as often
        united = np.concatenate([total / np.maximum(uses, 1)[:, None], alike[:, None]], axis=1).astype(np.float32)
        return pa.table({"block": rows.column("block")[:1], "moved": pa.array([united.tobytes()], pa.binary())})

    changes = texts.select("text").mapInArrow(run, "block bigint, places binary, used binary, moved binary")
    average, alike = np.zeros_like(model.rows), np.ones(len(model.rows), np.float32)
    for row in changes.groupBy("block").applyInArrow(unite, "block bigint, moved binary").collect():
        start = row["block"] * TOGETHER
        found = np.frombuffer(row["moved"], np.float32).reshape(TOGETHER, -1)[: len(model.rows) - start]
        average[start : start + TOGETHER], alike[start : start + TOGETHER] = found[:, :-1], found[:, -1]
    before, best = model.rows, None
    for further in (None, *FURTHER):
        model.rows = before if further is None else before + average * (alike**further)[:, None]
        model.ready()
        reached = float(model.log10(*sample).sum())
        if best is None or reached > best[0]:
            best = reached, model.rows
    model.rows = best[1]


def _sample(training: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams of some training texts, ``JUDGED`` tokens at most, by which the length of a step is chosen."""
    texts = training.select("text").orderBy(F.xxhash64("doc_id", "text")).limit(200).collect()
    h1, h2, w = vocabulary.of_texts([(row["text"] or "").encode() for row in texts] or [b""])
    return h1[:JUDGED], h2[:JUDGED], w[:JUDGED]


def train_model(training: DataFrame, vocabulary: Vocabulary, in_other: int) -> LogBilinear:
    """The model of all tokens of ``training`` (doc_id, text)."""
    model = LogBilinear(vocabulary.classes, np.append(vocabulary.counts, [vocabulary.ends, in_other]))
    sample = _sample(training, vocabulary)
    part, least = crc_of_id() % (7 * ROUND_PARTS), 0
    every = int(vocabulary.counts.sum()) + in_other + vocabulary.ends
    for share in ROUNDS:
        texts = training.where((part >= 7 * least) & (part < 7 * (least + share)))
        _train_round(texts.coalesce(every * share // ROUND_PARTS // TASK_TOKENS + 1), vocabulary, model, sample)
        least += share
    return model


SCANNED = (
    "doc_id bigint, key bigint, held_out boolean, n_tokens bigint, known bigint, others bigint, neural double, logs double, "
    "word string, times bigint"
)


def _scan(vocabulary: Vocabulary, model: LogBilinear):
    """Per document what the frequent words give, and a row for each rarer word it holds."""
    names = [p.split()[0] for p in SCANNED.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SCORED_BYTES):
            words, stops = words_of(raw_texts(batch))
            numbers, rows = vocabulary.numbers(words), len(batch)
            sizes = np.diff(stops, prepend=0)
            text, listed = np.repeat(np.arange(rows), sizes), numbers >= 0
            frequent = np.bincount(text[listed], minlength=rows)
            logs = np.bincount(text[listed], vocabulary.log_count[numbers[listed]], rows) + math.log10(vocabulary.ends + 1.0)
            neural = model.log10(*vocabulary.trigrams(numbers, stops))
            neural = np.add.reduceat(neural, np.append(0, stops[:-1] + np.arange(1, rows)))
            sums = [sizes + 1, frequent + (vocabulary.ends > 0), sizes - frequent, neural, logs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), batch.column("held_out")]
                + [pa.array(c, t) for c, t in zip(sums, [pa.int64()] * 3 + [pa.float64()] * 2)]
                + [pa.nulls(rows, pa.string()), pa.nulls(rows, pa.int64())], names,
            )
            # Distinct rarer words of each text.
            met = np.sort(text[~listed] * len(words.dictionary) + words.indices.to_numpy()[~listed])
            first = np.flatnonzero(np.diff(met, prepend=-1))
            if extra := len(first):
                text, word = np.divmod(met[first], len(words.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(extra, pa.int64()), batch.column("key").take(pa.array(text)), pa.nulls(extra, pa.bool_())]
                    + [pa.nulls(extra, t) for t in [pa.int64()] * 3 + [pa.float64()] * 2]
                    + [words.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(np.diff(first, append=len(met)))], names,
                )

    return run


def score_documents(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Learn from the documents whose crc32(id) mod ``folds`` is not ``held``; score all of (doc_id, text)."""
    marked = docs.select("doc_id", "text", (crc_of_id() % folds == held).alias("held_out"))
    training = marked.where("not held_out")
    counts = stored(count_words(training))
    ends = training.count()
    size = counts.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    total, types = (size["n"] or 0) + ends, size["v"] + (ends > 0)
    vocabulary = Vocabulary(frequent_words(counts), ends)
    in_other = int(total - ends - vocabulary.counts.sum())
    other_types = size["v"] - vocabulary.end
    model = train_model(training, vocabulary, in_other)

    # A row and its rare words are written together by one task, so a number that tells rows apart joins them again.
    keyed = marked.withColumn("key", F.monotonically_increasing_id())
    scanned = stored(keyed.mapInArrow(_scan(vocabulary, model), SCANNED))
    rare = (
        scanned.where("word is not null").select("key", "word", "times")
        .join(counts, "word").groupBy("key").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare_logs"))
    )
    joined = scanned.where("word is null").join(rare, "key", "left").fillna(0, ["rare_known"]).fillna(0.0, ["rare_logs"])
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * math.log10(total + types + 1)).alias("base_score"),
        (F.col("neural") + F.col("rare_logs") - F.col("others") * math.log10(in_other + other_types + 1)).alias("score"),
    )
