"""Quality rules: a hashed n-gram log-likelihood ratio beside counted base rules.

Two multinomials over hashed byte n-grams are compared: that of trusted
documents and that of the raw corpus. A document's score is the mean over its
n-grams of log p_trusted - log p_raw. Every document at or above the threshold
passes, always the same way.

The raw corpus is counted whole. Trusted documents are those labelled with
quality 1 and nothing else; of them at most ``TRUSTED_ROWS`` are taken, by hash
of the id, and counted whole. Their ids are the only thing broadcast.

Base rules count in words, which are runs of anything but space and \\t..\\r.

Defined results: null, empty and blank texts have no words and fail the base
rules; a text too short for one n-gram scores 0; without trusted labels every
score is 0 and only the base rules decide; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import collect_counts, count_rows, gram_hashes, raw_texts, slices, word_hashes

CELL_BITS = 16
CELLS = 1 << CELL_BITS
GRAM = 4
TRUSTED_ROWS = 20_000
# Nats per n-gram. Running text of the trusted kind scores about 0, a little less where its
# language is rare among the trusted rows; markup, shouting and symbol litter score below -0.7.
THRESHOLD = -0.45
MIN_WORDS, REPEAT_PERCENT = 50, 50

# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


def gram_cells(text: bytes) -> np.ndarray:
    """Hash cells of all windows of GRAM bytes."""
    codes = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(codes) < GRAM:
        return np.empty(0, np.uint32)
    grams = codes[: len(codes) - GRAM + 1].copy()
    for i in range(1, GRAM):
        grams = (grams << np.uint32(8)) | codes[i : len(codes) - GRAM + 1 + i]
    return (grams * np.uint32(2654435761)) >> np.uint32(32 - CELL_BITS)


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    codes = np.frombuffer(text, np.uint8)
    starts = int(np.count_nonzero((codes & 0xC0) != 0x80))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > 3:
        grams = gram_hashes(word_hashes(words), 3)
        order = np.argsort(grams, kind="stable")
        equal = grams[order[1:]] == grams[order[:-1]]
        if equal.any():
            twice = np.zeros(len(words), bool)
            found = np.zeros(len(grams), bool)
            found[order[1:][equal]] = True
            found[order[:-1][equal]] = True
            for i in range(3):
                twice[i : i + len(grams)] |= found
            repeated = int(twice.sum())
    return (
        len(words), starts - int(np.count_nonzero(_IS_SPACE[codes])), int(np.count_nonzero(_IS_SYMBOL[codes])),
        len(lines) - len(set(lines)), repeated,
    )


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` ids whose labels all say quality 1, taken by hash."""
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("p"))
    return good.where("q = 1 and p = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id")


def fit_ratio(docs: DataFrame, labels: DataFrame, trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """log p_trusted - log p_raw per cell, with one count added to each cell."""
    marks = trusted_ids(labels, trusted_rows).withColumn("trusted", F.lit(True))
    flagged = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id", "left").select("text", "trusted")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(2 * CELLS, np.int64)
        for batch in slices(batches, "text"):
            for text, trusted in zip(raw_texts(batch), batch.column("trusted").to_pylist()):
                counted = np.bincount(gram_cells(text), minlength=CELLS) if len(text) > CELLS else None
                if counted is None:
                    cells = gram_cells(text)
                    np.add.at(table, cells, 1)
                    if trusted:
                        np.add.at(table, cells + np.uint32(CELLS), 1)
                else:
                    table[:CELLS] += counted
                    if trusted:
                        table[CELLS:] += counted
        for cells, hits in count_rows(table):
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(hits, pa.int64())], ["cell", "hits"])

    table = collect_counts(flagged.mapInArrow(run, "cell bigint, hits bigint"), "cell", "hits", 2 * CELLS)
    raw, trusted = table[:CELLS], table[CELLS:]
    if not trusted.any():
        return np.zeros(CELLS)
    return np.log((trusted + 1.0) / (trusted.sum() + CELLS)) - np.log((raw + 1.0) / (raw.sum() + CELLS))


def judge(text: bytes, ratio: np.ndarray, threshold: float = THRESHOLD):
    counts = base_counts(text)
    failed = counts[0] < MIN_WORDS or 100 * counts[4] > REPEAT_PERCENT * counts[0]
    cells = gram_cells(text)
    score = float(ratio[cells].mean()) if len(cells) else 0.0
    return (*counts, failed, not failed and score >= threshold, score)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"]
TYPES = (pa.int64(),) * 5 + (pa.bool_(), pa.bool_(), pa.float64())
JUDGED = "doc_id bigint, " + ", ".join(f"{n} {t}" for n, t in zip(NAMES, ["bigint"] * 5 + ["boolean"] * 2 + ["double"]))


def judge_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, score and verdict of each document (doc_id, text)."""
    ratio = fit_ratio(docs, labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = zip(*(judge(text, ratio, threshold) for text in raw_texts(batch)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, t) for c, t in zip(columns, TYPES)], ["doc_id", *NAMES]
            )

    return docs.select("doc_id", "text").mapInArrow(run, JUDGED)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a passing verdict, all columns kept."""
    ratio = fit_ratio(docs, labels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array([judge(text, ratio, threshold)[6] for text in raw_texts(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
