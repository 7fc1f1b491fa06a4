"""Language identification with a string kernel.

The kernel compares two texts by the n-grams both hold (presence, not counts),
blended over n = 1 .. 4 bytes of UTF-8, case folded, and normalised:
k(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|). N-grams are hashed into 2^18
cells. Landmarks give the Nystroem features K(x, L) K(L, L)^(-1/2); one ridge
regression per language separates it from the rest. Documents are scored in
batches: a presence matrix times the landmark matrix, times the weights.

The classifier is fitted to a bounded sample of labelled rows: at most
``SAMPLE_PER_LANGUAGE`` texts of each language, fewer where there are so many
languages that they would make more than ``SAMPLE_ROWS``, but one of each at
least. Every text counts whole. Landmarks are dealt to the languages in turn:
``LANDMARKS`` in all, or one for each language if those are more. Rows are taken by
a hash of the id. Predictions cover every document.

Defined results: null texts and texts without a letter are ``und`` with score
0; ties go to the first language by name; without labelled rows everything is
``und``; repeated rows are predicted alike. A character is a letter as in
Unicode's categories L*.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_of_id, raw_texts, slices

SIZES = (1, 2, 3, 4)
CELL_BITS = 18
SAMPLE_PER_LANGUAGE = 300
SAMPLE_ROWS = 60_000
LANDMARKS = 128
RIDGE = 1e-2
BATCH = 256


def gram_cells(text: bytes) -> np.ndarray:
    """Sorted distinct hash cells of the text's n-grams."""
    codes = np.frombuffer(text.lower(), np.uint8).astype(np.uint32)
    seen = np.zeros(1 << CELL_BITS, bool)
    gram = np.zeros(len(codes), np.uint32)
    for n in SIZES:
        if len(codes) < n:
            break
        gram = (gram[: len(codes) - n + 1] << np.uint32(8)) | codes[n - 1 :]
        seen[((gram + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - CELL_BITS)] = True
    return np.flatnonzero(seen)


class KernelModel:
    """Landmarks, Nystroem map and weights of the ridge regressions."""

    def __init__(self, texts: list[bytes], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.names = sorted(set(languages))
        cells = [gram_cells(t) for t in texts]
        turns, met = [], dict.fromkeys(self.names, 0)
        for i, language in enumerate(languages):
            turns.append((met[language], i))
            met[language] += 1
        chosen = np.array(sorted(i for _, i in sorted(turns)[: max(landmarks, len(self.names))]))
        # Only cells that a landmark holds count in a kernel value.
        held = np.unique(np.concatenate([cells[i] for i in chosen]))
        self.column = np.full(1 << CELL_BITS, -1, np.int32)
        self.column[held] = np.arange(len(held), dtype=np.int32)
        self.marks = np.zeros((len(held), len(chosen)), np.float32)
        for j, i in enumerate(chosen):
            self.marks[self.column[cells[i]], j] = 1.0 / np.sqrt(max(1, len(cells[i])))
        among = self.kernel([cells[i] for i in chosen])
        values, vectors = np.linalg.eigh((among + among.T) / 2)
        kept = values > 1e-6
        nystroem = vectors[:, kept] / np.sqrt(values[kept])
        features = self.kernel(cells) @ nystroem
        goals = np.array([[1.0 if l == n else -1.0 for n in self.names] for l in languages])
        # Languages weigh alike, however many rows each has.
        weight = np.array([1.0 / languages.count(l) for l in languages])[:, None]
        mean = (weight * features).sum(0) / weight.sum()
        self.offset = (weight * goals).sum(0) / weight.sum()
        centred = features - mean
        gram = centred.T @ (weight * centred) + ridge * np.eye(centred.shape[1])
        solved = np.linalg.solve(gram, centred.T @ (weight * (goals - self.offset)))
        self.weights = (nystroem @ solved).astype(np.float32)
        self.offset = (self.offset - mean @ solved).astype(np.float32)

    def kernel(self, cells: list[np.ndarray]) -> np.ndarray:
        """Normalised kernel values of texts (rows) with the landmarks (columns)."""
        found = np.empty((len(cells), self.marks.shape[1]))
        for start in range(0, len(cells), BATCH):
            part = cells[start : start + BATCH]
            present = np.zeros((len(part), self.marks.shape[0]), np.float32)
            for row, c in enumerate(part):
                columns = self.column[c]
                present[row, columns[columns >= 0]] = 1.0 / np.sqrt(max(1, len(c)))
            found[start : start + len(part)] = present @ self.marks
        return found

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """The best language of each text, and a score between 0 and 1."""
        margins = self.kernel([gram_cells(t) for t in texts]) @ self.weights + self.offset
        best = margins.argmax(axis=1)
        score = np.clip((margins[np.arange(len(texts)), best] + 1.0) / 2.0, 0.0, 1.0)
        return [self.names[b] for b in best], score


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows (lang, text) of every language, by hash of the id.

    A share of each language is drawn first, so only about twice the bound is ordered.
    """
    rows = docs.where("lang is not null and text is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("held"))
    languages = counts.count()
    if not languages:
        return rows.select("lang", "text").limit(0)
    per_language = max(1, min(per_language, SAMPLE_ROWS // languages))
    known = counts.select("lang", (F.lit(2.0 * per_language + 20.0) / F.col("held")).alias("share"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.join(known, "lang").withColumn("tm_place", place).where("tm_place < share")
    ranked = drawn.select("lang", "doc_id", "tm_place").withColumn(
        "tm_rank", F.row_number().over(Window.partitionBy("lang").orderBy("tm_place", "doc_id"))
    )
    cut = ranked.where(F.col("tm_rank") <= per_language).groupBy("lang").agg(F.max("tm_place").alias("tm_last"))
    taken = drawn.join(cut, "lang").where("tm_place <= tm_last")
    return taken.select("lang", "text", "doc_id").orderBy("tm_place", "doc_id").limit(per_language * languages).select("lang", "text")


def fit(docs: DataFrame) -> KernelModel | None:
    """A model from labelled rows (doc_id, text, lang); None when there are none."""
    rows = labelled_sample(docs).collect()
    return KernelModel([(r["text"] or "").encode() for r in rows], [r["lang"] for r in rows]) if rows else None


PREDICTED = "doc_id bigint, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, model: KernelModel | None) -> DataFrame:
    """Language and score of every document (doc_id, text, held_out)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            letters = pc.fill_null(pc.match_substring_regex(batch.column("text"), r"\p{L}"), False).to_numpy(zero_copy_only=False)
            names, scores = ["und"] * len(batch), np.zeros(len(batch))
            if model is not None:
                names, scores = model.predict(raw_texts(batch))
                names = [n if letter else "und" for n, letter in zip(names, letters)]
                scores = np.where(letters, scores, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, PREDICTED)


def identify_held_out(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Fit on the documents whose crc32(id) mod ``folds`` is not ``held``; predict all."""
    marked = docs.select("doc_id", "text", "lang", (crc_of_id() % folds == held).alias("held_out"))
    return identify(marked, fit(marked.where("not held_out")))
