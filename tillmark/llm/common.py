"""Shared helpers: scratch tables, bounded Arrow slices, word hashes, count tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder

# Python works on slices of at most this many text bytes (or one document).
SLICE_BYTES = 2 << 20
# Id lists up to this length are broadcast, longer ones are joined by shuffle.
BROADCAST_IDS = 500_000

_SEED = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
     0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64,
)


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Only the named columns of a table, so that others cannot clash."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage like a checkpoint but keeps columns apart, so later reads
    take only what they need. A lost executor costs a read, nothing more.
    """
    folder = scratch_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def with_ids(docs: DataFrame, ids: DataFrame, how: str, on: str = "doc_id") -> DataFrame:
    """Semi or anti join on a short id list: broadcast when counted to be short, else shuffled."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids.hint("shuffle_merge"), on, how)


def shielded(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with column names that cannot clash with the operators' own (tm_...) or need quoting, and the way back."""
    def risky(name: str) -> bool:
        return name.lower().startswith("tm") or "." in name or "`" in name

    names = docs.columns
    return docs.toDF(*[f"tmu_{i}" if risky(n) else n for i, n in enumerate(names)]), lambda out: out.toDF(*names)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds at most ``limit`` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes per row; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _FACTORS[1]
    return x ^ (x >> np.uint64(29))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash per window of ``size`` word hashes."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, _SEED, np.uint64)
    for i in range(size):
        total += mixed(hashes[i : i + count] * _FACTORS[i % 8] + np.uint64(i))
    return mixed(total)


def count_rows(table: np.ndarray, limit: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The non-zero cells of a count table, in pieces."""
    cells = np.flatnonzero(table)
    for start in range(0, len(cells), limit):
        part = cells[start : start + limit]
        yield part, table[part]


def collect_counts(rows: DataFrame, key: str, value: str, size: int) -> np.ndarray:
    """Sum (key, value) rows of all tasks into one table of ``size`` cells, which bounds what is collected."""
    table = np.zeros(size, np.int64)
    found = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias(value)).toArrow()
    table[found.column(key).to_numpy()] = found.column(value).to_numpy()
    return table


def crc_of_id(column: str = "doc_id"):
    """crc32 of the id as text; null ids count as remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0))
