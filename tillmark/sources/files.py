"""Delimited scans and input fingerprints."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the margin-track input files, all read as text.
INPUT_COLUMNS = {
    "customers": (
        "record_id", "source", "loyalty_id", "loyalty_verified", "email", "email_verified", "phone",
        "phone_verified", "city", "marketing_consent",
    ),
    "products": ("product_id", "product_name", "category", "brand", "list_price", "unit_cost"),
    "events": (
        "event_id", "order_id", "customer_record_id", "product_id", "event_time", "event_type", "quantity",
        "unit_price", "discount_rate", "unit_cost", "channel", "origin_event_id",
    ),
}


def _dialect(sep: str) -> dict:
    """Headed file with doubled quotes; blanks around a cell belong to it."""
    return {
        "header": True, "sep": sep, "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Text columns of a headed file; an empty cell is an empty string, never null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.read.schema(schema)
        .options(**_dialect(sep), enforceSchema=False, mode="FAILFAST")
        .csv(path)
    )
    return rows.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def write_delimited(df: DataFrame, path: str, sep: str = ",", quote_all: bool = False) -> None:
    df.write.mode("errorifexists").options(
        **_dialect(sep), quoteAll=quote_all, emptyValue="", nullValue=""
    ).csv(path)


def read_typed(spark: SparkSession, path: str, ddl: str, sep: str = ",", rejected: str = "_rejected") -> DataFrame:
    """Typed columns of a headed delimited file, ISO dates included.

    The header must name the columns in their order. A row with a cell that is not
    of its column's type keeps its good cells and its text in ``rejected``, which is
    null for sound rows. An empty cell is null.
    """
    schema = f"{ddl}, {rejected} string"
    return (
        spark.read.schema(schema)
        .options(**_dialect(sep), enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=rejected)
        .options(dateFormat="yyyy-MM-dd", nullValue="")
        .csv(path)
    )


# Bytes that a fingerprint holds at a time.
_BLOCK = 4 << 20


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the files named in ``path``, each read in blocks."""
    from pyarrow import fs

    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            store, inside = fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with store.open_input_stream(inside) as stream:
                while block := stream.read(_BLOCK):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], [*batch.schema.names, "sha256"])


def input_manifest(spark: SparkSession, path: str, pattern: str = "*", files_per_task: int = 8) -> DataFrame:
    """Name below ``path``, length and SHA-256 of every file there, sub-folders included.

    Raises when there is no file. The list of files is dealt to tasks, which stream
    each file in blocks, so a file may be of any size. Stores are those that Arrow
    opens by their address (local, HDFS, S3 and the like).
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    # Only names and lengths are read here; the content column is pruned away.
    listed = found.select("path", "length")
    count = listed.count()
    if not count:
        raise ValueError(f"No file below {path}.")
    root = re.sub("^[a-z0-9]+:(//[^/]*)?", "", path).rstrip("/") + "/"
    inside = F.instr("path", root)
    below = F.when(inside > 0, F.expr("substring(path, start + width)")).otherwise(F.element_at(F.split("path", "/"), -1))
    dealt = listed.repartition(-(-count // files_per_task))
    digested = dealt.mapInArrow(_digests, "path string, length bigint, sha256 string")
    return digested.withColumns({"start": inside, "width": F.lit(len(root))}).select(
        below.alias("file_name"), F.col("length").alias("file_bytes"), "sha256"
    )


class Folder:
    """Moves and removals in the file system of a path, by the session's own Hadoop settings."""

    def __init__(self, spark: SparkSession, path: str):
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._new(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def has(self, path: str) -> bool:
        return self._files.exists(self._new(path))

    def make(self, path: str) -> None:
        self._files.mkdirs(self._new(path))

    def rename(self, source: str, target: str) -> bool:
        """False where the target exists or the move fails."""
        return not self.has(target) and self._files.rename(self._new(source), self._new(target))

    def remove(self, path: str) -> None:
        self._files.delete(self._new(path), True)


def require_fingerprints(manifest: DataFrame, expected: Mapping[str, str]) -> None:
    """Raise when a listed file is absent or has another digest."""
    found = {r["file_name"]: r["sha256"] for r in manifest.where(F.col("file_name").isin(list(expected))).collect()}
    wrong = sorted(name for name, digest in expected.items() if found.get(name) != digest)
    if wrong:
        raise ValueError(f"Input files are missing or changed: {wrong}")
