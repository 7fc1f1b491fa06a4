"""Fitted models and their metric rows, kept under a fingerprint of what they were fitted on.

A folder per fingerprint holds one sub-folder per fitted model and one for the
metric rows of the selection. Everything is written under a temporary name and
renamed when it is complete, so a reader never meets half a model and two runs
that fit the same model at once do not disturb each other.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.files import Folder


def shared_store(spark: SparkSession) -> str:
    """Folder for models below the shared checkpoint folder of the session."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/models"


def fingerprint(rows: DataFrame, columns: Sequence[str], settings: dict) -> str:
    """Changes with any value of ``columns``, with the number of rows and with the settings, and not with their order."""
    row_hash = F.xxhash64(*[F.col(c) for c in columns])
    content = rows.agg(
        F.count("*").alias("rows"), F.sum(row_hash.cast("decimal(20,0)")).cast("string").alias("sum"),
        F.bit_xor(F.xxhash64(row_hash, F.lit(1))).alias("mixed"),
    ).first()
    text = json.dumps([content["rows"], content["sum"], content["mixed"], list(columns), settings], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


class ModelStore:
    """Models and tables by name below one folder; what exists is read, what does not is made and kept."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._files = spark, folder, Folder(spark, folder)

    def has(self, name: str) -> bool:
        return self._files.has(f"{self.folder}/{name}")

    def _keep(self, name: str, write: Callable[[str], None]) -> None:
        """Write under a temporary name, then rename; if another run was first, its result stays."""
        made = f"{self.folder}/_making-{uuid.uuid4().hex}"
        write(made)
        if not self._files.rename(made, f"{self.folder}/{name}"):
            self._files.remove(made)

    def model(self, name: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
        if not self.has(name):
            self._keep(name, lambda path: fit().save(path))
        return PipelineModel.load(f"{self.folder}/{name}")

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if not self.has(name):
            self._keep(name, lambda path: make().write.parquet(path))
        return self.spark.read.parquet(f"{self.folder}/{name}")
