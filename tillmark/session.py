"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Split a hot join key even where the split costs one more shuffle. Adaptive
# execution and its skew handling are Spark's defaults.
SKEW_SETTING = "spark.sql.adaptive.forceOptimizeSkewedJoin"
# Remove the shuffle files of an action at its end.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tillmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC clocks and adaptive execution; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        # Checkpoint files go away with the last reference to their DataFrame.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        SKEW_SETTING: "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Turn on skew splitting in a session that somebody else has built and left it open."""
    if SKEW_SETTING not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set(SKEW_SETTING, "true")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one only for a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = context.getConf().get("spark.checkpoint.dir")
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillmark-checkpoint-"))
    else:
        raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from there.

    Used where a result is read several times or must not be computed again
    differently, so losing an executor costs a re-read and nothing else.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared checkpoint folder, for tables that are read back."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tillmark-{uuid.uuid4().hex}"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of actions inside go away when the action ends, not with the last reference to its frame."""
    before = spark.conf.get(CLEANUP_SETTING, None)
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_SETTING)
        else:
            spark.conf.set(CLEANUP_SETTING, before)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage like a checkpoint, but later reads take only the columns they need.
    """
    return stored_in_turn([df])


def stored_in_turn(frames: Iterable[DataFrame]) -> DataFrame:
    """Frames of one schema, written one after another and read back as one.

    Shuffle files of a frame are gone before the next frame begins, so that the
    disk holds those of one frame at a time.
    """
    folders = []
    for df in frames:
        if not folders:
            top = scratch_folder(df.sparkSession)
        with brief_shuffles(df.sparkSession):
            df.write.option("compression", "zstd").parquet(f"{top}/{len(folders)}")
        folders.append(f"{top}/{len(folders)}")
    return df.sparkSession.read.schema(df.schema).parquet(*folders)


def discard(stored_frame: DataFrame) -> None:
    """Delete the files of a stored frame that nothing reads any more."""
    jvm, conf = stored_frame.sparkSession._jvm, stored_frame.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for file in stored_frame.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        path.getFileSystem(conf).delete(path, False)
