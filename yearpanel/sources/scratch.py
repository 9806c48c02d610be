"""Tables written to the cluster's shared folder to cut a lineage."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"

_kept: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder that the session names in ``spark.checkpoint.dir``.

    A session without that setting uses a folder below its warehouse, which is shared storage on
    a cluster as well.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        base = f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _kept:
        _kept[-1].append(path)
    return path


@contextlib.contextmanager
def deleted_afterwards(spark: SparkSession) -> Iterator[None]:
    """Deletes the scratch tables made inside when it ends, also by an error."""
    _kept.append([])
    try:
        yield
    finally:
        for path in _kept.pop():
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, if there is one, on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that ``materialise`` gave and that nothing reads any more."""
    for frame in frames:
        delete_folder(frame.sparkSession, frame.scratch)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written once as parquet to the shared folder and read back.

    For a frame that several jobs read. Later jobs scan only the columns they need, and a lost
    executor costs the re-read of its files instead of the whole upstream plan.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.scratch = path
    return written
