"""Reads and writes."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from yearpanel.sources.scratch import scratch_path


def read_table(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """A raw table. A CSV file has a header row and keeps every column as text."""
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and a function that makes its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def replaced(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """What ``write`` puts into the folder it is given becomes the folder ``path``.

    It is written beside ``path`` first, so that the old files can be read while the new ones are
    made, and stay if that fails. Then the folders are swapped by renaming. An error between the
    two renames puts the old folder back. Frames over the old files have to be read anew.
    """
    files, make = _hadoop(spark, path)
    target = make(path)
    mark = uuid.uuid4().hex
    staged, old = (make(target.getParent(), f"_{target.getName()}-{kind}-{mark}") for kind in ("new", "old"))
    try:
        write(staged.toString())
        present = files.exists(target)
        if present and not files.rename(target, old):
            raise OSError(f"cannot move {path}")
        if not files.rename(staged, target):
            if present:
                files.rename(old, target)
            raise OSError(f"cannot put the new files at {path}")
        files.delete(old, True)
    finally:
        files.delete(staged, True)
    spark.catalog.refreshByPath(path)


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    header: bool = False,
    partition_by: list[str] | None = None,
    single_file: bool = False,
    order_by: list[str] | None = None,
) -> None:
    """Write ``df`` as CSV, by default without a header and failing if the path exists.

    ``mode="overwrite"`` may replace the files that ``df`` reads (see ``replaced``).
    ``single_file`` gives one file, in ``order_by`` order (see ``write_joined``).
    """
    spark = df.sparkSession
    if mode == "overwrite":
        def write(folder: str) -> None:
            write_csv(df, folder, "errorifexists", header, partition_by, single_file, order_by)

        return replaced(spark, path, write)
    if single_file:
        return write_joined(df, path, mode, header, order_by)
    writer = df.write.mode(mode).option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_joined(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    header: bool = False,
    order_by: list[str] | None = None,
) -> None:
    """One CSV file in ``order_by`` order, without a task that sorts or holds all rows.

    Ranges of the order are sorted and written by a task each into the shared scratch folder. The
    file system then joins the parts: by taking over their blocks where it can, else by copying
    their bytes one after the other.
    """
    spark = df.sparkSession
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    folder = scratch_path(spark, "parts")
    df.write.csv(f"{folder}/rows")
    if header:
        names = spark.createDataFrame([tuple(df.columns)], [f"c{k}" for k in range(len(df.columns))])
        names.coalesce(1).write.csv(f"{folder}/header")
    # Spark makes the folder, or refuses to, as the mode says.
    spark.createDataFrame([], "none int").write.mode(mode).csv(path)
    files, make = _hadoop(spark, path)
    scratch, _ = _hadoop(spark, folder)
    parts = [
        status.getPath()
        for part in (["header"] if header else []) + ["rows"]
        for status in sorted(
            scratch.listStatus(make(f"{folder}/{part}")), key=lambda s: s.getPath().getName()
        )
        if status.getPath().getName().startswith("part-") and status.getLen()
    ]
    for status in files.listStatus(make(path)):
        if status.getPath().getName().startswith("part-"):
            files.delete(status.getPath(), False)
    target = make(path, f"part-00000-{uuid.uuid4()}.csv")
    files.create(target).close()
    try:
        gateway = spark.sparkContext._gateway
        sources = gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Path, len(parts))
        for k, part in enumerate(parts):
            sources[k] = part
        if parts:
            files.concat(target, sources)
    except (PySparkException, Py4JJavaError):  # cannot take over blocks, or not from there
        _copied(spark, scratch, parts, files, target)


def _copied(spark: SparkSession, source, parts: list, files, target) -> None:
    out = files.create(target, True)
    try:
        for part in parts:
            data = source.open(part)
            try:
                spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, 1 << 20, False)
            finally:
                data.close()
    finally:
        out.close()


def write_by_lag(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One CSV folder per lag, in one job.

    Lagged panels are totals by country and year. Rows of a lag are spread over several tasks
    by country first, so that each folder gets a bounded number of files.
    """
    write_csv(df.repartition("lag", "country"), path, mode=mode, partition_by=["lag"])


def publish(**frames: DataFrame) -> None:
    """Register frames as temporary views, for callers who go on in SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
