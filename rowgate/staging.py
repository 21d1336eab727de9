"""Intermediate results that several later steps read, kept in the cluster's shared folder.

A kept frame is a written parquet table, so it outlives the executors that made it and its
rows are the same for every reader.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
MIN_SPLITS = "spark.sql.files.minPartitionNum"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set on the context; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="rowgate-")


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """Set a session option inside the block, unless the session has set it already."""
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)


def fixed_splits(spark: SparkSession) -> AbstractContextManager[None]:
    """Scans inside the block cut the same files into the same partitions every time.

    Spark otherwise sizes splits by the cores it has at that moment, which changes as executors
    come and go, and a row number taken from the split would change with it.
    """
    return setting(spark, MIN_SPLITS, spark.sparkContext.defaultParallelism)


def file_system(spark: SparkSession, place: str) -> tuple:
    """The file system of a path and the path as an object of it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


class Staging:
    """One run's own folder below the shared folder.

    As a context manager it deletes the folder at the end of the block. Otherwise the folder goes
    with ``clear``, or at the latest when the driver ends in order.
    """

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.folder = f"{root or shared_folder(spark)}/rowgate-{uuid.uuid4().hex}"

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *fault: object) -> None:
        self.clear()

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, df: DataFrame, name: str, flag: str | None = None) -> DataFrame:
        """Write ``df`` once and return a frame that reads what was written.

        ``flag`` names a boolean column that gets a folder for each of its values.
        """
        if flag:
            # Two open files a task, instead of a sort of all rows by folder.
            with setting(self.spark, OPEN_WRITERS, 2):
                df.write.partitionBy(flag).parquet(self.path(name))
        else:
            df.write.parquet(self.path(name))
        self.delete_at_end()
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def forget(self, name: str) -> None:
        """Delete one kept frame that no later step reads."""
        system, path = file_system(self.spark, self.path(name))
        system.delete(path, True)

    def delete_at_end(self) -> None:
        """Have the folder, once it is there, deleted when the driver ends."""
        system, path = file_system(self.spark, self.folder)
        system.deleteOnExit(path)

    def clear(self) -> None:
        """Delete the run's folder; call it only when no frame kept here is still needed."""
        system, path = file_system(self.spark, self.folder)
        system.delete(path, True)
