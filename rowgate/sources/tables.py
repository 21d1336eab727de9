"""Catalog tables: names, schema, scan, sink, preview."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
WRITE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


@dataclass(frozen=True)
class TableNames:
    bronze: str
    silver: str
    bad: str


# The default schema, the layers and the suffix of a pipeline's tables.
def table_names(pipeline: str, schema: str = "project", suffix: str = "framework") -> TableNames:
    """The three tables of a pipeline, named by convention."""
    ending = f"_{suffix}" if suffix else ""
    return TableNames(*(f"{schema}.{pipeline}_{layer}{ending}" for layer in ("bronze", "silver", "bad")))


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the schema unless it is there. ``location`` sets where its managed tables live."""
    quoted = ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))
    escaped = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = f" LOCATION '{escaped}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted}{place}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    format_type: str | None = None,
    even_files: bool = False,
) -> None:
    """Write a managed table in the session's default format unless one is named.

    ``even_files`` rebalances the rows into files of the session's advisory size first. Use it
    for a thin slice of a wide scan, which would otherwise leave one tiny file per scan task.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    if even_files:
        df = df.hint("rebalance")
    writer = df.write.mode(mode)
    if format_type:
        writer = writer.format(format_type)
    writer.saveAsTable(name)


def replace_partitions(
    df: DataFrame, name: str, partition_by: Sequence[str], format_type: str | None = None
) -> None:
    """Replace those partitions of a table that ``df`` has rows of, and leave the files of all others alone.

    The table is made, partitioned by ``partition_by``, if it is not there; otherwise it must be so
    partitioned, and columns go by name. Rows are brought together by partition before the write, large
    partitions in several files, so a task has few files open. The switch is one commit of the whole write.
    """
    spark = df.sparkSession
    columns = ["`" + c.replace("`", "``") + "`" for c in partition_by]
    rows = df.hint("rebalance", *[F.col(c) for c in columns])
    if not spark.catalog.tableExists(name):
        writer = rows.write.partitionBy(*partition_by)
        (writer.format(format_type) if format_type else writer).saveAsTable(name)
        return
    table = spark.catalog.listColumns(name)
    if [c.name for c in table if c.isPartition] != list(partition_by):
        raise ValueError(f"{name} is not partitioned by {list(partition_by)}")
    if sorted(c.name for c in table) != sorted(df.columns):
        raise ValueError(f"rows of {df.columns} do not fit table {name} of {[c.name for c in table]}")
    ordered = rows.select(*["`" + c.name.replace("`", "``") + "`" for c in table])
    # An insert into a table takes this from the session, not from the writer's options.
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        ordered.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """``n`` rows of ``df``: any, or the first by ``order_by``."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
