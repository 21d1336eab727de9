"""What the operators share: fold numbers, kept frames, whole rows carried through, running sums."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence, Sized
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.staging import Staging

ROW = "__row"


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32`` of the id as text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def text_bytes(text: Column) -> Column:
    """A text's UTF-8 bytes, of a null text none."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def carried(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one struct beside ``columns``, so that no name of the input can clash."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame) -> DataFrame:
    """The rows that ``carried`` packed, without what was added."""
    return df.select(f"{ROW}.*")


def staging_for(spark: SparkSession, staging: Staging | None) -> Staging:
    """The caller's folder, or a new one below ``spark.checkpoint.dir`` that lives as long as its result."""
    return staging if staging is not None else Staging(spark)


def sums_before(counts: DataFrame, group: list[str], order: str, value: str, name: str, width: int = 4096) -> DataFrame:
    """``counts`` with ``name``: the sum of ``value`` over the rows of the group with a smaller ``order``.

    ``order`` is a whole number, unique in its group. The sum is taken in two levels, over runs of
    ``width`` numbers and then within a run, so that no task gets all rows of a large group.
    """
    run = F.floor(F.col(order) / width).alias("__run")
    keys = [F.col(c) for c in group]
    runs = counts.groupBy(*keys, run).agg(F.sum(value).alias("__sum"))
    by_group = " AND ".join([f"a.`{c}` <=> b.`{c}`" for c in group] or ["true"])
    from pyspark.sql import Window

    totals = runs.withColumn(
        "__before",
        F.coalesce(
            F.sum("__sum").over(Window.partitionBy(*keys).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).drop("__sum")
    inner = Window.partitionBy(*keys, "__run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.withColumn("__run", run).withColumn("__in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    joined = rows.alias("a").join(totals.alias("b"), F.expr(f"{by_group} AND a.__run = b.__run"))
    return joined.select("a.*", (F.col("a.__in") + F.col("b.__before")).cast("long").alias(name)).drop("__run", "__in")


def give_back() -> None:
    """Give memory that a Python worker has freed back to the machine; it otherwise keeps it through all later stages."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # a C library without it keeps what it has
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``rows`` for ``mapInArrow``, whose worker gives back what it has freed at the end of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        give_back()

    return run


def binaries(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The bytes of a binary or string column as a list, nulls as empty bytes."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def lots(texts: Sequence[Sized], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring texts with lengths of ``limit`` at most together; a longer text stands alone."""
    start, held = 0, 0
    for i, n in enumerate(map(len, texts)):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)
