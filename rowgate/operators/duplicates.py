"""Copies of whole rows and rows that share a key, safe for groups of any size.

The record sets filter rows that ``marking`` has flagged in one pass, and the two numbering
operators cut groups that are too large for one task into slices.
All functions take rows whose key is whole (``nonnull_base``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowgate.contract import DUP_KEY, DUP_ROW, REASON, Contract
from rowgate.functions import column
from rowgate.operators.marking import BROADCAST_ROWS, mark_duplicates
from rowgate.staging import Staging

# A group of more rows than this is cut into slices; row numbers are unique, so a slice of
# 2**SLICE_BITS consecutive numbers holds at most that many rows.
SLICE_BITS = 20
ROW_ID_BITS = 63
NUMBER = "rn"

_HASH = "_rowgate_hash"
_LARGE = "_rowgate_large"
_SLICE = "_rowgate_slice"
_SLICES = "_rowgate_slices"
_PLACE = "_rowgate_place"
_BLOCK = "_rowgate_block"
_COUNT = "_rowgate_count"
_BEFORE = "_rowgate_before"


def row_duplicates(df: DataFrame, contract: Contract, staging: Staging | None = None) -> DataFrame:
    """Every copy of a row but the first."""
    marked, _ = mark_duplicates(df, contract, staging)
    return _records(marked.where(DUP_ROW), contract)


def key_duplicates(df: DataFrame, contract: Contract, staging: Staging | None = None) -> DataFrame:
    """Without the later copies: all rows of a key that still has more than one. None survives."""
    marked, _ = mark_duplicates(df, contract, staging)
    return _records(marked.where(DUP_KEY), contract)


def all_duplicates(df: DataFrame, contract: Contract, staging: Staging | None = None) -> DataFrame:
    """Row and key duplicates together, in one pass; no row is in both."""
    marked, _ = mark_duplicates(df, contract, staging)
    return _records(marked.where(F.col(DUP_ROW) | F.col(DUP_KEY)), contract)


def _records(marked: DataFrame, contract: Contract) -> DataFrame:
    reason = F.when(F.col(DUP_ROW), DUP_ROW).otherwise(DUP_KEY)
    return marked.select(*map(column, [contract.row_id, *contract.carried_columns]), F.array(reason).alias(REASON))


def copy_numbers(
    df: DataFrame,
    columns: Sequence[str],
    row_id: str,
    slice_bits: int = SLICE_BITS,
    row_id_bits: int = ROW_ID_BITS,
) -> DataFrame:
    """Add ``rn``: 1, 2, 3 ... within each group of equal ``columns``, in ``row_id`` order.

    Needs unique, non-negative row numbers. Groups are counted by hash first. If none has over
    2**slice_bits rows, one window numbers them all. A larger group is numbered slice by slice,
    each slice starting after the rows counted in the slices before it.
    """
    group = [column(name) for name in columns]
    number = column(row_id)
    large, some = _large_groups(df, group, 1 << slice_bits)
    if not some:
        return df.withColumn(NUMBER, F.row_number().over(W.partitionBy(*group).orderBy(number)).cast("long"))
    large = large.select(_HASH, F.lit(True).alias(_LARGE))
    rows = df.withColumn(_HASH, F.xxhash64(*group)).join(_small(large, some), _HASH, "left")
    rows = rows.withColumn(_SLICE, F.when(F.col(_LARGE), F.shiftright(number, slice_bits)).otherwise(-1))
    slices = rows.where(F.col(_LARGE)).groupBy(*group, _SLICE).agg(F.count(F.lit(1)).alias(_COUNT))
    heads = _counted_before(
        slices.withColumnRenamed(_SLICE, _PLACE), columns, row_id_bits - slice_bits, slice_bits
    )
    heads = heads.select(*group, F.col(_PLACE).alias(_SLICE), _BEFORE)
    # A slice's head has no row number, so it sorts first and is not counted.
    in_slice = W.partitionBy(*group, _SLICE).orderBy(number.asc_nulls_first())
    place = F.count(number).over(in_slice) + F.coalesce(F.max(_BEFORE).over(in_slice), F.lit(0))
    return (
        rows.drop(_HASH, _LARGE)
        .unionByName(heads, allowMissingColumns=True)
        .withColumn(NUMBER, place)
        .where(number.isNotNull())
        .drop(_SLICE, _BEFORE)
    )


def key_counts(
    df: DataFrame, key: Sequence[str], row_id: str, large_rows: int = 1 << SLICE_BITS
) -> DataFrame:
    """Add ``rn``: how many rows share the row's ``key``.

    Keys are counted by hash first. If none has over ``large_rows`` rows, one window counts them
    all. A larger key is counted by an aggregate, and its total is handed to as many slices of its
    rows as it takes to keep each near ``large_rows``.
    """
    group = [column(name) for name in key]
    number = column(row_id)
    large, some = _large_groups(df, group, large_rows)
    if not some:
        return df.withColumn(NUMBER, F.count(F.lit(1)).over(W.partitionBy(*group)))
    large = large.select(_HASH, F.ceil(F.col(_COUNT) / large_rows).alias(_SLICES))
    rows = df.withColumn(_HASH, F.xxhash64(*group)).join(_small(large, some), _HASH, "left")
    any_slice = F.pmod(F.xxhash64(number), F.col(_SLICES))
    rows = rows.withColumn(_SLICE, F.when(F.col(_SLICES).isNotNull(), any_slice).otherwise(-1))
    totals = (
        rows.where(F.col(_SLICES).isNotNull()).groupBy(*group, _SLICES).agg(F.count(F.lit(1)).alias(_COUNT))
    )
    heads = totals.select(
        *group, F.explode(F.sequence(F.lit(0), F.col(_SLICES) - 1)).alias(_SLICE), _COUNT
    )
    in_slice = W.partitionBy(*group, _SLICE)
    total = F.coalesce(F.max(_COUNT).over(in_slice), F.count(number).over(in_slice))
    return (
        rows.drop(_HASH, _SLICES)
        .unionByName(heads, allowMissingColumns=True)
        .withColumn(NUMBER, total)
        .where(number.isNotNull())
        .drop(_SLICE, _COUNT)
    )


def _large_groups(df: DataFrame, group: Sequence[Column], rows: int) -> tuple[DataFrame, int]:
    """Hashes of the groups with more than ``rows`` rows and how many rows they have; and their number."""
    hashes = df.select(F.xxhash64(*group).alias(_HASH))
    large = hashes.groupBy(_HASH).agg(F.count(F.lit(1)).alias(_COUNT)).where(F.col(_COUNT) > rows)
    return large, large.count()


def _small(large: DataFrame, some: int) -> DataFrame:
    """``large`` to be broadcast if its ``some`` rows of two numbers are few enough, else joined by a shuffle."""
    return F.broadcast(large) if some <= BROADCAST_ROWS else large.hint("merge")


def _counted_before(counts: DataFrame, columns: Sequence[str], bits: int, slice_bits: int) -> DataFrame:
    """Add to (columns, place, count) the sum of the counts at the group's lower places.

    Places have up to ``bits`` bits. They are summed block by block, and blocks the same way
    one level up, so no window holds more than 2**slice_bits + 1 rows.
    """
    group = [column(name) for name in columns]
    earlier = W.orderBy(F.col(_PLACE).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    if bits <= slice_bits:
        before = F.sum(_COUNT).over(earlier.partitionBy(*group))
        return counts.withColumn(_BEFORE, F.coalesce(before, F.lit(0)))
    blocks = counts.withColumn(_BLOCK, F.shiftright(_PLACE, slice_bits))
    totals = blocks.groupBy(*group, _BLOCK).agg(F.sum(_COUNT).alias(_COUNT))
    starts = _counted_before(
        totals.withColumnRenamed(_BLOCK, _PLACE), columns, bits - slice_bits, slice_bits
    )
    # A block's head carries the rows before the block and stands before its first place.
    heads = starts.select(
        *group,
        F.lit(None).cast("long").alias(_PLACE),
        F.col(_BEFORE).alias(_COUNT),
        F.col(_PLACE).alias(_BLOCK),
    )
    return (
        blocks.unionByName(heads)
        .withColumn(_BEFORE, F.sum(_COUNT).over(earlier.partitionBy(*group, _BLOCK)))
        .where(F.col(_PLACE).isNotNull())
        .drop(_BLOCK)
    )
