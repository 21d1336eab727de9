"""All checks of a contract at once: every row with the list of reasons it fails.

Format and null checks need nothing but the row. Only duplicates need other rows; their two flags
come from ``operators.marking``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.contract import DUP_KEY, DUP_ROW, REASON, Contract
from rowgate.functions import column, invalid_flags, null_flags, reason_array
from rowgate.operators.marking import BITMAP_ROWS, BROADCAST_ROWS, WIDE_BYTES, WINDOW_ROWS, mark_duplicates
from rowgate.operators.projection import select_data
from rowgate.staging import Staging

_BAD = "_rowgate_bad"


def score(
    df: DataFrame,
    contract: Contract,
    staging: Staging | None = None,
    window_rows: int = WINDOW_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    bitmap_rows: int = BITMAP_ROWS,
    read_twice: bool = False,
    total: int | None = None,
    wide_bytes: int = WIDE_BYTES,
) -> DataFrame:
    """``df`` (row number and data columns) with ``reason``, an array that is empty for a good row.

    The row numbers must be the same each time ``df`` is read: stored ones, or those of
    ``with_file_row_id``.
    Counts the rows, and for a large table keeps hash counts and first copies, before it returns.
    ``read_twice`` says that the caller reads the result more than once: then a result that
    costs a shuffle of the table is kept as well, good and bad rows apart. ``total`` spares the count where
    the number of rows is known.
    """
    staging = staging or Staging(df.sparkSession)
    marked, shuffled = mark_duplicates(
        df, contract, staging, window_rows, broadcast_rows, bitmap_rows, total, wide_bytes
    )
    scored = with_reasons(marked, contract)
    if read_twice and shuffled:
        return staging.keep(scored.withColumn(_BAD, F.size(REASON) > 0), "scored", _BAD)
    return scored


def good(scored: DataFrame, contract: Contract) -> DataFrame:
    """The raw data columns of the rows without a reason."""
    return select_data(scored.where(~_is_bad(scored)), contract)


def bad(scored: DataFrame, contract: Contract) -> DataFrame:
    """The rows with a reason: row number, raw data columns, reasons."""
    return scored.where(_is_bad(scored)).select(
        *map(column, [contract.row_id, *contract.carried_columns]), REASON
    )


def _is_bad(scored: DataFrame) -> Column:
    """A kept result has its rows in two folders, and this reads only one of them."""
    return F.col(_BAD) if _BAD in scored.columns else F.size(REASON) > 0


def reason_counts(scored: DataFrame) -> DataFrame:
    """How many rows carry each reason."""
    return (
        scored.select(F.explode(REASON).alias(REASON))
        .groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def with_reasons(marked: DataFrame, contract: Contract, extra: Sequence[str] = ()) -> DataFrame:
    """Rows with both duplicate flags as rows with ``reason``; ``extra`` columns stay."""
    flags = {
        **invalid_flags(contract),
        **null_flags(contract.key),
        DUP_ROW: F.col(DUP_ROW),
        DUP_KEY: F.col(DUP_KEY),
    }
    return marked.select(
        *map(column, [contract.row_id, *contract.carried_columns]), reason_array(flags).alias(REASON), *extra
    )
