"""Record sets of each check, and what is left without them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from rowgate.contract import REASON, Contract
from rowgate.functions import any_flag, column, has_key, invalid_flags, null_flags, reason_array


def invalid_records(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that break a format rule, with one reason per broken column."""
    return _failing(df, contract, invalid_flags(contract))


def null_key_records(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows with a null in the key, with one reason per null key column."""
    return _failing(df, contract, null_flags(contract.key))


def _failing(df: DataFrame, contract: Contract, flags: Mapping[str, Column]) -> DataFrame:
    """The rows with any true flag and the names of those: decided on the row alone, without a shuffle."""
    ids = map(column, [contract.row_id, *contract.carried_columns])
    return df.where(any_flag(list(flags.values()))).select(*ids, reason_array(flags).alias(REASON))


def rows_without(df: DataFrame, taken: DataFrame, row_id: str) -> DataFrame:
    """``df`` minus the rows whose number is in ``taken``: an anti join on a unique number."""
    return df.join(taken.select(column(row_id)), [row_id], "left_anti")


def nonnull_base(df: DataFrame, contract: Contract) -> DataFrame:
    """The input of the duplicate checks: rows whose key is whole, format errors included.

    The same rows as ``rows_without(df, null_key_records(...))``, by a filter instead of a join.
    """
    return df.where(has_key(contract.key))


def good_records(df: DataFrame, bad: DataFrame, contract: Contract) -> DataFrame:
    """The rows no check has failed, still raw."""
    return rows_without(df, bad, contract.row_id)

