"""Row-local checks as plain Spark columns: no shuffle, no UDF, inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowgate.contract import BROKEN_LINE, Contract, invalid_flag_name, null_flag_name


def column(name: str) -> Column:
    """A top-level column by its exact name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def fails_format(value: Column, rule: str, null_policy: str = "flag") -> Column:
    """True where ``value`` breaks ``rule``; a null breaks it only under ``flag``. Never null."""
    matches = value.cast("string").rlike(rule)
    if null_policy == "pass":
        return F.coalesce(~matches, F.lit(False))
    return ~F.coalesce(matches, F.lit(False))


def invalid_flags(contract: Contract) -> dict[str, Column]:
    """One flag per checked column, in contract order, behind one for lines that did not fit their header.

    A strict contract wants its rules to match the whole value, and the value to be castable.
    """
    flags = {BROKEN_LINE: column(contract.rescue).isNotNull()} if contract.rescue else {}
    cannot = uncastable(contract)
    for name in contract.checked_columns:
        rule = contract.rule(name)
        if contract.strict:
            rule = rf"\A(?:{rule})\z"
        flag = fails_format(column(name), rule, contract.null_policy)
        flags[invalid_flag_name(name)] = flag | cannot[name] if contract.strict else flag
    return flags


def uncastable(contract: Contract) -> dict[str, Column]:
    """For each checked column, true where a value is there but cannot be cast to the declared type."""
    return {
        name: column(name).isNotNull() & column(name).cast("string").try_cast(contract.columns[name]).isNull()
        for name in contract.checked_columns
    }


def null_flags(key: Sequence[str]) -> dict[str, Column]:
    """One flag per key column."""
    return {null_flag_name(name): column(name).isNull() for name in key}


def has_key(key: Sequence[str]) -> Column:
    """True where no key column is null."""
    return reduce(and_, [column(name).isNotNull() for name in key])


def key_hash(key: Sequence[str]) -> Column:
    """A 64-bit hash of the key; null where a key column is null.

    Equal keys have equal hashes. Different keys may share one, so the hash only ever
    narrows rows down to candidates, which are then compared by value.
    """
    return F.when(has_key(key), F.xxhash64(*[column(name) for name in key]))


def any_flag(flags: Sequence[Column]) -> Column:
    """True where at least one flag is; false for an empty list."""
    return reduce(or_, flags, F.lit(False))


def reason_array(flags: Mapping[str, Column]) -> Column:
    """The names of the true flags of a row, in the order of ``flags``.

    A row without any, which is most of them, gets its empty array without the filtering.
    """
    none = F.array().cast("array<string>")
    if not flags:
        return none
    names = F.array(*[F.when(flag, F.lit(name)) for name, flag in flags.items()])
    return F.when(any_flag(list(flags.values())), F.array_compact(names)).otherwise(none)
