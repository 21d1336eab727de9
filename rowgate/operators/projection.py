"""Column selection and construction driven by a contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowgate.contract import UNCHECKED_TYPE, Contract
from rowgate.functions import column
from rowgate.staging import Staging

# Files whose numbers are broadcast, two longs each (some 100 MB at most), rows a file may then have, and
# how many hash functions are tried on the paths.
BROADCAST_FILES = 2_000_000
FILE_ROW_BITS = 40
SEEDS = 8

_FILE = "_rowgate_file"
_PLACE = "_rowgate_place"
_BEGIN = "_rowgate_begin"
_ROWS = "_rowgate_rows"
_NUMBER = "_rowgate_number"
_PART = "_rowgate_part"


def select_data(df: DataFrame, contract: Contract) -> DataFrame:
    """The declared columns, in declared order."""
    return df.select(*[column(name) for name in contract.data_columns])


def with_row_id(df: DataFrame, contract: Contract) -> DataFrame:
    """A unique row number in front of the declared columns: the row's place in its input partition.

    How a scan is cut into partitions depends on the plan around it, so the number does too. Keep
    the numbered rows (``Staging.keep``) before reading them twice, or use ``with_file_row_id``.
    """
    return df.select(
        F.monotonically_increasing_id().alias(contract.row_id),
        *[column(name) for name in contract.carried_columns],
    )


def with_file_row_id(
    df: DataFrame, contract: Contract, staging: Staging, broadcast_files: int = BROADCAST_FILES
) -> tuple[DataFrame, int] | None:
    """A unique row number in front of the declared columns, made of file and place in it; and how many rows there are.

    It is the same in every plan, however the scan is cut or bucketed. ``df`` must still be a scan of
    parquet files, which number their rows. One pass over the files' row places (no column is read) lists
    the files, as a kept table. Up to ``broadcast_files`` files are numbered in the order of their paths,
    by a distributed sort, and the numbers broadcast under the paths' 64-bit hashes. Of more files the
    hash itself, cut to the bits that row places leave free, is part of the row number: no list is
    needed at all. Hashes are checked once to be different; None if they are not for any of some seeds.
    """
    path, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    files = staging.keep(df.groupBy(path.alias(_FILE)).agg((F.max(place) + 1).alias(_ROWS)), "files")
    number, most, rows = files.agg(F.count(F.lit(1)), F.max(_ROWS), F.sum(_ROWS)).first()
    data = [column(name) for name in contract.carried_columns]
    if number <= broadcast_files:
        bits, shift = 64, FILE_ROW_BITS
    else:
        shift = max(1, (most - 1).bit_length())
        bits = 63 - shift
    seed = next((s for s in range(SEEDS) if _differ(files, number, s, bits)), None)
    if seed is None:
        return None
    if number > broadcast_files:
        begin = F.shiftleft(_hash_of(path, seed, bits), shift)
        return df.select((begin + place).alias(contract.row_id), *data), rows
    numbers = _numbered_files(files, staging).select(
        _hash_of(F.col(_FILE), seed, bits).alias(_FILE), F.shiftleft(_NUMBER, shift).alias(_BEGIN)
    )
    placed = df.select(_hash_of(path, seed, bits).alias(_FILE), place.alias(_PLACE), *data)
    numbered = placed.join(F.broadcast(numbers), _FILE)
    return numbered.select((F.col(_BEGIN) + F.col(_PLACE)).alias(contract.row_id), *map(column, contract.carried_columns)), rows


def _hash_of(path: Column, seed: int, bits: int) -> Column:
    """The top ``bits`` bits of a path's hash."""
    hashed = F.xxhash64(F.lit(seed), path)
    return hashed if bits == 64 else F.shiftrightunsigned(hashed, 64 - bits)


def _differ(files: DataFrame, number: int, seed: int, bits: int) -> bool:
    return files.select(F.count_distinct(_hash_of(F.col(_FILE), seed, bits))).first()[0] == number


def _numbered_files(files: DataFrame, staging: Staging) -> DataFrame:
    """Paths with their place in the order of all: sorted in parts, each after the rows of the parts before it."""
    part, within = F.shiftrightunsigned(_PLACE, 33), F.col(_PLACE).bitwiseAND((1 << 33) - 1)
    ordered = files.select(_FILE).orderBy(_FILE).withColumn(_PLACE, F.monotonically_increasing_id())
    kept = staging.keep(ordered, "files-ordered").withColumn(_PART, part)
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # as many rows as the sort has parts
    parts = kept.groupBy(_PART).agg(F.count(F.lit(1)).alias(_ROWS))
    starts = parts.select(_PART, F.coalesce(F.sum(_ROWS).over(before), F.lit(0)).alias(_BEGIN))
    return kept.join(F.broadcast(starts), _PART).select(_FILE, (F.col(_BEGIN) + within).alias(_NUMBER))


def with_flags(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Add all flags in one projection."""
    return df.withColumns(dict(flags)) if flags else df


def typed(df: DataFrame, contract: Contract, try_cast: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """The declared columns cast to their types, or as they are for an untyped contract.

    The cast is Spark's plain one: in ANSI mode a value that cannot be cast fails the job
    instead of turning into a null. A strict contract has such rows in quarantine already.
    ``try_cast`` makes such values null, for a caller that counts them. ``extra`` columns stay as they are.
    """
    if not contract.typed:
        return df.select(*map(column, [*contract.data_columns, *extra]))

    def cast(name: str, type_name: str) -> Column:
        if type_name == UNCHECKED_TYPE:
            return column(name).cast("string")
        return column(name).try_cast(type_name) if try_cast else column(name).cast(type_name)

    return df.select(*[cast(name, type_name).alias(name) for name, type_name in contract.columns.items()], *extra)
