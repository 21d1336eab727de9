"""Which rows are copies, and which share a key: both flags for every row of a table.

The plan depends on sizes that are counted first, never guessed. A table of at most ``window_rows``
rows takes one exchange by key and two windows over it: no
group can be larger than the table. In a larger table one key, or one set of copies, may hold
much of it. So the keys are hashed and the hashes counted, which reads the key columns and
shuffles 8-byte numbers, combined before the shuffle. The counts sort the rows into three kinds:

* A row whose hash is alone has no duplicate of either kind.
* Rows of keys to look up: all repeated keys if they are few enough to broadcast their hashes,
  else only the keys of more than ``window_rows`` rows, which are few in any table. Their first
  copies and clashing keys come from aggregates that combine before the shuffle. Then each row
  is looked up by its unique number: not a first copy means a row duplicate, a first copy of a
  clashing key a key duplicate. No step brings the rows of a key together.
* The rest, if any, takes the windows: their keys have at most ``window_rows`` rows each. Rows
  whose hash is not in a broadcast bitmap of the repeated ones, 128 MB at most, are alone and
  stay out. The few others it lets through by accident do no harm.

Wide rows (texts) do not meet at all. Their keys and their whole tuples become SHA-256 digests; the digests, rows
of some 80 bytes, are kept and marked by the same plan, and the numbers of the marked rows are looked up. So
whatever is sorted or grouped is bounded in bytes as it is in rows. Two tuples with one SHA-256 digest are not
known to anyone, so digests that meet are taken for equal tuples.

So a table with few repeated keys is never shuffled, of any other at most all rows once, large
keys apart. Hash counts and first copies are kept in the shared folder; their rows have a fixed
width, so a row count proves their size before anything is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowgate.contract import DUP_KEY, DUP_ROW, UNCHECKED_TYPE, Contract
from rowgate.functions import column, has_key, key_hash
from rowgate.staging import Staging

# A group of this many rows is a sort one task can do.
WINDOW_ROWS = 1 << 20
# A partition of this many rows, as large as one group may be.
PARTITION_ROWS = 1 << 20
# Rows of two longs at most: some 100 MB as a broadcast hash table.
BROADCAST_ROWS = 2_000_000

# Rows of more bytes on average, by the optimizer's estimate, are marked by their digests.
WIDE_BYTES = 512
LEAST_WIDE_ROWS = 128

# The bitmap of repeated hashes: this many rows of 4096 bytes.
BITMAP_ROWS = 1 << 15
BITS_PER_ROW = 4096 * 8

_HASH = "_rowgate_key_hash"
_CANDIDATE = "_rowgate_candidate"
_CLASH = "_rowgate_clash"
_COUNT = "_rowgate_count"
_LONE = "_rowgate_lone"
_FIRST = "_rowgate_first"
_TUPLES = "_rowgate_tuples"
_SPREAD = "_rowgate_spread"
_BUCKET = "_rowgate_bucket"
_BIT = "_rowgate_bit"
_BITMAP = "_rowgate_bitmap"
_MAYBE = "_rowgate_maybe"
# Names of a table of digests, which has a contract of its own.
KEY_DIGEST, ROW_DIGEST, NUMBER = "key_digest", "row_digest", "number"


def mark_duplicates(
    df: DataFrame,
    contract: Contract,
    staging: Staging | None = None,
    window_rows: int = WINDOW_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    bitmap_rows: int = BITMAP_ROWS,
    total: int | None = None,
    wide_bytes: int = WIDE_BYTES,
) -> tuple[DataFrame, bool]:
    """``df`` (row number and data columns) with both duplicate flags, and whether that shuffles its rows.

    The row numbers must be the same each time ``df`` is read. Counts the rows unless ``total`` gives
    their number, and for a large table keeps hash counts and first copies, before it returns. Rows of over
    ``wide_bytes`` bytes by the optimizer's estimate are marked by digests; the result is the same.
    """
    staging = staging or Staging(df.sparkSession)
    rows = df.select(*map(column, [contract.row_id, *contract.carried_columns]))
    total = rows.count() if total is None else total
    if _estimated_bytes(rows) > wide_bytes * max(total, LEAST_WIDE_ROWS) and _have_digests(rows, contract):
        return _mark_by_digests(rows, contract, staging, total, window_rows, broadcast_rows, bitmap_rows)
    if total <= window_rows:
        return _mark_by_windows(rows, contract, total), True
    # Fewer than ``broadcast_rows`` keys can be larger than this.
    large = max(window_rows, -(-total // broadcast_rows))
    return _mark_large_table(rows, contract, staging, total, large, broadcast_rows, bitmap_rows)


def _estimated_bytes(rows: DataFrame) -> int:
    return int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _have_digests(rows: DataFrame, contract: Contract) -> bool:
    """Nested values have no text that tells all of them apart."""
    return not any(isinstance(rows.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType)) for name in contract.data_columns)


def digest(rows: DataFrame, names: Sequence[str]) -> Column:
    """SHA-256 of the values of some columns, each behind its length, so that no two tuples read the same; null equals null."""

    def told(name: str) -> Column:
        value = column(name)
        kind = rows.schema[name].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0).cast(kind)  # one zero, not two
        data = value if isinstance(kind, T.BinaryType) else value.cast("string").cast("binary")
        return F.coalesce(F.concat(F.octet_length(data).cast("string").cast("binary"), F.lit(b":"), data), F.lit(b"n"))

    return F.unhex(F.sha2(F.concat(*map(told, names)), 256))


def digest_contract() -> Contract:
    """The shape of a table of digests."""
    return Contract({KEY_DIGEST: UNCHECKED_TYPE, ROW_DIGEST: UNCHECKED_TYPE}, [KEY_DIGEST], row_id=NUMBER)


def digests_of(rows: DataFrame, contract: Contract) -> DataFrame:
    """``number, key_digest, row_digest`` of each row; the key's is null unless the key is whole."""
    return rows.select(
        column(contract.row_id).alias(NUMBER),
        F.when(has_key(contract.key), digest(rows, contract.key)).alias(KEY_DIGEST),
        digest(rows, contract.data_columns).alias(ROW_DIGEST),
    )


def _mark_by_digests(
    rows: DataFrame,
    contract: Contract,
    staging: Staging,
    total: int,
    window_rows: int,
    broadcast_rows: int,
    bitmap_rows: int,
) -> tuple[DataFrame, bool]:
    """Marks digests of the same rows and looks the marked row numbers up."""
    kept = staging.keep(digests_of(rows, contract), "digests")
    marked, _ = mark_duplicates(
        kept, digest_contract(), staging, window_rows, broadcast_rows, bitmap_rows, total, wide_bytes=1 << 40
    )
    return look_up_flags(rows, marked.where(F.col(DUP_ROW) | F.col(DUP_KEY)), contract, staging, broadcast_rows)


def look_up_flags(
    rows: DataFrame, flagged: DataFrame, contract: Contract, staging: Staging, broadcast_rows: int
) -> tuple[DataFrame, bool]:
    """``rows`` with both flags, from those of the marked ``number`` s; and whether that shuffles the rows."""
    flagged = flagged.select(column(NUMBER).alias(contract.row_id), DUP_ROW, DUP_KEY)
    flagged = staging.keep(flagged, "flagged")
    few = flagged.count() <= broadcast_rows
    found = rows.join(F.broadcast(flagged) if few else flagged.hint("merge"), [contract.row_id], "left")
    return found.withColumns({name: F.coalesce(name, F.lit(False)) for name in (DUP_ROW, DUP_KEY)}), not few


def first_copies(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per distinct tuple of the data columns (null equals null): the lowest numbered copy."""
    return (
        df.groupBy(*map(column, contract.data_columns))
        .agg(F.min(column(contract.row_id)).alias(contract.row_id))
        .select(*map(column, [contract.row_id, *contract.data_columns]))
    )


def lone_copies(firsts: DataFrame, contract: Contract) -> DataFrame:
    """Row numbers of those first copies whose key no other tuple has."""
    return (
        firsts.groupBy(*map(column, contract.key))
        .agg(F.min(column(contract.row_id)).alias(contract.row_id), F.count(F.lit(1)).alias(_COUNT))
        .where(F.col(_COUNT) == 1)
        .select(column(contract.row_id))
    )


def _mark_by_windows(rows: DataFrame, contract: Contract, total: int) -> DataFrame:
    """One exchange and one sort: rows partitioned by key are also partitioned by key and the rest.

    Rows without a whole key cannot be duplicates and may be many; their own number spreads them.
    A table of ``total`` rows beyond what the session's partitions should take gets more of them.
    """
    parts = -(-total // PARTITION_ROWS)
    session = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    more = [parts] if parts > session else []
    whole = has_key(contract.key)
    key = [*map(column, contract.key), F.col(_SPREAD)]
    rest = [column(name) for name in contract.data_columns if name not in contract.key]
    first = F.row_number().over(W.partitionBy(*key, *rest).orderBy(column(contract.row_id))) == 1
    tuples = F.count_if(_FIRST).over(W.partitionBy(*key))
    return (
        rows.withColumn(_SPREAD, F.when(~whole, column(contract.row_id)))
        .repartition(*more, *key)
        .withColumn(_FIRST, first)
        .withColumn(_TUPLES, tuples)
        .select(
            *map(column, rows.columns),
            (whole & ~F.col(_FIRST)).alias(DUP_ROW),
            (whole & F.col(_FIRST) & (F.col(_TUPLES) > 1)).alias(DUP_KEY),
        )
    )


def _mark_large_table(
    rows: DataFrame,
    contract: Contract,
    staging: Staging,
    total: int,
    large: int,
    broadcast_rows: int,
    bitmap_rows: int,
) -> tuple[DataFrame, bool]:
    """The rows with both duplicate flags, and if that takes a shuffle of table rows."""
    repeated = staging.keep(_repeated_hashes(rows, contract), "repeated")
    repeated_keys = repeated.count()
    if repeated_keys == 0:
        return rows.withColumns(_no_duplicates()), False
    few = repeated_keys <= broadcast_rows
    # With an eighth of its bits set, a bitmap lets through an eighth of the rows that are alone.
    bitmap_tells = repeated_keys <= bitmap_rows * BITS_PER_ROW // 8
    looked_up_keys = repeated if few else repeated.where(F.col(_COUNT) > large)

    def mark_others(others: DataFrame) -> DataFrame:
        if few:
            return others.withColumns(_no_duplicates())
        if not bitmap_tells:
            return _mark_by_windows(others, contract, total)
        parted = _mark_maybe_repeated(others, contract, repeated, bitmap_rows)
        windowed = _mark_by_windows(parted.where(_MAYBE).drop(_MAYBE), contract, total)
        alone = parted.where(~F.col(_MAYBE)).drop(_MAYBE).withColumns(_no_duplicates())
        return windowed.unionByName(alone)

    if looked_up_keys.isEmpty():
        return mark_others(rows), True
    parted = _mark_candidates(rows, contract, looked_up_keys)
    firsts = staging.keep(_first_copy_clashes(parted.where(_CANDIDATE), contract), "firsts")
    narrow = firsts.count() <= broadcast_rows
    if few and narrow:
        return _look_up(parted, F.broadcast(firsts), contract), False
    # The merge hint keeps the optimizer from a broadcast by compressed file size.
    looked_up = _look_up(
        parted.where(_CANDIDATE), F.broadcast(firsts) if narrow else firsts.hint("merge"), contract
    )
    return looked_up.unionByName(mark_others(parted.where(~F.col(_CANDIDATE)).drop(_CANDIDATE))), True


def _no_duplicates() -> dict[str, Column]:
    return {DUP_ROW: F.lit(False), DUP_KEY: F.lit(False)}


def _repeated_hashes(rows: DataFrame, contract: Contract) -> DataFrame:
    hashes = rows.select(key_hash(contract.key).alias(_HASH)).where(F.col(_HASH).isNotNull())
    return hashes.groupBy(_HASH).agg(F.count(F.lit(1)).alias(_COUNT)).where(F.col(_COUNT) > 1)


def _mark_candidates(rows: DataFrame, contract: Contract, hashes: DataFrame) -> DataFrame:
    lookup = F.broadcast(hashes.select(_HASH, F.lit(True).alias(_CANDIDATE)))
    marked = rows.withColumn(_HASH, key_hash(contract.key)).join(lookup, [_HASH], "left").drop(_HASH)
    return marked.withColumn(_CANDIDATE, F.coalesce(_CANDIDATE, F.lit(False)))


def _mark_maybe_repeated(
    rows: DataFrame, contract: Contract, repeated: DataFrame, bitmap_rows: int
) -> DataFrame:
    """True for every row whose key hash is repeated, and for some others that share its bit."""

    def bucket_and_bit(key: Column) -> tuple[Column, Column]:
        place = F.pmod(key, F.lit(bitmap_rows * BITS_PER_ROW))
        return F.bitmap_bucket_number(place), F.bitmap_bit_position(place)

    bucket, bit = bucket_and_bit(F.col(_HASH))
    # Brought together as hashes: a bitmap begun in every task would be larger than they are.
    hashes = repeated.select(bucket.alias(_BUCKET), bit.alias(_BIT)).repartition(_BUCKET)
    bitmaps = hashes.groupBy(_BUCKET).agg(F.bitmap_construct_agg(_BIT).alias(_BITMAP)).withColumn(_BITMAP, _as_words(F.col(_BITMAP)))
    bucket, bit = bucket_and_bit(key_hash(contract.key))
    within = (bit % 32).cast("int")
    word = F.get(_BITMAP, F.floor(bit / 32).cast("int"))
    # The first of a word's four bytes is its highest, the first of a byte's bits its lowest.
    is_set = F.getbit(word, (3 - F.floor(within / 8).cast("int")) * 8 + within % 8) == 1
    return (
        rows.withColumn(_BUCKET, bucket)
        .join(F.broadcast(bitmaps), [_BUCKET], "left")
        .withColumn(_MAYBE, F.coalesce(is_set, F.lit(False)))
        .drop(_BUCKET, _BITMAP)
    )


def _as_words(bitmap: Column) -> Column:
    """A bitmap's bytes as 32-bit numbers, made once for each bitmap so that testing a bit is arithmetic."""

    def word(i: Column) -> Column:
        value = F.conv(F.hex(F.substring(bitmap, i * 4 + 1, F.lit(4))), 16, 10).cast("long")
        return F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(BITS_PER_ROW // 32 - 1)), word)


def _look_up(parted: DataFrame, firsts: DataFrame, contract: Contract) -> DataFrame:
    flags = {
        DUP_ROW: F.col(_CANDIDATE) & F.col(_CLASH).isNull(),
        DUP_KEY: F.coalesce(_CLASH, F.lit(False)),
    }
    return parted.join(firsts, [contract.row_id], "left").withColumns(flags).drop(_CANDIDATE, _CLASH)


def _first_copy_clashes(candidates: DataFrame, contract: Contract) -> DataFrame:
    firsts = first_copies(candidates.drop(_CANDIDATE), contract)
    lone = lone_copies(firsts, contract).withColumn(_LONE, F.lit(True))
    return firsts.select(column(contract.row_id)).join(lone, [contract.row_id], "left").select(
        column(contract.row_id), F.col(_LONE).isNull().alias(_CLASH)
    )
