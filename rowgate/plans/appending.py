"""Appends that see the keys of earlier runs: several appends give what one run over all inputs gives.

An index beside the clean table holds, for every key, its different tuples: digests of key and row, the raw
values, and the run that brought them. A run joins the digests of its keys with the index and marks
its rows together with what is known of these keys, known tuples as the older ones. A key that was alone
and is not any more takes its row out of the clean table and into quarantine, as a single run would have had it.

The index is bucketed by key, so a join does not shuffle it. Its rows count only if their run is in the table
of runs, which is published together with the clean rows and quarantine; so a run that fails leaves
rows in the index that nobody sees. Taken-out rows cost a rewrite of the files that hold them, and no others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.contract import DUP_KEY, DUP_ROW, REASON, Contract
from rowgate.functions import column, has_key, invalid_flags, null_flags, reason_array
from rowgate.operators.marking import (
    BROADCAST_ROWS,
    KEY_DIGEST,
    NUMBER,
    ROW_DIGEST,
    digest,
    digest_contract,
    digests_of,
    look_up_flags,
    mark_duplicates,
)
from rowgate.staging import Staging

DIGEST = "_digest"
RUN = "run"
BUCKETS = 200

_KNOWN_TUPLES = "known_tuples"


class KeyIndex:
    """The tuples of all whole keys that published runs have brought."""

    def __init__(self, spark: SparkSession, table: str, runs: str, contract: Contract, buckets: int = BUCKETS) -> None:
        self.spark, self.table, self.runs = spark, table, runs
        self.contract, self.buckets = contract, buckets

    def rows(self) -> DataFrame | None:
        """The index's rows of published runs; None before the first run."""
        if not (self.spark.catalog.tableExists(self.table) and self.spark.catalog.tableExists(self.runs)):
            return None
        self.spark.catalog.refreshTable(self.runs)
        return self.spark.table(self.table).join(F.broadcast(self.spark.table(self.runs)), RUN, "left_semi")

    def known(self, digests: DataFrame, staging: Staging, broadcast_rows: int) -> DataFrame | None:
        """``number, key_digest, row_digest`` of the known tuples of these keys; their numbers are negative."""
        rows = self.rows()
        if rows is None:
            return None
        keys = staging.keep(digests.where(F.col(KEY_DIGEST).isNotNull()).select(KEY_DIGEST).distinct(), "keys")
        if keys.count() <= broadcast_rows:
            keys = F.broadcast(keys)
        met = rows.select(KEY_DIGEST, ROW_DIGEST).join(keys, KEY_DIGEST, "left_semi")
        return staging.keep(met.select((-1 - F.monotonically_increasing_id()).alias(NUMBER), KEY_DIGEST, ROW_DIGEST), "known")

    def add(self, firsts: DataFrame) -> str:
        """Write the new tuples under a new run, which counts once it is in the table of runs; returns the run."""
        run = uuid.uuid4().hex
        rows = firsts.withColumn(RUN, F.lit(run))
        rows.repartition(self.buckets, KEY_DIGEST).write.mode("append").bucketBy(self.buckets, KEY_DIGEST).saveAsTable(self.table)
        return run


def mark_with_known(
    rows: DataFrame, contract: Contract, index: KeyIndex, staging: Staging, sizes: dict[str, int]
) -> tuple[DataFrame, DataFrame | None]:
    """The rows with both flags, and ``row_digest`` of known tuples that were alone with their key and are not any more."""
    digests = staging.keep(digests_of(rows, contract), "digests")
    known = index.known(digests, staging, sizes["broadcast_rows"])
    together = digests if known is None else digests.unionByName(known)
    marked, _ = mark_duplicates(together, digest_contract(), staging, **sizes, wide_bytes=1 << 40)
    marked = staging.keep(marked, "marked")
    flagged = marked.where((F.col(NUMBER) >= 0) & (F.col(DUP_ROW) | F.col(DUP_KEY)))
    found, _ = look_up_flags(rows, flagged, contract, staging, sizes["broadcast_rows"])
    if known is None:
        return found, None
    alone = known.groupBy(KEY_DIGEST).agg(F.count(F.lit(1)).alias(_KNOWN_TUPLES)).where(F.col(_KNOWN_TUPLES) == 1)
    clashing = marked.where((F.col(NUMBER) < 0) & F.col(DUP_KEY)).select(KEY_DIGEST, ROW_DIGEST)
    return found, staging.keep(clashing.join(alone, KEY_DIGEST, "left_semi").select(ROW_DIGEST), "taken-out")


def first_tuples(marked: DataFrame, contract: Contract) -> DataFrame:
    """What the index takes: digests, number and raw values of rows with a whole key that are no copies, of known tuples neither."""
    raw = F.struct(*map(column, contract.carried_columns)).alias("raw")
    kept = marked.where(has_key(contract.key) & ~F.col(DUP_ROW))
    keys = digest(marked, contract.key).alias(KEY_DIGEST)
    return kept.select(column(contract.row_id).alias(NUMBER), keys, digest(marked, contract.data_columns).alias(ROW_DIGEST), raw)


def taken_out_records(index: KeyIndex, taken_out: DataFrame, contract: Contract) -> DataFrame:
    """Quarantine rows of known tuples that share their key from now on, raw and with all their reasons."""
    rows = index.rows().join(_small(taken_out), ROW_DIGEST, "left_semi")
    raw = rows.select(F.col(NUMBER).alias(contract.row_id), "raw.*", F.col(ROW_DIGEST).alias(DIGEST))
    flags = {**invalid_flags(contract), **null_flags(contract.key), DUP_KEY: F.lit(True)}
    return raw.select(
        *map(column, [contract.row_id, *contract.carried_columns]), reason_array(flags).alias(REASON), DIGEST
    )


def files_to_rewrite(table: DataFrame, taken_out: DataFrame) -> tuple[list[str], DataFrame]:
    """The files of ``table`` that hold rows to take out, and the other rows of these files.

    A copy that quarantine has as one stays: only the first row of a tuple changes its state.
    """
    goes = F.lit(True)
    if REASON in table.columns:
        goes = ~F.array_contains(REASON, DUP_ROW)
    out = _small(taken_out.select(F.col(ROW_DIGEST).alias(DIGEST), F.lit(True).alias("_rowgate_out")))
    placed = table.withColumn("_rowgate_path", F.col("_metadata.file_path"))
    marked = placed.join(out, DIGEST, "left").withColumn("_rowgate_goes", F.coalesce(F.col("_rowgate_out") & goes, F.lit(False)))
    files = sorted(r[0] for r in marked.where("_rowgate_goes").select("_rowgate_path").distinct().collect())
    stay = marked.where(F.col("_rowgate_path").isin(files) & ~F.col("_rowgate_goes")) if files else marked.where("false")
    return files, stay.select(*map(column, table.columns))


def _small(digests: DataFrame) -> DataFrame:
    return F.broadcast(digests) if digests.count() <= BROADCAST_ROWS else digests
