"""The two jobs: land raw files in a table, split that table into clean and quarantined rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowgate.contract import REASON, Contract
from rowgate.functions import any_flag, column, uncastable
from rowgate.operators import (
    all_duplicates,
    good_records,
    invalid_records,
    merge_reasons,
    nonnull_base,
    null_key_records,
    typed,
    with_file_row_id,
    with_row_id,
)
from rowgate.operators.marking import digest
from rowgate.operators.projection import BROADCAST_FILES
from rowgate.plans import appending, scoring
from rowgate.sources import (
    Staged,
    check_mode,
    detect_format,
    publish,
    read_by_header,
    read_raw,
    read_table,
    recover,
    stage,
    table_names,
    with_file_lineage,
    with_load_time,
    write_table,
)
from rowgate.staging import Staging, file_system


@dataclass
class IngestJob:
    """Scan raw files, add load and lineage columns, write the raw table.

    The format follows from the path's ending unless ``format_type`` names it. ``rescue`` names a column for
    delimited lines with more or fewer fields than their header. ``by_header`` reads delimited files whose
    headers differ by the names in them.
    """

    spark: SparkSession
    pipeline_name: str
    raw_path: str
    table: str | None = None
    delimiter: str = "|"
    header: bool = True
    format_type: str | None = None
    mode: str = "overwrite"
    columns: Sequence[str] | None = None
    options: Mapping[str, object] = field(default_factory=dict)
    loaded_at: datetime | None = None
    rescue: str | None = None
    by_header: bool = False

    def __post_init__(self) -> None:
        self.table = self.table or table_names(self.pipeline_name).bronze
        self.format_type = self.format_type or detect_format(self.raw_path)

    def read(self) -> DataFrame:
        if self.by_header:  # the format can only be a delimited one
            return read_by_header(
                self.spark, self.raw_path, self.delimiter, self.columns, self.options, self.rescue, self._with_audit
            )
        raw = read_raw(
            self.spark,
            self.raw_path,
            format_type=self.format_type,
            delimiter=self.delimiter,
            header=self.header,
            columns=self.columns,
            options=self.options,
            rescue=self.rescue,
        )
        return self._with_audit(raw)

    def _with_audit(self, scan: DataFrame) -> DataFrame:
        return with_file_lineage(with_load_time(scan, "_", self.loaded_at))

    def save(self, df: DataFrame) -> None:
        write_table(df, self.table, self.mode)

    def run(self) -> DataFrame:
        self.save(self.read())
        return read_table(self.spark, self.table)

    def run_new_files(self, checkpoint: str) -> DataFrame:
        """Land the files that no earlier run with this ``checkpoint`` folder has landed, and stop; return the table.

        A file stream keeps in the folder which files it has taken, and the table's own log says which batches
        are in it. So a run that was killed is finished by the next one, and no file lands twice. Delimited
        files all have the columns of ``columns``, or of the first file's header. The table belongs to the
        stream: one that other writes have filled is refused, as its rows would no longer be read.
        """
        if self.by_header:
            raise ValueError("a stream has one header for all files")
        scan = read_raw(
            self.spark, self.raw_path, self.format_type, self.delimiter, self.header, self.columns, self.options, self.rescue
        )
        options = {"sep": self.delimiter, "header": self.header, **self.options}
        if self.format_type == "csv":
            options["enforceSchema"] = False
            if self.rescue:
                options["columnNameOfCorruptRecord"] = self.rescue
        self._check_stream_table()
        stream = self.spark.readStream.format(self.format_type).options(**options).schema(scan.schema).load(self.raw_path)
        writer = self._with_audit(stream).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer.toTable(self.table).awaitTermination()
        self.spark.catalog.refreshTable(self.table)
        return read_table(self.spark, self.table)

    def _check_stream_table(self) -> None:
        if self.spark.catalog.tableExists(self.table):
            found = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").collect()}
            system, log = file_system(self.spark, f"{found.get('Location')}/_spark_metadata")
            if not system.exists(log) and not read_table(self.spark, self.table).isEmpty():
                raise ValueError(f"{self.table} has rows that no stream has written")


@dataclass
class CleanseJob:
    """Check a raw table against a contract and split it into a clean and a quarantine table.

    ``run`` does it in one go. The stage methods give each step's record set on its own; put
    together they select the same rows with the same reasons.

    With ``keep_keys``, appends see the keys of earlier runs, whose tuples they keep in the tables
    ``<good_table>_keys`` and ``<good_table>_runs``: several appends then give what one run over all inputs
    gives, where the rows of a key that more than one tuple has leave the clean table. Both tables have
    a column ``_digest`` more, which tells tuples apart. ``key_buckets`` is the number of files a run adds to
    the table of keys, fixed by the first one.
    """

    spark: SparkSession
    pipeline_name: str
    contract: Contract
    source: str | None = None
    good_table: str | None = None
    bad_table: str | None = None
    mode: str = "overwrite"
    loaded_at: datetime | None = None
    window_rows: int = scoring.WINDOW_ROWS
    broadcast_rows: int = scoring.BROADCAST_ROWS
    bitmap_rows: int = scoring.BITMAP_ROWS
    broadcast_files: int = BROADCAST_FILES
    keep_keys: bool = False
    key_buckets: int = appending.BUCKETS

    def __post_init__(self) -> None:
        names = table_names(self.pipeline_name)
        self.source = self.source or names.bronze
        self.good_table = self.good_table or names.silver
        self.bad_table = self.bad_table or names.bad
        if len({self.source.lower(), self.good_table.lower(), self.bad_table.lower()}) < 3:
            raise ValueError("source, good and bad tables must be three different tables")
        if self.keep_keys and self.mode != "append":
            raise ValueError("keys of earlier runs matter to appends only")

    def read(self, staging: Staging | None = None) -> DataFrame:
        """The declared columns of the raw table behind a unique row number, the same in every plan.

        Rows of a stored parquet table are numbered by file and place in the file, also if it is
        bucketed or partitioned. Rows of any other source are numbered once and written down. What is
        written down goes when the driver ends, or with ``staging`` if that is the caller's.
        """
        return self._numbered(staging or Staging(self.spark))[0]

    def _numbered(self, staging: Staging) -> tuple[DataFrame, int | None]:
        """The numbered rows, and how many they are where that is known."""
        rows = read_table(self.spark, self.source)
        if self.spark.catalog.getTable(self.source).tableType in ("MANAGED", "EXTERNAL"):
            try:
                rows.select("_metadata.row_index")
            except AnalysisException:
                pass  # files of a format that does not number its rows
            else:
                numbered = with_file_row_id(rows, self.contract, staging, self.broadcast_files)
                if numbered is not None:
                    return numbered
        return staging.keep(with_row_id(rows, self.contract), "rows"), None

    def invalid(self, df: DataFrame) -> DataFrame:
        return invalid_records(df, self.contract)

    def null_key(self, df: DataFrame) -> DataFrame:
        return null_key_records(df, self.contract)

    def duplicates(self, df: DataFrame) -> DataFrame:
        return all_duplicates(nonnull_base(df, self.contract), self.contract)

    def quarantine(self, invalid: DataFrame, null_key: DataFrame, duplicates: DataFrame) -> DataFrame:
        return merge_reasons([invalid, null_key, duplicates], self.contract.row_id)

    def good(self, df: DataFrame, bad: DataFrame) -> DataFrame:
        return good_records(df, bad, self.contract)

    def load_good(self, df: DataFrame) -> None:
        """Write good rows: typed if the contract says so, with load time, without row number."""
        write_table(with_load_time(typed(df, self.contract), "", self.loaded_at), self.good_table, self.mode)

    def load_bad(self, df: DataFrame) -> None:
        """Write quarantined rows as they are, raw and with their reasons."""
        write_table(df, self.bad_table, self.mode, even_files=True)

    def run(self) -> tuple[DataFrame, DataFrame]:
        """Score the raw table and publish quarantined and clean rows together; return both tables.

        Both are written before either table is touched, so a fault while writing, or a good value that
        cannot be cast (a ValueError), leaves both as they were. A fault while they are switched is made
        good by the next run, or by ``recover``.
        """
        tables = [self.bad_table, self.good_table]
        self.recover()
        for table in tables:
            check_mode(self.spark, table, self.mode)
        if self.keep_keys:
            return self._run_with_keys()
        with Staging(self.spark) as staging:
            rows, total = self._numbered(staging)
            scored = scoring.score(
                rows,
                self.contract,
                staging,
                window_rows=self.window_rows,
                broadcast_rows=self.broadcast_rows,
                bitmap_rows=self.bitmap_rows,
                read_twice=True,
                total=total,
            )
            bad_rows = stage(scoring.bad(scored, self.contract), self.bad_table, self.mode, even_files=True)
            publish(self.spark, [bad_rows, self._stage_good(scoring.good(scored, self.contract))])
        return read_table(self.spark, self.good_table), read_table(self.spark, self.bad_table)

    def _run_with_keys(self) -> tuple[DataFrame, DataFrame]:
        """``run`` for an append that knows the keys of earlier runs."""
        sizes = {"window_rows": self.window_rows, "broadcast_rows": self.broadcast_rows, "bitmap_rows": self.bitmap_rows}
        shape = self.contract
        index = appending.KeyIndex(self.spark, f"{self.good_table}_keys", f"{self.good_table}_runs", shape, self.key_buckets)
        with Staging(self.spark) as staging:
            rows, _ = self._numbered(staging)
            marked, taken_out = appending.mark_with_known(rows, shape, index, staging, sizes)
            tuples = digest(marked, shape.data_columns).alias(appending.DIGEST)
            told = marked.select("*", tuples)
            scored = scoring.with_reasons(told, shape, [appending.DIGEST])
            scored = staging.keep(scored, "scored")
            good_rows = scored.where(F.size(REASON) == 0)
            bad_rows = scored.where(F.size(REASON) > 0).select(
                *map(column, [shape.row_id, *shape.carried_columns]), REASON, appending.DIGEST
            )
            run = index.add(appending.first_tuples(marked, shape))
            files: dict[str, list[str]] = {}
            stay: dict[str, DataFrame] = {}
            if taken_out is not None and not taken_out.isEmpty():
                for table in (self.good_table, self.bad_table):
                    files[table], stay[table] = appending.files_to_rewrite(read_table(self.spark, table), taken_out)
                bad_rows = bad_rows.unionByName(appending.taken_out_records(index, taken_out, shape))
                bad_rows = bad_rows.unionByName(stay[self.bad_table])
            runs = self.spark.createDataFrame([(run,)], f"{appending.RUN} string").coalesce(1)
            publish(
                self.spark,
                [
                    stage(bad_rows, self.bad_table, "append", even_files=True, remove=files.get(self.bad_table, ())),
                    self._stage_good(good_rows, stay.get(self.good_table), files.get(self.good_table, ())),
                    stage(runs, index.runs, "append"),
                ],
            )
        return read_table(self.spark, self.good_table), read_table(self.spark, self.bad_table)

    def recover(self) -> bool:
        """Finish a publication of both tables that was cut short; says if there was one."""
        tables = [self.bad_table, self.good_table]
        return recover(self.spark, [*tables, f"{self.good_table}_runs"] if self.keep_keys else tables)

    def _stage_good(self, rows: DataFrame, stay: DataFrame | None = None, remove: Sequence[str] = ()) -> Staged | None:
        """Write the good rows, typed and with load time, counting on the way those that the cast would stop for.

        There are such rows in ANSI mode only, and not with a strict contract, which has them in quarantine.
        ``stay`` are rows of the table's files in ``remove`` that are written anew.
        """
        extra = [appending.DIGEST] if self.keep_keys else []

        def staged(checked: DataFrame, try_cast: bool) -> Staged | None:
            loaded = with_load_time(typed(checked, self.contract, try_cast, extra), "", self.loaded_at)
            whole = loaded if stay is None else loaded.unionByName(stay)
            return stage(whole, self.good_table, self.mode, remove=remove)

        ansi = self.spark.conf.get("spark.sql.ansi.enabled", "true").lower() == "true"
        flags = uncastable(self.contract) if self.contract.typed and not self.contract.strict and ansi else {}
        if not flags:
            return staged(rows, False)
        seen, fails = Observation(), any_flag(list(flags.values()))
        example = F.to_json(F.struct(*map(column, self.contract.data_columns)))
        watched = rows.observe(
            seen, F.count_if(fails).alias("rows"), F.max(F.when(fails, example)).alias("example")
        )
        found = staged(watched, True)
        if found and seen.get["rows"]:
            raise ValueError(f"{seen.get['rows']} good rows cannot be cast to the declared types, such as {seen.get['example']}")
        return found
