"""Raw file scans with load and lineage columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File endings whose Spark format has another name, and compression endings.
FORMAT_OF_ENDING = {"txt": "csv", "tsv": "csv", "psv": "csv"}
COMPRESSION_ENDINGS = ("gz", "bz2", "zst", "lz4", "snappy", "deflate")

# Lineage column -> field of the hidden file metadata.
LINEAGE_FIELDS = {
    "_file_name": "file_name",
    "_file_path": "file_path",
    "_file_size": "file_size",
    "_file_mod": "file_modification_time",
}


# Files whose headers are read at the same time.
HEADERS_AT_A_TIME = 16


def detect_format(path: str) -> str:
    """The Spark format a path's ending stands for, looking past a compression ending."""
    parts = path.rstrip("/").rsplit("/", 1)[-1].lower().split(".")[1:]
    while parts and parts[-1] in COMPRESSION_ENDINGS:
        parts.pop()
    if not parts or not parts[-1].isalnum():
        raise ValueError(f"no file ending in {path!r}: name the format")
    return FORMAT_OF_ENDING.get(parts[-1], parts[-1])


def read_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    format_type: str | None = None,
    delimiter: str = "|",
    header: bool = True,
    columns: Sequence[str] | None = None,
    options: Mapping[str, object] | None = None,
    rescue: str | None = None,
) -> DataFrame:
    """Scan raw files; a delimited file gives nothing but nullable strings.

    The format comes from the path's ending unless named. ``columns`` declares the delimited
    columns up front, which spares the look at the first header; otherwise that header names them.
    Either way every delimited file's header must name the same columns in the same order, or the
    scan fails: Spark would go by position and put values under the wrong names (``read_by_header`` goes
    by name). ``rescue`` names a further column for a delimited line that has more or fewer fields than
    the header, as it is in the file; without it spare fields are dropped and lacking ones null, unmarked.
    """
    first = path if isinstance(path, str) else path[0]
    format_type = format_type or detect_format(first)
    reader = spark.read.format(format_type).option("sep", delimiter).option("header", header)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    paths = path if isinstance(path, str) else list(path)
    if columns is None:
        scan = reader.load(paths)
        if format_type != "csv" or not scan.columns or not (header or rescue):
            return scan
        columns = scan.columns
    return _strings(reader, columns, rescue).load(paths)


def _strings(reader: DataFrameReader, columns: Sequence[str], rescue: str | None) -> DataFrameReader:
    """A reader of string columns that checks headers, and keeps lines that do not fit."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    if rescue:
        schema = schema.add(rescue, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", rescue).option("mode", "PERMISSIVE")
    return reader.schema(schema).option("enforceSchema", False)


def read_by_header(
    spark: SparkSession,
    path: str,
    delimiter: str = "|",
    columns: Sequence[str] | None = None,
    options: Mapping[str, object] | None = None,
    rescue: str | None = None,
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Scan delimited files whose headers name columns in different orders, or lack some: values go by name.

    Files are grouped by their header, and each group is one scan. The columns are those of ``columns``, or
    all that any header names, in order of the most common header first; where a file lacks one, it is null. A
    file without a line gives no row. ``each`` is applied to every group's scan, where file metadata can still
    be read (``with_file_lineage``). The headers cost a look at the first line of every file, before the scan.
    """
    reader = spark.read.option("sep", delimiter).option("header", True)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    groups = _headers(spark, path, delimiter, options or {})
    names = list(columns) if columns is not None else list(dict.fromkeys(n for header, _ in groups for n in header))
    scans = []
    for header, files in groups:
        scan = _strings(reader.format("csv"), header, rescue).load(files)
        lacking = {name: F.lit(None).cast("string") for name in names if name not in header}
        scan = (each(scan) if each else scan).withColumns(lacking)
        rest = [c for c in scan.columns if c not in names and c not in header]
        scans.append(scan.select(*[scan["`" + c.replace("`", "``") + "`"] for c in (*names, *rest)]))
    if not scans:
        raise ValueError(f"no delimited file with a header in {path!r}")
    return reduce(DataFrame.unionByName, scans)


def _headers(spark: SparkSession, path: str, delimiter: str, options: Mapping[str, object]) -> list[tuple[list[str], list[str]]]:
    """Each header that files of ``path`` have, the most common first, with those files.

    The reader itself tells a file's header, from its first line; several files are asked at a time.
    """

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**options).csv(file, sep=delimiter, header=True).columns)

    files = sorted(spark.read.text(path).inputFiles())
    by_header: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_A_TIME) as pool:
        for names, file in zip(pool.map(header, files), files, strict=True):
            if names:
                by_header.setdefault(names, []).append(file)
    return sorted(((list(names), found) for names, found in by_header.items()), key=lambda group: (-len(group[1]), group[0]))


def with_load_time(df: DataFrame, prefix: str = "", loaded_at: datetime | None = None) -> DataFrame:
    """Add ``<prefix>load_dt`` and ``<prefix>load_dttm``: now, or a time given for the whole run."""
    moment = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
    day = F.current_date() if loaded_at is None else F.to_date(moment)
    return df.withColumns({f"{prefix}load_dt": day, f"{prefix}load_dttm": moment})


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Add where each row came from. ``df`` must still be a file scan: the metadata is hidden in it."""
    return df.withColumns({name: F.col(f"_metadata.{field}") for name, field in LINEAGE_FIELDS.items()})
