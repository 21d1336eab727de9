"""Several tables published together: all rows are written first, then every table is switched by metadata.

``stage`` writes a table's rows to a folder of their own, which no reader sees. ``publish`` notes in a
journal what is to be switched, switches table after table, and removes the journal. A fault before the
journal leaves all tables as they were. After it, ``recover`` finishes the switch: each step can be
repeated, and the rows are there. So the tables are never left at different runs for good.

A published table is an external one whose location is the folder of its version. Replacing it
sets another location; appending renames the folder of the new rows into the version's, one step
whatever the number of files. The version before the current one is kept for readers that have begun.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowgate.sources.tables import WRITE_MODES
from rowgate.staging import file_system

VERSIONS, JOURNALS = "_versions", "_rowgate_publish"
NESTED = "recursiveFileLookup"


@dataclass(frozen=True)
class Staged:
    """Rows written for a table: where they are and how they get into it."""

    table: str
    folder: str
    replace: bool
    format_type: str
    schema: str
    remove: tuple[str, ...] = ()


def stage(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    format_type: str | None = None,
    even_files: bool = False,
    remove: Sequence[str] = (),
) -> Staged | None:
    """Write ``df`` for ``table`` without touching it; None if the mode is ``ignore`` and the table is there.

    ``remove`` names files of the table that go when an append is published: ``df`` has their rows that stay.

    Rows for an existing table must have its columns, in any order. Partitioned and bucketed tables
    and views cannot be appended to this way.
    """
    check_mode(df.sparkSession, table, mode)
    spark, there = df.sparkSession, _described(df.sparkSession, table)
    if there and mode == "ignore":
        return None
    format_type = format_type or spark.conf.get("spark.sql.sources.default")
    replace = not there or mode == "overwrite"
    if not replace:
        df = _fitted(df, table, there)
        format_type = there["Provider"].lower()
    folder = f"{_versions(spark, table)}/{uuid.uuid4().hex}"
    rows = df.hint("rebalance") if even_files else df
    rows.write.format(format_type).save(folder)
    return Staged(table, folder, replace, format_type, df.schema.json(), tuple(remove))


def check_mode(spark: SparkSession, table: str, mode: str) -> None:
    """What a write would stop for, before anything is computed."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    if mode in ("error", "errorifexists") and spark.catalog.tableExists(table):
        raise ValueError(f"table {table} is already there")


def publish(spark: SparkSession, staged: Sequence[Staged | None]) -> None:
    """Switch all tables to what was staged for them, or have ``recover`` do it after a fault."""
    staged = [one for one in staged if one]
    if not staged:
        return
    journal = _journal(spark, [one.table for one in staged])
    _write(spark, journal, json.dumps([asdict(one) for one in staged]))
    _finish(spark, journal, staged)


def recover(spark: SparkSession, tables: Sequence[str]) -> bool:
    """Finish a publication of these tables that a fault has cut short; says if there was one."""
    journal = _journal(spark, tables)
    system, path = file_system(spark, journal)
    if not system.exists(path):
        return False
    text = spark.read.text(journal, wholetext=True).first()[0]
    _finish(spark, journal, [Staged(**one) for one in json.loads(text)])
    return True


def _finish(spark: SparkSession, journal: str, staged: Sequence[Staged]) -> None:
    before = {one.table: (_described(spark, one.table) or {}).get("Location") for one in staged}
    for one in staged:
        _switch(spark, one)
    system, path = file_system(spark, journal)
    system.delete(path, False)
    for one in staged:
        if one.replace:
            _prune(spark, one, before[one.table])


def _switch(spark: SparkSession, one: Staged) -> None:
    """Bring one table to its staged rows; done again, it changes nothing."""
    there = _described(spark, one.table)
    if not one.replace:
        _attach(spark, one, there)
    elif there and _same_place(there["Location"], one.folder):
        return
    elif there and there["Type"] == "EXTERNAL" and NESTED in there.get("Storage Properties", "") and (
        there["Provider"].lower() == one.format_type and _stored_schema(spark, one.table) == _nullable(one.schema)
    ):
        spark.sql(f"ALTER TABLE {one.table} SET LOCATION '{_quoted(one.folder)}'")
    else:
        if there:
            spark.sql(f"DROP TABLE {one.table}")
        schema = T.StructType.fromJson(json.loads(one.schema))
        spark.catalog.createTable(one.table, one.folder, one.format_type, schema, **{NESTED: "true"})
    spark.catalog.refreshTable(one.table)


def _attach(spark: SparkSession, one: Staged, there: dict[str, str]) -> None:
    """Rename the staged folder into a published table's, or its files into the folder of any other table."""
    system, source = file_system(spark, one.folder)
    name = one.folder.rsplit("/", 1)[1]
    path = spark._jvm.org.apache.hadoop.fs.Path
    if not system.exists(source):
        pass  # renamed before a fault
    elif NESTED in there.get("Storage Properties", ""):
        _renamed(system, source, path(f"{there['Location']}/{name}"))
    else:
        for entry in system.listStatus(source):
            file = entry.getPath()
            if not file.getName().startswith(("_", ".")):
                _renamed(system, file, path(f"{there['Location']}/{file.getName()}"))
        system.delete(source, True)
    for file in one.remove:
        system.delete(path(file), False)


def _renamed(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"{source} cannot be renamed to {target}")


def _prune(spark: SparkSession, one: Staged, before: str | None) -> None:
    """Delete the versions older than the current and the one before, and what failed runs have left."""
    system, folder = file_system(spark, _versions(spark, one.table))
    kept = {_name(place) for place in (one.folder, before) if place}
    for entry in system.listStatus(folder):
        if entry.getPath().getName() not in kept:
            system.delete(entry.getPath(), True)


def _described(spark: SparkSession, table: str) -> dict[str, str] | None:
    """What the catalog says of a table: type, provider, location and so on; None if there is none."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    found = {row["col_name"]: row["data_type"] for row in rows}
    if "VIEW" in found.get("Type", "VIEW"):
        raise ValueError(f"{table} is a view: rows cannot be written to it")
    return found


def _fitted(df: DataFrame, table: str, there: dict[str, str]) -> DataFrame:
    """``df`` with the table's columns in the table's order."""
    if "# Partition Information" in there or there.get("Num Buckets", "0") not in ("0", "-1"):
        raise ValueError(f"{table} is partitioned or bucketed: rows cannot be published into it")
    schema = df.sparkSession.table(table).schema
    wanted = {f.name: f.dataType.simpleString() for f in schema}
    if wanted != {f.name: f.dataType.simpleString() for f in df.schema}:
        raise ValueError(f"rows of {dict(df.dtypes)} do not fit table {table} of {wanted}")
    return df.select(*[df["`" + name.replace("`", "``") + "`"] for name in wanted])


def _stored_schema(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema]


def _nullable(schema: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromJson(json.loads(schema))]


def _parts(spark: SparkSession, table: str) -> tuple[str, str]:
    schema, _, name = table.replace("`", "").rpartition(".")
    return schema or spark.catalog.currentDatabase(), name


def _home(spark: SparkSession, table: str) -> str:
    """The folder of the table's schema."""
    return spark.catalog.getDatabase(_parts(spark, table)[0]).locationUri.rstrip("/")


def _versions(spark: SparkSession, table: str) -> str:
    return f"{_home(spark, table)}/{_parts(spark, table)[1].lower()}{VERSIONS}"


def _journal(spark: SparkSession, tables: Sequence[str]) -> str:
    names = "+".join(sorted(".".join(_parts(spark, t)).lower() for t in tables))
    return f"{_home(spark, min(tables))}/{JOURNALS}/{names}.json"


def _write(spark: SparkSession, place: str, text: str) -> None:
    """A small file that is there with all of its text or not at all."""
    system, path = file_system(spark, place)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{place}.{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    _renamed(system, draft, path)


def _name(place: str) -> str:
    return place.rstrip("/").rsplit("/", 1)[1]


def _same_place(one: str, other: str) -> bool:
    return _name(one) == _name(other)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
