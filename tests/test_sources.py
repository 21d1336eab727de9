import datetime
import os
import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rowgate import CleanseJob, Contract, IngestJob, Staging, fixed_splits
from rowgate.sources import (
    detect_format,
    ensure_schema,
    preview,
    read_by_header,
    read_raw,
    read_table,
    replace_partitions,
    with_load_time,
    write_table,
)
from rowgate.staging import MIN_SPLITS, shared_folder


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/a/b.c/shops.csv", "csv"),
        ("/a/shop.CSV.gz", "csv"),
        ("shop.json", "json"),
        ("/a/shop.parquet/", "parquet"),
        ("/a/shop.orc", "orc"),
        ("/a/shop.txt", "csv"),
        ("/a/shop.2025.xml", "xml"),
    ],
)
def test_detect_format(path, expected):
    assert detect_format(path) == expected


@pytest.mark.parametrize("path", ["/a/b.c/shop", "shop", "/a/*.*", "shop.gz"])
def test_no_format_in_the_path(path):
    with pytest.raises(ValueError):
        detect_format(path)


def test_raw_scan_of_several_files(spark, tmp_path):
    for number in range(3):
        (tmp_path / f"part{number}.csv").write_text(f"a|b\n{number}|\n|x|y\n")
    df = read_raw(spark, str(tmp_path), format_type="csv")
    assert df.dtypes == [("a", "string"), ("b", "string")]
    # Too many fields in a line: the spare ones are dropped, as in the permissive default.
    assert sorted(map(str, df.collect())) == sorted(
        [f"Row(a='{n}', b=None)" for n in range(3)] + ["Row(a=None, b='x')"] * 3
    )


def test_declared_columns_are_checked_against_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a|b\n1|2\n")
    assert read_raw(spark, str(tmp_path), "csv", columns=["a", "b"]).collect() == [("1", "2")]
    with pytest.raises(Exception, match="header does not conform"):
        read_raw(spark, str(tmp_path), "csv", columns=["a", "c"]).collect()


def test_headers_in_another_order_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k|v\n1|x\n")
    (tmp_path / "b.csv").write_text("v|k\ny|2\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_raw(spark, str(tmp_path), "csv").collect()


def test_load_time(spark):
    moment = datetime.datetime(2025, 3, 4, 5, 6, 7)
    row = with_load_time(spark.range(1), "_", moment).first()
    assert (row["_load_dt"], row["_load_dttm"]) == (moment.date(), moment)
    assert with_load_time(spark.range(1)).dtypes[1:] == [("load_dt", "date"), ("load_dttm", "timestamp")]


def test_write_modes(spark):
    ensure_schema(spark, "modes")
    ensure_schema(spark, "modes")
    write_table(spark.range(3), "modes.t", "error")
    with pytest.raises(AnalysisException):
        write_table(spark.range(3), "modes.t", "errorifexists")
    write_table(spark.range(5), "modes.t", "ignore")
    assert read_table(spark, "modes.t").count() == 3
    write_table(spark.range(5), "modes.t", "append")
    assert read_table(spark, "modes.t").count() == 8
    write_table(spark.range(2), "modes.t", "overwrite", format_type="orc", even_files=True)
    assert read_table(spark, "modes.t").count() == 2
    with pytest.raises(ValueError):
        write_table(spark.range(2), "modes.t", "merge")


def test_preview(spark):
    assert [r["id"] for r in preview(spark.range(100), 5, ["id"]).collect()] == [0, 1, 2, 3, 4]
    assert preview(spark.range(100)).count() == 5


def test_staging_lives_in_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    staging = Staging(spark)
    assert staging.keep(spark.range(0), "nothing").count() == 0
    kept = staging.keep(spark.range(7), "seven")
    assert (kept.count(), kept.dtypes) == (7, [("id", "bigint")])
    staging.clear()
    with pytest.raises(AnalysisException):
        spark.read.parquet(staging.path("seven"))


def test_fixed_splits_puts_the_setting_back(spark):
    assert spark.conf.get(MIN_SPLITS, None) is None
    with fixed_splits(spark):
        assert int(spark.conf.get(MIN_SPLITS)) == spark.sparkContext.defaultParallelism
    assert spark.conf.get(MIN_SPLITS, None) is None


def test_cleanse_a_view_and_append(spark):
    ensure_schema(spark, "views")
    rows = [("1", "a"), ("1", "a"), ("2", "b"), ("x", "c"), (None, "d")]
    spark.createDataFrame(rows, "k string, v string").repartition(3, "v").createOrReplaceTempView("raw_view")
    job = CleanseJob(
        spark,
        "p",
        Contract({"k": "int", "v": "string"}, ["k"]),
        source="raw_view",
        good_table="views.good",
        bad_table="views.bad",
        mode="append",
    )
    job.run()
    clean, quarantine = job.run()
    assert sorted(r["k"] for r in clean.collect()) == [1, 1, 2, 2]
    assert quarantine.count() == 6


def test_cleanse_a_partitioned_table(spark):
    ensure_schema(spark, "parts")
    rows = [("1", "a"), ("1", "b"), ("2", "b"), ("3", "c")]
    raw = spark.createDataFrame(rows, "k string, v string")
    raw.write.partitionBy("v").saveAsTable("parts.raw")
    job = CleanseJob(
        spark,
        "p",
        Contract({"k": "int", "v": "string"}, ["k"], typed=False),
        source="parts.raw",
        good_table="parts.good",
        bad_table="parts.bad",
        window_rows=0,
    )
    clean, quarantine = job.run()
    assert sorted(r["k"] for r in clean.collect()) == ["2", "3"]
    assert quarantine.count() == 2


REPEATED = Contract({"k": "int", "v": "string"}, ["k"], typed=False)


def repeated_rows(spark, count):
    """Of ``count`` rows one in a hundred is a copy, and one in a hundred shares its key with another."""
    n = F.col("id")
    key = F.when(n % 100 == 1, n - 1).when(n % 100 == 3, n - 1).otherwise(n)
    value = F.when(n % 100 == 3, "other").otherwise("same")
    return spark.range(0, count, 1, 8).select(key.cast("string").alias("k"), value.alias("v"))


@pytest.mark.parametrize("kind", ["plain", "bucketed", "partitioned", "orc", "view"])
@pytest.mark.parametrize("broadcast", [True, False])
def test_every_source_gets_the_same_split_from_every_plan(spark, kind, broadcast):
    schema = f"sources_{kind}_{broadcast}".lower()
    ensure_schema(spark, schema)
    rows, source = repeated_rows(spark, 6000), f"{schema}.raw"
    if kind == "view":
        rows.repartition(5, "v").createOrReplaceTempView(source := f"{schema}_raw")
    elif kind == "bucketed":
        rows.write.bucketBy(6, "k").saveAsTable(source)
    elif kind == "partitioned":
        rows.write.partitionBy("v").saveAsTable(source)
    else:
        rows.write.format("orc" if kind == "orc" else "parquet").saveAsTable(source)
    expected = {"_is_dup_row": 60, "_is_dup_key": 120}
    names = {"source": source, "good_table": f"{schema}.good", "bad_table": f"{schema}.bad"}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        if not broadcast:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        for sizes in ({}, {"window_rows": 1}, {"window_rows": 2, "broadcast_rows": 10}):
            job = CleanseJob(spark, "p", REPEATED, **names, **sizes)
            clean, bad = job.run()
            assert {r["reason"][0]: r["count"] for r in bad.groupBy("reason").count().collect()} == expected
            assert clean.count() == 6000 - 180
        df = job.read()
        quarantine = job.quarantine(job.invalid(df), job.null_key(df), job.duplicates(df))
        assert {r["reason"][0]: r["count"] for r in quarantine.groupBy("reason").count().collect()} == expected
        assert job.good(df, quarantine).count() == 6000 - 180
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_bucketed_table_beyond_the_default_limit(spark):
    ensure_schema(spark, "beyond")
    repeated_rows(spark, 1_200_000).write.bucketBy(8, "k").saveAsTable("beyond.raw")
    names = {"source": "beyond.raw", "good_table": "beyond.good", "bad_table": "beyond.bad"}
    _, bad = CleanseJob(spark, "p", REPEATED, **names).run()
    assert {r["reason"][0]: r["count"] for r in bad.groupBy("reason").count().collect()} == {
        "_is_dup_row": 12_000,
        "_is_dup_key": 24_000,
    }


def test_a_value_that_cannot_be_cast_leaves_both_tables_alone(spark):
    ensure_schema(spark, "casts")
    shape = Contract({"k": "int", "day": "date"}, ["k"])
    names = {"source": "casts.raw", "good_table": "casts.good", "bad_table": "casts.bad"}
    for rows in ([("1", "2025-01-01"), ("x", "2025-01-01")], [("2", "2025-13-01"), ("y", "2025-01-01")]):
        spark.createDataFrame(rows, "k string, day string").write.mode("overwrite").saveAsTable("casts.raw")
        job = CleanseJob(spark, "p", shape, **names)
        if rows[0][0] == "1":
            job.run()
        else:
            with pytest.raises(ValueError, match="2025-13-01"):
                job.run()
    assert [r["k"] for r in read_table(spark, "casts.good").collect()] == [1]
    assert [r["k"] for r in read_table(spark, "casts.bad").collect()] == ["x"]


def test_staging_as_a_block(spark):
    with Staging(spark) as staging:
        assert staging.keep(spark.range(3), "three").count() == 3
    with pytest.raises(AnalysisException):
        spark.read.parquet(staging.path("three"))


def test_ingest_other_formats(spark, tmp_path):
    ensure_schema(spark, "landing")
    spark.createDataFrame([("1", "a")], "k string, v string").write.json(str(tmp_path / "shop.json"))
    raw = IngestJob(spark, "p", str(tmp_path / "shop.json"), table="landing.shop").run()
    assert raw.select("k", "v").collect() == [("1", "a")]
    assert raw.columns[2:] == ["_load_dt", "_load_dttm", "_file_name", "_file_path", "_file_size", "_file_mod"]


def test_lines_that_do_not_fit_are_rescued_and_quarantined(spark, tmp_path):
    ensure_schema(spark, "broken")
    (tmp_path / "a.csv").write_text('k|v|w\n1|a|b\n2|a\n3|a|b|c\n4\n5||\n6|"x|y"|z\n')
    scan = read_raw(spark, str(tmp_path / "a.csv"), rescue="line")
    found = {r["k"]: tuple(r)[1:] for r in scan.collect()}
    assert found == {
        "1": ("a", "b", None), "2": ("a", None, "2|a"), "3": ("a", "b", "3|a|b|c"), "4": (None, None, "4"),
        "5": (None, None, None), "6": ("x|y", "z", None),
    }
    IngestJob(spark, "p", str(tmp_path / "a.csv"), table="broken.raw", rescue="line").run()
    shape = Contract({"k": "int", "v": "string", "w": "string"}, ["k"], null_policy="pass", rescue="line")
    for sizes in ({}, {"window_rows": 0}):
        names = {"source": "broken.raw", "good_table": "broken.good", "bad_table": "broken.bad"}
        job = CleanseJob(spark, "p", shape, **names, **sizes)
        clean, bad = job.run()
        assert sorted(r["k"] for r in clean.collect()) == [1, 5, 6] and clean.columns[:3] == ["k", "v", "w"] and "line" not in clean.columns
        assert {r["line"]: r["reason"] for r in bad.collect()} == {line: ["_is_line_broken"] for line in ("2|a", "3|a|b|c", "4")}
        df = job.read()
        quarantine = job.quarantine(job.invalid(df), job.null_key(df), job.duplicates(df))
        assert {r["line"]: r["reason"] for r in quarantine.collect()} == {r["line"]: r["reason"] for r in bad.collect()}
    for rescue in ("reason", "k", "_sk"):
        with pytest.raises(ValueError):
            Contract({"k": "int"}, ["k"], rescue=rescue)


def test_quarantine_keeps_the_file_of_a_row(spark, tmp_path):
    ensure_schema(spark, "traced")
    for name, lines in (("a", "1|x\n2|y\n2|z\n"), ("b", "q|x\n1|x\n")):
        (tmp_path / f"{name}.csv").write_text("k|v\n" + lines)
    IngestJob(spark, "p", str(tmp_path), table="traced.raw", format_type="csv").run()
    shape = Contract({"k": "int", "v": "string"}, ["k"], lineage=["_file_name", "_file_size"])
    for sizes in ({}, {"window_rows": 0}):
        clean, bad = CleanseJob(spark, "p", shape, "traced.raw", "traced.good", "traced.bad", **sizes).run()
        found = sorted((r["k"], r["_file_name"], r["reason"][0]) for r in bad.collect() if r["reason"] != ["_is_dup_row"])
        assert found == [("2", "a.csv", "_is_dup_key"), ("2", "a.csv", "_is_dup_key"), ("q", "b.csv", "_is_k_invalid")]
        assert clean.columns == ["k", "v", "load_dt", "load_dttm"] and clean.count() == 1
    for lineage in (["k"], ["reason"], ["a", "A"]):
        with pytest.raises(ValueError):
            Contract({"k": "int"}, ["k"], lineage=lineage)


def test_headers_in_another_order_are_read_by_name(spark, tmp_path):
    ensure_schema(spark, "orders_of_columns")
    (tmp_path / "a.csv").write_text("k|v|w\n1|a|x\n")
    (tmp_path / "b.csv").write_text("k|v|w\n2|b|\n9|q|r|s\n")
    (tmp_path / "c.csv").write_text("w|k|v\ny|3|c\n")
    (tmp_path / "d.csv").write_text("v|k\nd|4\ne|5\n")
    (tmp_path / "empty.csv").write_text("")
    found = read_by_header(spark, str(tmp_path), rescue="line")
    assert found.columns == ["k", "v", "w", "line"]
    rows = {r["k"]: tuple(r)[1:] for r in found.collect()}
    assert rows == {
        "1": ("a", "x", None), "2": ("b", None, None), "3": ("c", "y", None), "4": ("d", None, None), "5": ("e", None, None),
        "9": ("q", "r", "9|q|r|s"),
    }
    raw = IngestJob(spark, "p", str(tmp_path), table="orders_of_columns.raw", format_type="csv", by_header=True).run()
    assert {(r["k"], r["_file_name"]) for r in raw.collect()} == {
        ("1", "a.csv"), ("2", "b.csv"), ("9", "b.csv"), ("3", "c.csv"), ("4", "d.csv"), ("5", "d.csv"),
    }
    assert read_by_header(spark, str(tmp_path), columns=["v", "z"]).where("v = 'c'").collect() == [("c", None)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("")
    with pytest.raises(ValueError, match="no delimited file"):
        read_by_header(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("limit", [3, 100])
def test_any_number_of_files_without_a_kept_table(spark, limit, monkeypatch):
    schema = f"files_{limit}"
    ensure_schema(spark, schema)
    repeated_rows(spark, 6000).repartition(11).write.saveAsTable(f"{schema}.raw")
    names = {"source": f"{schema}.raw", "good_table": f"{schema}.good", "bad_table": f"{schema}.bad"}
    kept, keep = [], Staging.keep
    monkeypatch.setattr(Staging, "keep", lambda self, df, name, flag=None: kept.append(name) or keep(self, df, name, flag))
    for sizes in ({}, {"window_rows": 1}, {"window_rows": 2, "broadcast_rows": 10}):
        job = CleanseJob(spark, "p", REPEATED, **names, **sizes, broadcast_files=limit)
        clean, bad = job.run()
        assert {r["reason"][0]: r["count"] for r in bad.groupBy("reason").count().collect()} == {"_is_dup_row": 60, "_is_dup_key": 120}
        assert clean.count() == 6000 - 180
    assert "rows" not in kept and ("files-ordered" in kept) == (limit == 100)
    numbered = job.read()
    ids = [r["_sk"] for r in numbered.collect()]
    assert len(set(ids)) == 6000 and min(ids) >= 0
    assert sorted(ids) == sorted(r["_sk"] for r in numbered.repartition(3).collect())
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == (limit == 100)


def test_no_files_at_all(spark):
    ensure_schema(spark, "no_files")
    repeated_rows(spark, 10).where("false").write.saveAsTable("no_files.raw")
    clean, bad = CleanseJob(spark, "p", REPEATED, "no_files.raw", "no_files.good", "no_files.bad").run()
    assert clean.count() == bad.count() == 0


def test_only_new_files_land(spark, tmp_path):
    ensure_schema(spark, "streams")
    landing, checkpoint = tmp_path / "landing", tmp_path / "checkpoint"
    landing.mkdir()

    def job():
        return IngestJob(spark, "p", str(landing), table="streams.raw", format_type="csv", rescue="line")

    def landed():
        return sorted((r["k"], r["_file_name"], r["line"]) for r in job().run_new_files(str(checkpoint)).collect())

    (landing / "a.csv").write_text("k|v\n1|a\n2|b|c\n")
    first = [("1", "a.csv", None), ("2", "a.csv", "2|b|c")]
    assert landed() == first and landed() == first
    (landing / "b.csv").write_text("k|v\n3|c\n")
    second = [*first, ("3", "b.csv", None)]
    assert landed() == second
    # Killed between the table's commit and the stream's: the batch comes again and is known.
    commits = sorted(p for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    commits[-1].unlink()
    (checkpoint / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert landed() == second
    # Killed before the table's commit: the files written so far are not in its log.
    (landing / "c.csv").write_text("k|v\n4|d\n")
    table = spark.catalog.getDatabase("streams").locationUri.removeprefix("file:") + "/raw"
    stray = next(p for p in os.listdir(table) if p.endswith(".parquet"))
    shutil.copy(f"{table}/{stray}", f"{table}/part-00000-stray.parquet")
    assert landed() == [*second, ("4", "c.csv", None)]
    with pytest.raises(ValueError, match="one header"):
        IngestJob(spark, "p", str(landing), table="streams.raw", format_type="csv", by_header=True).run_new_files("x")
    spark.range(3).write.saveAsTable("streams.plain")
    with pytest.raises(ValueError, match="no stream"):
        IngestJob(spark, "p", str(landing), table="streams.plain", format_type="csv").run_new_files(str(tmp_path / "other"))


def test_a_reloaded_day_leaves_the_others_alone(spark):
    ensure_schema(spark, "days")

    def load(rows):
        replace_partitions(spark.createDataFrame(rows, "v string, day string, n int"), "days.t", ["day"])

    def files(day):
        folder = spark.catalog.getDatabase("days").locationUri.removeprefix("file:") + f"/t/day={day}"
        return {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}

    load([("a", "d1", 1), ("b", "d2", 2), ("c", "d2", 3)])
    before = files("d1")
    load([("z", "d2", 9), ("y", "d3", 8)])
    assert files("d1") == before
    rows = sorted((r["v"], r["day"], r["n"]) for r in read_table(spark, "days.t").collect())
    assert rows == [("a", "d1", 1), ("y", "d3", 8), ("z", "d2", 9)]
    swapped = spark.createDataFrame([(7, "d1", "q")], "n int, day string, v string")
    replace_partitions(swapped, "days.t", ["day"])
    assert sorted(r["v"] for r in read_table(spark, "days.t").collect()) == ["q", "y", "z"]
    for rows, by in ((swapped, ["n"]), (swapped.drop("n"), ["day"])):
        with pytest.raises(ValueError):
            replace_partitions(rows, "days.t", by)
