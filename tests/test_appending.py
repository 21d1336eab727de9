"""Several appends that keep keys give what one run over all their rows gives."""

from collections import Counter
from random import Random

import pytest

from rowgate import CleanseJob, Contract, framework, standard
from rowgate.sources import ensure_schema, publication, read_table

SCHEMA = "k string, v string, n string"


def batches(seed, count, rows):
    """Rows of few keys, so that batches share keys and whole tuples; some keys null, some values broken."""
    random = Random(seed)
    keys = [str(i) for i in range(rows)] + ["x1", "x2", None, None, "007", "7"]
    return [
        [(random.choice(keys), random.choice("aab"), random.choice(["1", "1", "oops", None])) for _ in range(rows)] for _ in range(count)
    ]


def shapes():
    columns = {"k": "int", "v": "string", "n": "int"}
    return [standard(columns, ["k"]), framework(columns, ["k"]), standard(columns, ["k", "v"], strict=True)]


def split(spark, schema):
    for name in ("good", "bad"):
        spark.catalog.refreshTable(f"{schema}.{name}")
    good = Counter((str(r["k"]), r["v"], str(r["n"])) for r in read_table(spark, f"{schema}.good").collect())
    bad = Counter((r["k"], r["v"], r["n"], tuple(r["reason"])) for r in read_table(spark, f"{schema}.bad").collect())
    return good, bad


def land(spark, schema, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").saveAsTable(f"{schema}.raw")


def job(spark, schema, shape, **options):
    return CleanseJob(spark, "p", shape, f"{schema}.raw", f"{schema}.good", f"{schema}.bad", key_buckets=4, **options)


@pytest.mark.parametrize("number, sizes", [(0, {}), (1, {"window_rows": 0}), (2, {"window_rows": 2, "broadcast_rows": 10})])
def test_appends_equal_one_run(spark, number, sizes):
    shape, parts = shapes()[number], batches(number, 3, 40)
    whole, grown = f"whole_{number}", f"grown_{number}"
    for schema in (whole, grown):
        ensure_schema(spark, schema)
    for at, rows in enumerate(parts):
        land(spark, grown, rows)
        job(spark, grown, shape, mode="append", keep_keys=True, **sizes).run()
        land(spark, whole, [row for part in parts[: at + 1] for row in part])
        job(spark, whole, shape).run()
        assert split(spark, grown) == split(spark, whole)
    clean = read_table(spark, f"{grown}.good")
    assert clean.columns[:3] == ["k", "v", "n"] and "_digest" in clean.columns


def test_only_files_with_rows_to_take_out_are_rewritten(spark):
    shape = Contract({"k": "int", "v": "string", "n": "int"}, ["k"], typed=False, null_policy="pass")
    ensure_schema(spark, "touched")
    names = []
    for first in (0, 100, 200):
        land(spark, "touched", [(str(first + i), "a", "1") for i in range(20)])
        job(spark, "touched", shape, mode="append", keep_keys=True).run()
        names.append({r[0] for r in read_table(spark, "touched.good").selectExpr("_metadata.file_path").distinct().collect()})
    assert names[0] < names[1] < names[2]
    land(spark, "touched", [("105", "other", "1"), ("105", "other", "1"), ("205", "a", "1"), ("300", "a", "1")])
    clean, bad = job(spark, "touched", shape, mode="append", keep_keys=True).run()
    now = {r[0] for r in clean.selectExpr("_metadata.file_path").distinct().collect()}
    gone = names[2] - now
    assert len(gone) == 1 and gone < names[1] - names[0]
    assert {int(r["k"]) for r in clean.collect()} == {*range(20), *range(100, 120), *range(200, 220), 300} - {105}
    assert Counter((r["k"], r["v"], r["reason"][0]) for r in bad.collect()) == {
        ("105", "a", "_is_dup_key"): 1, ("105", "other", "_is_dup_key"): 1, ("105", "other", "_is_dup_row"): 1,
        ("205", "a", "_is_dup_row"): 1,
    }


@pytest.mark.parametrize("fault", ["stage", "_switch", "_write"])
def test_a_failed_append_is_forgotten_or_finished(spark, monkeypatch, fault):
    shape, (first, second, _) = shapes()[1], batches(9, 3, 30)
    schema = f"failed{fault}"
    ensure_schema(spark, schema)
    ensure_schema(spark, schema + "_whole")
    land(spark, schema, first)
    job(spark, schema, shape, mode="append", keep_keys=True).run()
    land(spark, schema, second)
    calls, plain = [], getattr(publication, fault)

    def failing(*args, **options):
        calls.append(args)
        if len(calls) == (1 if fault == "_write" else 2):
            raise RuntimeError("driver lost")
        return plain(*args, **options)

    monkeypatch.setattr("rowgate.plans.jobs.stage" if fault == "stage" else f"rowgate.sources.publication.{fault}", failing)
    again = job(spark, schema, shape, mode="append", keep_keys=True)
    with pytest.raises(RuntimeError, match="driver lost"):
        again.run()
    monkeypatch.undo()
    if not again.recover():
        again.run()
    land(spark, schema + "_whole", first + second)
    job(spark, schema + "_whole", shape).run()
    assert split(spark, schema) == split(spark, schema + "_whole")


def test_keys_are_kept_for_appends_only(spark):
    with pytest.raises(ValueError, match="appends"):
        CleanseJob(spark, "p", shapes()[0], "a.raw", "a.good", "a.bad", keep_keys=True)
