"""Both tables of a cleansing job change together: faults at every step leave them whole."""

import os

import pytest
from pyspark.sql import functions as F

from rowgate import CleanseJob, Contract
from rowgate.sources import ensure_schema, publication, publish, read_table, recover, stage, write_table

SHAPE = Contract({"k": "int", "v": "string"}, ["k"])
FIRST = [("1", "a"), ("2", "b"), ("x", "c")]
SECOND = [("3", "a"), ("4", "b"), ("y", "c"), (None, "d")]


def land(spark, schema, rows):
    spark.createDataFrame(rows, "k string, v string").write.mode("overwrite").saveAsTable(f"{schema}.raw")


def job(spark, schema, **options):
    names = {"source": f"{schema}.raw", "good_table": f"{schema}.good", "bad_table": f"{schema}.bad"}
    return CleanseJob(spark, "p", SHAPE, **names, **options)


def both(spark, schema):
    spark.catalog.refreshTable(f"{schema}.good")
    spark.catalog.refreshTable(f"{schema}.bad")
    good = sorted(r["k"] for r in read_table(spark, f"{schema}.good").collect())
    return good, sorted(r["v"] for r in read_table(spark, f"{schema}.bad").collect())


OLD, NEW = ([1, 2], ["c"]), ([3, 4], ["c", "d"])


@pytest.fixture
def loaded(spark, request):
    schema = f"joint_{abs(hash(request.node.name)) % 10**9}"
    ensure_schema(spark, schema)
    land(spark, schema, FIRST)
    job(spark, schema).run()
    assert both(spark, schema) == OLD
    land(spark, schema, SECOND)
    return schema


def test_a_second_run_replaces_both_and_keeps_one_old_version(spark, loaded):
    job(spark, loaded).run()
    assert both(spark, loaded) == NEW
    job(spark, loaded).run()
    folder = spark.catalog.getDatabase(loaded).locationUri.removeprefix("file:")
    assert len(os.listdir(f"{folder}/good{publication.VERSIONS}")) == 2
    assert not [f for f in os.listdir(f"{folder}/{publication.JOURNALS}") if f.endswith(".json")]


def test_a_fault_between_the_two_writes(spark, loaded, monkeypatch):
    monkeypatch.setattr(CleanseJob, "_stage_good", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        job(spark, loaded).run()
    assert both(spark, loaded) == OLD
    monkeypatch.undo()
    job(spark, loaded).run()
    assert both(spark, loaded) == NEW


def test_a_fault_in_the_middle_of_a_write(spark, loaded, monkeypatch):
    plain = publication.stage

    def failing(df, table, *args, **options):
        if table.endswith("good"):
            df = df.repartition(2, "k").withColumn("v", F.when(F.col("k") == 4, F.raise_error(F.lit("task lost"))).otherwise(F.col("v")))
        return plain(df, table, *args, **options)

    monkeypatch.setattr("rowgate.plans.jobs.stage", failing)
    with pytest.raises(Exception, match="task lost"):
        job(spark, loaded).run()
    assert both(spark, loaded) == OLD


@pytest.mark.parametrize("done", [0, 1, 2])
def test_a_fault_while_switching_is_made_good(spark, loaded, monkeypatch, done):
    plain, calls = publication._switch, []

    def failing(session, one):
        if len(calls) == done:
            raise RuntimeError("driver lost")
        calls.append(one.table)
        plain(session, one)

    if done < 2:
        monkeypatch.setattr(publication, "_switch", failing)
    else:
        monkeypatch.setattr(publication, "_prune", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError, match="driver lost"):
        job(spark, loaded).run()
    monkeypatch.undo()
    assert job(spark, loaded).recover() == (done < 2)
    assert both(spark, loaded) == NEW
    assert not job(spark, loaded).recover()


@pytest.mark.parametrize("plain_tables", [True, False])
def test_appends_survive_a_fault_and_land_once(spark, loaded, monkeypatch, plain_tables):
    if plain_tables:
        for name in ("good", "bad"):
            rows = spark.createDataFrame(
                read_table(spark, f"{loaded}.{name}").collect(), read_table(spark, f"{loaded}.{name}").schema
            )
            spark.sql(f"DROP TABLE {loaded}.{name}")
            write_table(rows, f"{loaded}.{name}")
    plain, calls = publication._renamed, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 3:  # the journal, the first table, and now the second
            raise RuntimeError("driver lost")
        plain(*args)

    monkeypatch.setattr(publication, "_renamed", failing)
    with pytest.raises(RuntimeError, match="driver lost"):
        job(spark, loaded, mode="append").run()
    monkeypatch.undo()
    assert job(spark, loaded).recover()
    assert both(spark, loaded) == ([1, 2, 3, 4], ["c", "c", "d"])
    job(spark, loaded, mode="append").run()
    assert both(spark, loaded) == ([1, 2, 3, 3, 4, 4], ["c", "c", "c", "d", "d"])


def test_modes_that_leave_tables_alone(spark, loaded):
    with pytest.raises(ValueError, match="already there"):
        job(spark, loaded, mode="error").run()
    job(spark, loaded, mode="ignore").run()
    assert both(spark, loaded) == OLD
    with pytest.raises(ValueError, match="mode must be"):
        job(spark, loaded, mode="merge").run()


def test_casts_are_counted_by_the_write_itself(spark, loaded, monkeypatch):
    land(spark, loaded, [("1", "a"), ("99999999999", "b")])
    with pytest.raises(ValueError, match="1 good rows cannot be cast.*99999999999"):
        job(spark, loaded).run()
    assert both(spark, loaded) == OLD
    assert not hasattr(CleanseJob, "_check_casts")


def test_what_does_not_fit_is_refused(spark, loaded):
    with pytest.raises(ValueError, match="do not fit"):
        stage(spark.range(3), f"{loaded}.good", "append")
    spark.range(3).createOrReplaceTempView("a_view")
    with pytest.raises(ValueError, match="view"):
        stage(spark.range(3), "a_view")
    spark.range(3).withColumn("p", F.lit(1)).write.partitionBy("p").saveAsTable(f"{loaded}.parted")
    with pytest.raises(ValueError, match="partitioned"):
        stage(spark.range(3).withColumn("p", F.lit(1)), f"{loaded}.parted", "append")


def test_columns_in_another_order_and_a_new_schema(spark, loaded):
    name = f"{loaded}.free"
    publish(spark, [stage(spark.createDataFrame([(1, "a")], "k int, v string"), name)])
    publish(spark, [stage(spark.createDataFrame([("b", 2)], "v string, k int"), name, "append")])
    assert sorted(map(tuple, read_table(spark, name).collect())) == [(1, "a"), (2, "b")]
    publish(spark, [stage(spark.range(2), name)])
    assert read_table(spark, name).columns == ["id"] and read_table(spark, name).count() == 2
    assert not recover(spark, [name])
