"""The plans behind the results: what is read, what is shuffled, how often."""

import re

import pytest
from test_checks import SHAPE, skewed

from rowgate import Contract, good, score
from rowgate.functions import invalid_flags
from rowgate.operators import (
    all_duplicates,
    copy_numbers,
    first_copies,
    good_records,
    invalid_records,
    key_counts,
    melt_flags,
    merge_reasons,
    null_key_records,
    with_flags,
    with_row_id,
)
from rowgate.operators.marking import _repeated_hashes, digest

SF = "/root/testdata/sf0.001"
LINES = Contract(
    {"l_orderkey": "int", "l_linenumber": "int", "l_returnflag": "string", "l_shipdate": "date"},
    ["l_orderkey", "l_linenumber"],
)


@pytest.fixture(scope="module")
def lines(spark):
    return with_row_id(spark.read.parquet(f"{SF}/lineitem.parquet"), LINES)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return [line.strip() for line in text.splitlines() if re.search(r"\bExchange (hash|range|Round|Single)", line)]


def test_small_tables_take_one_exchange_and_one_sort(lines):
    text = plan(score(lines, LINES))
    assert len(exchanges(text)) == 1
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert text.count("FileScan") == 1


def test_lookups_leave_the_table_in_place(lines):
    text = plan(score(lines, LINES, window_rows=0))
    assert exchanges(text) == []
    assert text.count("BroadcastHashJoin") == 2
    assert "Window" not in text


def test_large_keys_are_joined_by_row_number_and_the_rest_windowed(spark):
    df = skewed(spark)
    text = plan(score(df, SHAPE, window_rows=100, broadcast_rows=150, bitmap_rows=0))
    looked_up, windowed = text.split("Union")[1].split("Window", 1)
    joins = [line for line in exchanges(looked_up) if "hashpartitioning(_sk" in line]
    assert len(joins) == 2 and "SortMergeJoin" in looked_up
    assert len(exchanges(windowed)) == 1 and "hashpartitioning(k" in exchanges(windowed)[0]
    # Only the hashes of the large keys are broadcast.
    assert text.count("BroadcastHashJoin") == 2


def test_without_large_keys_everything_is_windowed(lines):
    text = plan(score(lines, LINES, window_rows=1000, broadcast_rows=100, bitmap_rows=0))
    assert len(exchanges(text)) == 1 and "Join" not in text


def test_rows_outside_the_bitmap_stay_in_place(lines):
    text = plan(score(lines, LINES, window_rows=1000, broadcast_rows=100))
    moved = [line for line in exchanges(text) if "hashpartitioning(l_orderkey" in line]
    assert len(moved) == 1 and text.count("Window [") == 2
    # The other exchanges bring the kept hashes together for the bitmap.
    others = [line for line in exchanges(text) if line not in moved]
    assert len(others) == 2 and all("hashpartitioning(_rowgate_bucket" in line for line in others)
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_key_pass_reads_the_key_and_shuffles_hashes(lines):
    text = plan(_repeated_hashes(lines, LINES))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text
    assert len(exchanges(text)) == 1 and "hashpartitioning(_rowgate_key_hash" in text
    assert "partial_count" in text


def test_copies_combine_before_the_shuffle(lines):
    text = plan(first_copies(lines, LINES))
    assert "partial_min" in text and text.count("HashAggregate") == 2
    assert len(exchanges(text)) == 1


def test_no_duplicates_means_no_join(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    shape = Contract({"o_orderkey": "int", "o_orderstatus": "string"}, ["o_orderkey"])
    text = plan(good(score(with_row_id(orders, shape), shape, window_rows=0), shape))
    assert "Join" not in text and exchanges(text) == []


def test_only_declared_columns_are_read(lines):
    text = plan(score(lines, LINES))
    assert "l_extendedprice" not in text and "l_partkey" not in text


def test_melting_does_not_shuffle(lines):
    flags = invalid_flags(LINES)
    text = plan(melt_flags(with_flags(lines, flags), ["_sk"], list(flags)))
    assert exchanges(text) == [] and "Expand" in text


def test_no_python_in_any_plan(lines):
    for sizes in ({}, {"window_rows": 0}):
        text = plan(score(lines, LINES, **sizes))
        assert "Python" not in text and "Arrow" not in text


def test_row_local_records_do_not_shuffle(lines):
    for records in (invalid_records, null_key_records):
        text = plan(records(lines, LINES))
        assert exchanges(text) == [] and text.count("FileScan") == 1


def test_staged_records_take_few_scans_and_exchanges(lines):
    parts = [invalid_records(lines, LINES), null_key_records(lines, LINES), all_duplicates(lines, LINES)]
    merged = merge_reasons(parts, "_sk")
    text = plan(merged)
    assert len(exchanges(text)) == 2 and text.count("FileScan") == 3
    assert not any("l_returnflag" in line for line in exchanges(text) if "_sk" in line.split("hashpartitioning")[1][:8])
    text = plan(all_duplicates(lines, LINES))
    assert len(exchanges(text)) == 1 and text.count("FileScan") == 1
    assert "Join" in plan(good_records(lines, merged, LINES))


def test_numbers_within_small_groups_take_one_window(lines):
    for numbered in (copy_numbers(lines, ["l_orderkey"], "_sk"), key_counts(lines, ["l_orderkey"], "_sk")):
        text = plan(numbered)
        assert len(exchanges(text)) == 1 and text.count("FileScan") == 1 and "Join" not in text


DOCUMENTS = Contract({"text": "string", "lang": "string", "source": "string"}, ["text"], row_id="doc_id")


def test_texts_are_marked_by_digests_and_stay_in_place(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = plan(score(documents, DOCUMENTS))
    assert exchanges(text) == [] and "Window" not in text and text.count("BroadcastHashJoin") == 1
    # Beyond the broadcast the marked numbers are joined; that is the only way the rows move.
    wide = plan(score(documents, DOCUMENTS, broadcast_rows=10))
    assert "SortMergeJoin" in wide and all("hashpartitioning(doc_id" in line for line in exchanges(wide))


@pytest.mark.parametrize("sizes", [{}, {"window_rows": 1}, {"window_rows": 2, "broadcast_rows": 10}, {"window_rows": 50, "bitmap_rows": 0, "broadcast_rows": 10}])
def test_digests_mark_what_values_mark(spark, sizes):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = documents.union(documents.withColumn("doc_id", documents["doc_id"] + 1000).where("doc_id % 3 = 0"))
    rows = rows.union(documents.selectExpr("doc_id + 2000", "text", "'xx'", "nullif(source, 'src1')", "n_chars").where("doc_id % 5 = 0"))
    rows = rows.union(documents.selectExpr("doc_id + 3000", "cast(null as string)", "lang", "source", "n_chars").where("doc_id % 50 = 0"))

    def reasons(wide_bytes):
        scored = score(rows, DOCUMENTS, **sizes, wide_bytes=wide_bytes)
        return sorted((r["doc_id"], r["reason"]) for r in scored.collect())

    assert reasons(0) == reasons(1 << 40)


def test_digests_tell_tuples_apart(spark):
    rows = [(1, "a", "b"), (2, "ab", ""), (3, "", "ab"), (4, None, "ab"), (5, "n", "ab"), (6, "1:a", "1:b"), (7, "a1:b", None), (8, None, None)]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    assert df.select(digest(df, ["x", "y"])).distinct().count() == len(rows)
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 1)], "x double, y int")
    assert zeros.select(digest(zeros, ["x", "y"])).distinct().count() == 1
    listed = spark.createDataFrame([(1, "k", [1])], "id long, k string, v array<int>")
    shape = Contract({"k": "string", "v": "string"}, ["k"], row_id="id")
    assert score(listed, shape, wide_bytes=0).count() == 1
