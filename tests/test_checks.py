"""Flags, reasons and duplicates on small frames, against plain Python."""

import random

import pytest
from brute import expected_reasons
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowgate import Contract, bad, good, reason_counts, score
from rowgate.contract import DATE_RULE, INT_RULE
from rowgate.functions import any_flag, fails_format, invalid_flags, reason_array
from rowgate.operators import (
    all_duplicates,
    collect_reasons,
    copy_numbers,
    flagged_records,
    good_records,
    invalid_records,
    key_counts,
    key_duplicates,
    melt_flags,
    merge_reasons,
    nonnull_base,
    null_key_records,
    row_duplicates,
    rows_without,
    typed,
    union_records,
    with_flags,
)
from rowgate.operators.marking import _mark_maybe_repeated, _repeated_hashes

PATHS = {
    "windows": {},
    "lookup": {"window_rows": 0},
    "mixed": {"window_rows": 4, "broadcast_rows": 8},
    "no bitmap": {"window_rows": 4, "broadcast_rows": 8, "bitmap_rows": 0},
    "no large key": {"window_rows": 0, "broadcast_rows": 1},
}
SHAPE = Contract({"k": "int", "v": "string", "day": "date"}, ["k"])
DAY = "2025-01-01"


def frame(spark, rows, contract=SHAPE):
    schema = ", ".join(f"`{name}` string" for name in contract.columns)
    return spark.createDataFrame(rows, f"`{contract.row_id}` long, {schema}")


def reasons(scored, contract=SHAPE):
    return {row[contract.row_id]: row["reason"] for row in scored.collect()}


def as_sets(found):
    return {number: set(names) for number, names in found.items()}


EDGES = [("2025-13-99", "date"), ("xx2025-11-21", "date"), ("20251121", "date"), ("99999999999", "int")]
EDGES += [("123\n", "int"), ("-5", "int"), (" 5", "int"), (None, "int"), (None, "date"), ("7", "int")]
BROKEN = {("20251121", "date"), ("-5", "int"), (" 5", "int")}


def test_edge_values_of_the_format_rules(spark):
    df = spark.createDataFrame(EDGES, "value string, type string")
    rules = {"int": INT_RULE, "date": DATE_RULE}
    for policy in ("pass", "flag"):
        outcome = F.lit(None).cast("boolean")
        for type_name, rule in rules.items():
            outcome = F.when(F.col("type") == type_name, fails_format(F.col("value"), rule, policy)).otherwise(outcome)
        for value, type_name, broken in df.withColumn("broken", outcome).collect():
            assert broken is (policy == "flag" if value is None else (value, type_name) in BROKEN)


def test_strict_calls_uncastable_values_invalid(spark):
    rows = [(1, "99999999999", "a", DAY), (2, "2", "b", "2025-13-99"), (3, "3", "c", "xx2025-11-21"), (4, "4", "d", DAY)]
    loose, strict = SHAPE, SHAPE.with_options(strict=True)
    assert all(not names for names in reasons(score(frame(spark, rows), loose)).values())
    found = reasons(score(frame(spark, rows), strict), strict)
    assert found == {1: ["_is_k_invalid"], 2: ["_is_day_invalid"], 3: ["_is_day_invalid"], 4: []}
    assert typed(good(score(frame(spark, rows), strict), strict), strict).dtypes[0] == ("k", "int")
    tail = frame(spark, [(1, "1\n", "a", DAY), (2, "2", "a", "xx" + DAY)])
    assert reasons(score(tail, strict), strict) == {1: ["_is_k_invalid"], 2: ["_is_day_invalid"]}
    with pytest.raises(PySparkException):
        typed(good(score(frame(spark, rows), loose), loose), loose).collect()


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, "1", "a", DAY)],
        [(1, None, "a", DAY), (2, None, "a", DAY), (3, None, None, None)],
        [(1, "1", "a", DAY), (2, "1", "a", DAY), (3, "1", "a", DAY)],
        [(3, "1", "a", DAY), (2, "1", "a", DAY), (1, "1", None, DAY), (0, "1", None, DAY)],
        [(1, "x", "a", "bad"), (2, "x", "a", DAY), (3, "2", "a", DAY)],
    ],
    ids=["empty", "one", "null-keys", "copies", "null-equals-null", "invalid-still-counts"],
)
def test_small_tables(spark, rows, path):
    found = reasons(score(frame(spark, rows), SHAPE, **PATHS[path]))
    assert as_sets(found) == expected_reasons(rows, SHAPE)


def random_rows(seed, count):
    pick = random.Random(seed).choice
    values = (["1", "2", "3", "x", None], ["a", "b", None], [DAY, "2025-01-02", "20250101", None])
    numbers = random.Random(seed).sample(range(count * 3), count)
    return [(number, *[pick(options) for options in values]) for number in numbers]


CONTRACTS = {
    "plain": SHAPE,
    "pass": SHAPE.with_options(null_policy="pass"),
    "composite": SHAPE.with_options(key=["v", "k"]),
    "all columns": SHAPE.with_options(key=["day", "v", "k"]),
    "strings": Contract({"k": "string", "v": "string", "day": "string"}, ["v"]),
    "odd names": Contract({"a b": "int", "status": "string", "n.m": "date"}, ["a b", "n.m"]),
}


@pytest.mark.parametrize("name", CONTRACTS)
def test_every_way_gives_the_same_split(spark, name):
    contract = CONTRACTS[name]
    rows = random_rows(sum(map(ord, name)), 60)
    expected = expected_reasons(rows, contract)
    df = frame(spark, rows, contract).repartition(3).cache()
    for sizes in PATHS.values():
        scored = score(df, contract, **sizes)
        found = reasons(scored, contract)
        assert as_sets(found) == expected
        order = contract.flag_names
        assert all(names == sorted(names, key=order.index) for names in found.values())
    kept = good(scored, contract).collect()
    assert len(kept) + bad(scored, contract).count() == len(rows)

    null_records = null_key_records(df, contract)
    base = nonnull_base(df, contract)
    assert base.count() == rows_without(df, null_records, contract.row_id).count()
    dups = all_duplicates(base, contract)
    merged = merge_reasons([invalid_records(df, contract), null_records, dups], contract.row_id)
    assert merged.columns == [contract.row_id, *contract.data_columns, "reason"]
    assert as_sets(reasons(merged, contract)) == {n: r for n, r in expected.items() if r}
    left = good_records(df, merged, contract)
    assert {r[0] for r in left.collect()} == {n for n, r in expected.items() if not r}
    df.unpersist()


THIRD = 4000


def skewed(spark):
    """A third under one key, a third copies of one row, the rest half pairs and half null keys."""
    number, half = F.col("id"), THIRD // 2
    part = F.floor(number / THIRD)
    pair = (F.lit(100) + F.floor(number / 2)).cast("string")
    key = F.when(part == 0, "7").when(part == 1, "8").when(number < 2 * THIRD + half, pair)
    value = F.when(part == 0, F.concat(F.lit("v"), number)).otherwise("same")
    return spark.range(3 * THIRD).select(
        number.alias("_sk"), key.alias("k"), value.alias("v"), F.lit(DAY).alias("day")
    )


@pytest.mark.parametrize("sizes", [{}, {"window_rows": 100}, {"window_rows": 100, "broadcast_rows": 150, "bitmap_rows": 1}])
def test_a_third_in_one_key_and_a_third_in_one_copy_group(spark, sizes):
    df = skewed(spark)
    counts = {r["reason"]: r["rows"] for r in reason_counts(score(df, SHAPE, **sizes)).collect()}
    assert counts == {
        "_is_dup_key": THIRD,
        "_is_dup_row": THIRD - 1 + THIRD // 4,
        "_is_k_null": THIRD // 2,
        "_is_k_invalid": THIRD // 2,
    }


@pytest.mark.parametrize("bitmap_rows", [1, 7])
def test_the_bitmap_finds_every_repeated_key(spark, bitmap_rows):
    """Of 40,000 keys 3,000 repeat; others may pass, but most do not."""
    number = F.col("id")
    rows = spark.range(43_000).select(
        number.alias("_sk"),
        F.when(number < 40_000, number).otherwise((number - 40_000) * 13).cast("string").alias("k"),
        F.lit("v").alias("v"),
        F.lit(DAY).alias("day"),
    )
    marked = _mark_maybe_repeated(rows, SHAPE, _repeated_hashes(rows, SHAPE), bitmap_rows)
    counts = marked.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.bool_and("_rowgate_maybe").alias("maybe"))
    outcome = {(r["more"], r["maybe"]): r["count"] for r in counts.groupBy((F.col("n") > 1).alias("more"), "maybe").count().collect()}
    assert (True, False) not in outcome and outcome[True, True] == 3000
    assert 0 < outcome[False, True] < 0.12 / bitmap_rows * outcome[False, False]
    found = {r["reason"]: r["rows"] for r in reason_counts(
        score(rows, SHAPE, window_rows=100, broadcast_rows=500, bitmap_rows=bitmap_rows)).collect()}
    assert found == {"_is_dup_row": 3000}


def test_duplicate_record_sets(spark):
    rows = [(1, "1", "a", DAY), (2, "1", "a", DAY), (3, "1", "b", DAY), (4, "2", "a", DAY), (5, "2", "a", DAY)]
    df = frame(spark, rows)
    assert reasons(row_duplicates(df, SHAPE)) == {2: ["_is_dup_row"], 5: ["_is_dup_row"]}
    assert reasons(key_duplicates(df, SHAPE)) == {1: ["_is_dup_key"], 3: ["_is_dup_key"]}
    both = {**reasons(row_duplicates(df, SHAPE)), **reasons(key_duplicates(df, SHAPE))}
    assert reasons(all_duplicates(df, SHAPE)) == both
    for by_name in (True, False):
        parts = [row_duplicates(df, SHAPE), key_duplicates(df, SHAPE)]
        assert reasons(union_records(parts, by_name)) == both


@pytest.mark.parametrize("slice_bits, row_id_bits", [(20, 63), (2, 8), (4, 20)])
def test_copy_numbers(spark, slice_bits, row_id_bits):
    rows = [(number, k, v) for number, k, v, _ in random_rows(5, 80)]
    df = spark.createDataFrame(rows, "_sk long, k string, v string").repartition(3)
    found = {(r["_sk"], r["rn"]) for r in copy_numbers(df, ["k", "v"], "_sk", slice_bits, row_id_bits).collect()}
    expected, seen = set(), {}
    for number, *data in sorted(rows, key=lambda row: row[0]):
        seen[tuple(data)] = seen.get(tuple(data), 0) + 1
        expected.add((number, seen[tuple(data)]))
    assert found == expected


@pytest.mark.parametrize("large_rows", [1 << 20, 5])
def test_key_counts(spark, large_rows):
    rows = [(number, k, v) for number, k, v, _ in random_rows(6, 80)]
    df = spark.createDataFrame(rows, "_sk long, k string, v string")
    found = {(r["_sk"], r["rn"]) for r in key_counts(df, ["k"], "_sk", large_rows).collect()}
    sizes = {}
    for _, k, _ in rows:
        sizes[k] = sizes.get(k, 0) + 1
    assert found == {(number, sizes[k]) for number, k, _ in rows}


def test_no_flags_means_nothing_flagged(spark):
    contract = CONTRACTS["strings"]
    df = frame(spark, [(1, "a", "b", "c")], contract)
    assert invalid_records(df, contract).collect() == []
    assert melt_flags(df, ["_sk"], []).columns == ["_sk", "reason"]
    assert df.where(any_flag([])).count() == 0
    assert df.select(reason_array({})).dtypes[0][1] == "array<string>"


def test_melt_keeps_true_flags_only(spark):
    rows = [(1, "x", "a", None), (2, "2", "a", DAY), (3, None, None, DAY)]
    flags = invalid_flags(SHAPE)
    df = with_flags(frame(spark, rows), flags)
    melted = melt_flags(df, ["_sk"], list(flags), sort_by=["_sk"]).collect()
    assert sorted(map(tuple, melted)) == [(1, "_is_day_invalid"), (1, "_is_k_invalid"), (3, "_is_k_invalid")]
    assert [row["_sk"] for row in melted] == [1, 1, 3]
    for collected in (
        flagged_records(df, ["_sk"], list(flags)),
        collect_reasons(melt_flags(df, ["_sk"], list(flags)), "_sk"),
        collect_reasons(melt_flags(df, ["_sk", "v"], list(flags)), "_sk").drop("v"),
    ):
        assert {r["_sk"]: sorted(r["reason"]) for r in collected.collect()} == {
            1: ["_is_day_invalid", "_is_k_invalid"],
            3: ["_is_k_invalid"],
        }
