"""The sample file end to end, for the three presets."""

import datetime

import pytest

from rowgate import CleanseJob, IngestJob, bad, dynamic, framework, good, score, standard
from rowgate.sources import ensure_schema, read_raw

# Rows of the sample without any reason.
SOUND = 41 - 16
PRESETS = {"standard": standard, "dynamic": dynamic, "framework": framework}
LINEAGE = {
    "_load_dt": "date",
    "_load_dttm": "timestamp",
    "_file_name": "string",
    "_file_path": "string",
    "_file_size": "bigint",
    "_file_mod": "timestamp",
}


@pytest.fixture(scope="module")
def bronze(spark, sample_file):
    ensure_schema(spark, "project")
    return IngestJob(spark, "depots", sample_file).run()


def reasons_of(df):
    return {row["_sk"]: set(row["reason"]) for row in df.select("_sk", "reason").collect()}


def test_raw_table(bronze, sample_rows, sample_columns, sample_file):
    types = dict(bronze.dtypes)
    assert types == {**{c: "string" for c in sample_columns}, **LINEAGE}
    rows = bronze.collect()
    assert sorted(map(str, sample_rows)) == sorted(str(tuple(r[:4])) for r in rows)
    assert {r["_file_name"] for r in rows} == {"depots.csv"}
    assert all(r["_file_path"].endswith(sample_file) for r in rows)
    assert {r["_file_size"] for r in rows} == {len(open(sample_file, "rb").read())}
    assert all(r["_load_dttm"] and r["_load_dt"] and r["_file_mod"] for r in rows)


@pytest.mark.parametrize(
    "preset, sizes",
    [
        ("standard", {}),
        ("standard", {"window_rows": 3, "broadcast_rows": 15}),
        ("dynamic", {"window_rows": 0}),
        ("framework", {"window_rows": 0, "broadcast_rows": 1}),
    ],
)
def test_cleanse_job(spark, bronze, sample_rows, sample_columns, sample_reasons, preset, sizes):
    contract = PRESETS[preset](sample_columns, ["depot_id"])
    job = CleanseJob(
        spark,
        "depots",
        contract,
        good_table=f"project.silver_{preset}",
        bad_table=f"project.bad_{preset}",
        **sizes,
    )
    clean, quarantine = job.run()
    expected = sample_reasons[contract.null_policy]
    assert reasons_of(quarantine) == expected
    assert all(len(r["reason"]) == len(set(r["reason"])) for r in quarantine.collect())
    assert quarantine.columns == ["_sk", *sample_columns, "reason"]
    raw = [tuple(r) for r in quarantine.select("_sk", *sample_columns).collect()]
    assert sorted(raw) == sorted((i, *row) for i, row in enumerate(sample_rows) if i in expected)

    assert clean.columns == [*sample_columns, "load_dt", "load_dttm"]
    types = [t for _, t in clean.dtypes]
    if contract.typed:
        assert types == ["int", "string", "string", "date", "date", "timestamp"]
    else:
        assert types == ["string"] * 4 + ["date", "timestamp"]
    expected_good = [row for i, row in enumerate(sample_rows) if i not in expected]
    if contract.typed:
        expected_good = [
            (int(a), b, c, datetime.date.fromisoformat(d)) for a, b, c, d in expected_good
        ]
    assert clean.count() == SOUND
    assert sorted(tuple(r[:4]) for r in clean.collect()) == sorted(expected_good)


@pytest.mark.parametrize("preset", PRESETS)
def test_stage_methods_agree_with_the_single_pass(spark, bronze, sample_columns, sample_reasons, preset):
    contract = PRESETS[preset](sample_columns, ["depot_id"])
    job = CleanseJob(spark, "depots", contract)
    df = job.read()
    invalid, null_key, dup = job.invalid(df), job.null_key(df), job.duplicates(df)
    quarantine = job.quarantine(invalid, null_key, dup)
    expected = sample_reasons[contract.null_policy]
    assert reasons_of(quarantine) == expected
    assert job.good(df, quarantine).count() == SOUND

    def having(*reasons):
        return {n: r & set(reasons) for n, r in expected.items() if r & set(reasons)}

    assert reasons_of(invalid) == having("_is_depot_id_invalid", "_is_opened_invalid")
    assert reasons_of(null_key) == having("_is_depot_id_null")
    assert reasons_of(dup) == having("_is_dup_row", "_is_dup_key")


def test_score_needs_no_table(spark, sample_file, sample_columns, sample_reasons):
    from rowgate.operators import with_row_id

    contract = standard(sample_columns, ["depot_id"])
    scored = score(with_row_id(read_raw(spark, sample_file), contract), contract)
    assert reasons_of(bad(scored, contract)) == sample_reasons["pass"]
    assert good(scored, contract).count() == SOUND
