"""Every registered query against its SQL, and the flagship's known counts."""

import pytest

import __spark_entry__ as registered
from checks.compare import connect, differences
from checks.oracle import oracle_sql
from checks.queries import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(registered.queries()) and set(oracle_sql()) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", queries())
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, SF, name) == []


def test_flagship_counts(spark):
    assert {r["reason"]: r["row_count"] for r in registered.entry(spark).collect()} == {
        "_is_order_id_invalid": 58,
        "_is_file_dt_invalid": 58,
        "_is_order_id_null": 30,
        "_is_dup_row": 36,
        "_is_dup_key": 70,
    }
