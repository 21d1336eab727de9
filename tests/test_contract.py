import dataclasses

import pytest

from rowgate import CleanseJob, Contract, dynamic, framework, standard
from rowgate.sources import table_names

COLUMNS = {"shop_id": "int", "name": "string", "day": "date"}


def test_flag_order_and_names():
    contract = Contract(COLUMNS, ["shop_id", "name"])
    assert contract.flag_names == [
        "_is_shop_id_invalid",
        "_is_day_invalid",
        "_is_shop_id_null",
        "_is_name_null",
        "_is_dup_row",
        "_is_dup_key",
    ]
    assert contract.data_columns == list(COLUMNS)


def test_presets():
    shape = (COLUMNS, ["shop_id"])
    assert [(c.null_policy, c.typed) for c in (standard(*shape), dynamic(*shape), framework(*shape))] == [
        ("pass", True),
        ("flag", True),
        ("flag", False),
    ]
    assert framework(*shape, typed=True).typed


@pytest.mark.parametrize(
    "columns, key, options",
    [
        ({}, ["a"], {}),
        (COLUMNS, [], {}),
        (COLUMNS, "shop_id", {}),
        (COLUMNS, ["other"], {}),
        (COLUMNS, ["name", "name"], {}),
        ({"a": "money"}, ["a"], {}),
        (COLUMNS, ["shop_id"], {"null_policy": "ignore"}),
        ({"a": "string", "A": "string"}, ["a"], {}),
        ({"a": "string", "_sk": "string"}, ["a"], {}),
        ({"a": "string", "reason": "string"}, ["a"], {}),
        ({"a": "string", "_is_a_null": "string"}, ["a"], {}),
        ({"a": "string", "_is_dup_key": "string"}, ["a"], {}),
        ({"a": "string", "_rowgate_hash": "string"}, ["a"], {}),
    ],
)
def test_rejected_contracts(columns, key, options):
    with pytest.raises(ValueError):
        Contract(columns, key, **options)


def test_a_sized_type_takes_the_rule_of_its_name():
    contract = Contract({"a": "decimal(12,2)", "b": "long"}, ["a"])
    assert contract.rule("a") == contract.rules["decimal"] and contract.rule("b") == contract.rules["int"]


def test_a_rule_adds_a_type():
    contract = Contract({"a": "code"}, ["a"], rules={"code": "^[A-Z]{3}$"})
    assert contract.invalid_flags == ["_is_a_invalid"]


def test_contract_does_not_change():
    contract = Contract(COLUMNS, ["shop_id"])
    with pytest.raises(dataclasses.FrozenInstanceError):
        contract.key = ["name"]
    with pytest.raises(TypeError):
        contract.columns["extra"] = "string"


def test_table_names():
    names = table_names("shops")
    assert names.bronze == "project.shops_bronze_framework"
    assert names.silver == "project.shops_silver_framework"
    assert names.bad == "project.shops_bad_framework"
    assert table_names("shop", "lake", "").silver == "lake.shop_silver"


def test_job_tables_must_differ():
    with pytest.raises(ValueError):
        CleanseJob(None, "p", Contract(COLUMNS, ["shop_id"]), source="db.a", good_table="db.A", bad_table="db.b")
