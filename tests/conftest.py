import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("rowgate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# A landing file of depots, one row class after another: how many rows, their fields, their reasons
# when nulls pass the format check. ``{n}`` is the row's place in its class.
SAMPLE_DAY = "2024-02-29"
SAMPLE_CLASSES = [
    (17, ("{n}1", "depot {n}", "dock {n}", SAMPLE_DAY), set()),  # sound
    (3, ("{n}1", "second name", "dock {n}", SAMPLE_DAY), {"_is_dup_key"}),  # keys of the first three again
    (2, (None, "no id {n}", "dock", SAMPLE_DAY), {"_is_depot_id_null"}),
    (2, ("A-{n}", "letters", "dock", SAMPLE_DAY), {"_is_depot_id_invalid"}),
    (1, ("9000", "short day", "dock", "240229"), {"_is_opened_invalid"}),
    (1, ("51", "short day", None, "240229"), {"_is_opened_invalid", "_is_dup_key"}),
    (1, ("61", None, None, SAMPLE_DAY), {"_is_dup_key"}),  # a null in an unchecked column
    (2, ("7000", "twin", "dock", SAMPLE_DAY), set()),  # a copy: the second one is marked below
    (12, ("80{n}", "8{n}", "007", SAMPLE_DAY), set()),  # digits in unchecked columns
]
CLASHING = range(6)  # the first rows of the first class share their key with later ones


def _sample():
    rows, reasons = [], {}
    for count, fields, marks in SAMPLE_CLASSES:
        for n in range(count):
            if marks:
                reasons[len(rows)] = set(marks)
            rows.append(tuple(f.format(n=n + 1) if f else None for f in fields))
    twins = [i for i, row in enumerate(rows) if row[0] == "7000"]
    reasons[twins[1]] = {"_is_dup_row"}
    for i in CLASHING:
        if rows[i][0] in {row[0] for row in rows[17:]}:
            reasons[i] = {"_is_dup_key"}
    return rows, reasons


@pytest.fixture(scope="session")
def sample_rows():
    return _sample()[0]


@pytest.fixture(scope="session")
def sample_file(tmp_path_factory, sample_rows):
    path = tmp_path_factory.mktemp("landing") / "depots.csv"
    lines = ["depot_id|depot_name|dock|opened"]
    lines += ["|".join(value or "" for value in row) for row in sample_rows]
    path.write_text("\n".join(lines))
    return str(path)


@pytest.fixture(scope="session")
def sample_columns():
    return {"depot_id": "int", "depot_name": "string", "dock": "string", "opened": "date"}


@pytest.fixture(scope="session")
def sample_reasons():
    """Row number -> reasons, for each null policy."""
    passing = _sample()[1]
    flagged = {
        number: reasons | {"_is_depot_id_invalid"} if "_is_depot_id_null" in reasons else reasons
        for number, reasons in passing.items()
    }
    return {"pass": passing, "flag": flagged}
