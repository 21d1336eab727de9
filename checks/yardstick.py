"""The cleansing job against the same split built the plain way: one record set after another.

The plain build numbers the copies of a row by a window over all columns, counts the rows of a key
by another, takes each set out of the rest by an anti join, and writes quarantine and clean rows as
two actions with nothing kept between them. It is what a pipeline of single steps costs on Spark.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.defects import COLUMNS, contract, defect_orders
from checks.queries import scratch_schema
from rowgate import CleanseJob
from rowgate.contract import DATE_RULE, INT_RULE
from rowgate.operators import typed
from rowgate.sources import read_table, write_table

ID = "_sk"


def _reasoned(df: DataFrame, flag, reason: str) -> DataFrame:
    return df.where(flag).withColumn("reason", F.lit(reason))


def _without(df: DataFrame, taken: DataFrame) -> DataFrame:
    return df.join(taken.select(ID), ID, "left_anti")


def plain_split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quarantined rows with their reasons, and the clean rows."""
    broken = [
        _reasoned(rows, F.coalesce(~F.col("order_id").rlike(INT_RULE), F.lit(False)), "_is_order_id_invalid"),
        _reasoned(rows, F.coalesce(~F.col("file_dt").rlike(DATE_RULE), F.lit(False)), "_is_file_dt_invalid"),
    ]
    keyless = _reasoned(rows, F.col("order_id").isNull(), "_is_order_id_null")
    base = _without(rows, keyless)
    copy = F.row_number().over(Window.partitionBy(*COLUMNS).orderBy(ID))
    copies = _reasoned(base.withColumn("n", copy), F.col("n") > 1, "_is_dup_row").drop("n")
    rest = _without(base, copies)
    sharing = F.count("*").over(Window.partitionBy("order_id"))
    clashing = _reasoned(rest.withColumn("n", sharing), F.col("n") > 1, "_is_dup_key").drop("n")
    together = broken[0]
    for part in (broken[1], keyless, copies, clashing):
        together = together.unionByName(part)
    bad = together.groupBy(ID, *COLUMNS).agg(F.collect_list("reason").alias("reason"))
    return bad, _without(rows, bad)


def seconds(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Time for both ways over the orders with defects, each with both writes."""
    schema = scratch_schema(spark)
    write_table(defect_orders(spark, sf_dir).withColumnRenamed("rid", ID), f"{schema}.raw")
    shape = contract("pass").with_options(row_id=ID)
    start = time.perf_counter()
    bad, good = plain_split(read_table(spark, f"{schema}.raw"))
    write_table(bad, f"{schema}.plain_bad")
    write_table(typed(good, shape), f"{schema}.plain_good")
    plain = time.perf_counter() - start
    names = {"source": f"{schema}.raw", "good_table": f"{schema}.good", "bad_table": f"{schema}.bad"}
    start = time.perf_counter()
    clean, quarantine = CleanseJob(spark, "orders", shape, **names).run()
    job = time.perf_counter() - start
    sizes = [(read_table(spark, f"{schema}.plain_{side}").count(), df.count()) for side, df in (("bad", quarantine), ("good", clean))]
    if any(a != b for a, b in sizes):
        raise AssertionError(f"the two ways disagree: {sizes}")
    return {"plain": round(plain, 3), "job": round(job, 3)}
