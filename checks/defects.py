"""Orders read as strings, with defects worked into them.

The test tables are clean, so every check needs rows that fail it. All orders are present;
arithmetic on the order key says which get a defect, and some are added again as a copy or as
a second row of the same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.contract import Contract

COLUMNS = {"order_id": "bigint", "status": "string", "priority": "string", "file_dt": "date"}


def contract(null_policy: str = "flag", **options) -> Contract:
    return Contract(COLUMNS, ["order_id"], null_policy=null_policy, row_id="rid", **options)


def defect_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind = F.col("o_orderkey"), F.col("kind")  # kind: 0 the order itself, 1 a copy, 2 a key clash
    kinds = F.array_compact(F.array(F.lit(0), F.when(k % 41 == 0, 1), F.when(k % 43 == 0, 2)))
    plain_id = k.cast("string")
    broken_id = F.when(k % 50 != 0, F.when(k % 53 == 0, F.concat(F.lit("x"), plain_id)).otherwise(plain_id))
    iso_day = F.date_format("o_orderdate", "yyyy-MM-dd")
    short_day = F.date_format("o_orderdate", "yyyyMMdd")
    broken_day = F.when(k % 47 == 0, short_day).otherwise(F.when(k % 59 != 0, iso_day))
    broken_priority = F.when(k % 31 != 0, F.col("o_orderpriority"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("*", F.explode(kinds).alias("kind")).select(
        (k * 10 + kind).alias("rid"),
        F.when(kind == 0, broken_id).otherwise(plain_id).alias("order_id"),
        F.when(kind == 2, "Z").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(kind == 2, F.col("o_orderpriority")).otherwise(broken_priority).alias("priority"),
        F.when(kind == 2, iso_day).otherwise(broken_day).alias("file_dt"),
    )
