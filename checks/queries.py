"""One query per operator over the test tables. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.defects import COLUMNS, contract, defect_orders
from rowgate import CleanseJob, Contract, IngestJob, Staging, bad, good, reason_counts, score
from rowgate.functions import any_flag, invalid_flags, null_flags
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
    select_data,
    typed,
    union_records,
    with_flags,
    with_row_id,
)
from rowgate.sources import (
    detect_format,
    ensure_schema,
    preview,
    read_by_header,
    read_raw,
    read_table,
    replace_partitions,
    table_names,
    with_file_lineage,
    with_load_time,
    write_table,
)

IDS = ["rid", *COLUMNS]
# The large-table plans, also where the table is small: with few repeated keys, and with many.
FEW_REPEATED = {"window_rows": 1}
MANY_REPEATED = {"window_rows": 2, "broadcast_rows": 100}
NO_BITMAP = {**MANY_REPEATED, "bitmap_rows": 0}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listed(df: DataFrame) -> DataFrame:
    """Reasons as one sorted, comma-separated string."""
    return df.withColumn("reason", F.array_join(F.array_sort("reason"), ","))


def count_rows(name: str):
    return F.count(F.lit(1)).alias(name)


def scratch_schema(spark: SparkSession) -> str:
    """A schema of its own for each run, its tables in the shared folder."""
    name, staging = f"rowgate_{uuid.uuid4().hex[:12]}", Staging(spark)
    ensure_schema(spark, name, staging.path("tables"))
    staging.delete_at_end()
    return name


# Scans, sources, sinks


def table_scan(spark, sf_dir):
    schema = scratch_schema(spark)
    ensure_schema(spark, schema)
    write_table(table(spark, sf_dir, "orders"), f"{schema}.orders")
    return read_table(spark, f"{schema}.orders")


def explicit_projection(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("helper", F.col("o_orderkey") + 1)
    return orders.withColumn("next_key", F.col("helper")).drop("helper").select(
        F.col("o_orderkey").alias("order_id"), "next_key", "o_orderstatus", "o_orderpriority"
    )


def schema_projection(spark, sf_dir):
    shape = Contract({"c_name": "string", "c_custkey": "int", "c_mktsegment": "string"}, ["c_custkey"])
    return select_data(table(spark, sf_dir, "customer"), shape)


def limit_preview(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), 5, ["o_orderkey"])


def customer_strings(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
    )


def csv_scan(spark, sf_dir):
    landing = Staging(spark).path("customer.csv")
    customer_strings(spark, sf_dir).write.csv(landing, sep="|", header=True)
    return read_raw(spark, landing, format_type="csv", delimiter="|", header=True)


def csv_scan_declared_columns(spark, sf_dir):
    landing = Staging(spark).path("customer.tsv")
    rows = customer_strings(spark, sf_dir)
    rows.write.csv(landing, sep="\t", header=True, compression="gzip")
    return read_raw(spark, landing, delimiter="\t", columns=rows.columns)


def detected_format_scan(spark, sf_dir):
    """The same rows landed in each format; the reader is chosen by the path's ending."""
    staging = Staging(spark)
    rows = customer_strings(spark, sf_dir)
    writers = {
        "csv": {"sep": "|", "header": True},
        "json": {},
        "parquet": {},
        "orc": {},
        "xml": {"rowTag": "customer"},
    }
    scans = []
    for ending, options in writers.items():
        landing = staging.path(f"customer.{ending}")
        rows.write.format(ending).options(**options).save(landing)
        reader_options = {"rowTag": "customer", "inferSchema": False} if ending == "xml" else {}
        scan = read_raw(spark, landing, options=reader_options)
        scans.append(scan.select(F.lit(detect_format(landing)).alias("format"), *rows.columns))
    lines = staging.path("customer.text")
    rows.select("c_name").write.text(lines)
    empty = [F.lit(None).cast("string").alias(c) for c in rows.columns if c != "c_name"]
    scans.append(read_raw(spark, lines).select(F.lit("text").alias("format"), F.col("value").alias("c_name"), *empty))
    together = scans[0]
    for scan in scans[1:]:
        together = together.unionByName(scan)
    return together


def lineage_columns(spark, sf_dir):
    scan = with_file_lineage(with_load_time(read_raw(spark, f"{sf_dir}/orders.parquet"), "_"))
    return scan.select(
        "o_orderkey",
        "_file_name",
        F.col("_file_path").endswith("/orders.parquet").alias("path_ends"),
        (F.col("_file_size") > 0).alias("has_size"),
        F.col("_file_mod").isNotNull().alias("has_mod"),
        (F.col("_load_dt") == F.to_date("_load_dttm")).alias("load_day_matches"),
    )


def table_overwrite_roundtrip(spark, sf_dir):
    name = f"{scratch_schema(spark)}.customer"
    customers = table(spark, sf_dir, "customer")
    write_table(customers.withColumn("c_name", F.lit("old")), name)
    write_table(customers, name, "overwrite")
    return read_table(spark, name)


def table_append_roundtrip(spark, sf_dir):
    name = f"{scratch_schema(spark)}.customer"
    customers = table(spark, sf_dir, "customer")
    write_table(customers, name, "error")
    write_table(customers, name, "append", even_files=True)
    write_table(customers, name, "ignore")
    return read_table(spark, name)


def pipeline_tables(spark, sf_dir):
    names = table_names("supplier", schema=scratch_schema(spark))
    suppliers = table(spark, sf_dir, "supplier")
    for layer, name in (("bronze", names.bronze), ("silver", names.silver), ("bad", names.bad)):
        write_table(suppliers.withColumn("layer", F.lit(layer)), name)
    written = [read_table(spark, name) for name in (names.bronze, names.silver, names.bad)]
    return written[0].unionByName(written[1]).unionByName(written[2])


def ingest_job(spark, sf_dir):
    landing = Staging(spark).path("customer.csv")
    customer_strings(spark, sf_dir).write.csv(landing, sep="|", header=True)
    job = IngestJob(spark, "customer", landing, table=f"{scratch_schema(spark)}.customer_bronze")
    raw = job.run()
    complete = F.col("_load_dt").isNotNull() & F.col("_load_dttm").isNotNull() & F.col("_file_mod").isNotNull()
    return raw.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
        complete.alias("has_times"),
        (F.col("_file_path").endswith(F.col("_file_name")) & (F.col("_file_size") > 0)).alias("has_file"),
    )


# Row numbers and flags


def surrogate_key_unique(spark, sf_dir):
    lines = Contract({"l_orderkey": "int", "l_linenumber": "int"}, ["l_orderkey", "l_linenumber"])
    numbered = with_row_id(table(spark, sf_dir, "lineitem"), lines)
    return numbered.agg(
        count_rows("row_count"),
        F.count_distinct("_sk").alias("distinct_ids"),
        F.count_if(F.col("_sk") < 0).alias("negative_ids"),
    )


def format_flags(policy):
    def query(spark, sf_dir):
        flagged = with_flags(defect_orders(spark, sf_dir), invalid_flags(contract(policy)))
        return flagged.select("rid", "_is_order_id_invalid", "_is_file_dt_invalid")

    return query


def flagged_rows_filter(spark, sf_dir):
    flags = {**invalid_flags(contract()), **null_flags(["order_id"])}
    df = with_flags(defect_orders(spark, sf_dir), flags)
    return df.where(any_flag([F.col(name) for name in flags])).select("rid", *flags)


def format_flags_lineitem(spark, sf_dir):
    lines = Contract(
        {"l_orderkey": "int", "l_quantity": "int", "l_shipdate": "date"},
        ["l_orderkey"],
        null_policy="flag",
    )
    df = table(spark, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("decimal(9,1)"))
    flags = invalid_flags(lines)
    counts = with_flags(df, flags).groupBy("l_returnflag").agg(
        *[F.count_if(name).alias(name) for name in flags], count_rows("row_count")
    )
    return counts


TYPED_LINES = {
    "l_orderkey": "bigint",
    "l_linenumber": "long",
    "l_quantity": "double",
    "l_extendedprice": "decimal(12,2)",
    "shipped": "timestamp",
    "returned": "boolean",
}


def typed_format_flags(spark, sf_dir):
    """Every line item as strings of all checked types, with defects by arithmetic; how many break which rule."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    quantity = F.col("l_quantity").cast("int").cast("string")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.when(k % 37 == 0, F.concat(F.lit("-"), k)).otherwise(k.cast("string")).alias("l_orderkey"),
        F.when(k % 41 == 0, F.concat(n, F.lit("L"))).otherwise(n.cast("string")).alias("l_linenumber"),
        F.when(n == 2, F.concat(quantity, F.lit("e1"))).when(n == 3, F.concat(quantity, F.lit("e"))).otherwise(quantity).alias("l_quantity"),
        F.when(n == 4, F.concat(F.lit("$"), price)).when(n == 5, F.concat(F.lit("-"), price)).otherwise(price).alias("l_extendedprice"),
        F.when(n == 1, F.substring(shipped, 1, 10)).when(n == 2, F.translate(shipped, " ", "T")).otherwise(shipped).alias("shipped"),
        F.when(n == 6, "yes").when(n == 1, "TRUE").when(n > 6, F.lit(None)).otherwise("false").alias("returned"),
    )
    shape = Contract(TYPED_LINES, ["l_orderkey", "l_linenumber"])
    flags = invalid_flags(shape)
    counted = with_flags(lines, flags).groupBy("l_returnflag")
    return counted.agg(*[F.count_if(name).alias(name) for name in flags], count_rows("row_count"))


def csv_scan_many_files(spark, sf_dir):
    """A landing folder with a file per nation; every header is checked against the first."""
    landing = Staging(spark).path("customers.csv")
    rows = customer_strings(spark, sf_dir)
    rows.repartition(8, "c_nationkey").write.csv(landing, sep="|", header=True)
    return read_raw(spark, landing)


def broken_lines(spark, sf_dir, staging):
    """Customers as lines of a file; every seventh has a spare field, of the others every eleventh lacks one."""
    k = F.col("c_custkey")
    whole = F.concat_ws("|", k, "c_name", "c_nationkey")
    line = F.when(k % 7 == 0, F.concat(whole, F.lit("|spare"))).when(k % 11 == 0, F.concat_ws("|", k, "c_name")).otherwise(whole)
    landing = staging.path("customer.csv")
    table(spark, sf_dir, "customer").select(line).write.text(landing)
    return landing


LINE_COLUMNS = {"c_custkey": "int", "c_name": "string", "c_nationkey": "int"}


def csv_scan_broken_lines(spark, sf_dir):
    landing = broken_lines(spark, sf_dir, Staging(spark))
    return read_raw(spark, landing, header=False, columns=list(LINE_COLUMNS), rescue="line")


def quarantine_broken_lines(spark, sf_dir):
    """The lines landed and cleansed: those that do not fit are in quarantine as they were."""
    schema, landing = scratch_schema(spark), broken_lines(spark, sf_dir, Staging(spark))
    raw = f"{schema}.lines"
    IngestJob(spark, "lines", landing, raw, header=False, columns=list(LINE_COLUMNS), rescue="line").run()
    shape = Contract(LINE_COLUMNS, ["c_custkey"], null_policy="pass", rescue="line")
    clean_rows, bad_rows = CleanseJob(spark, "lines", shape, raw, f"{schema}.good", f"{schema}.bad").run()
    data = [F.col(name).cast("string").alias(name) for name in LINE_COLUMNS]
    nothing = F.lit(None).cast("string").alias("line")
    return clean_rows.select(F.lit("good").alias("side"), *data, nothing, F.lit("").alias("reason")).unionByName(
        listed(bad_rows).select(F.lit("bad").alias("side"), *data, "line", "reason")
    )


def csv_scan_by_header(spark, sf_dir):
    """Files of three headers: two orders of the columns, and one without the last column."""
    rows, staging = customer_strings(spark, sf_dir), Staging(spark)
    headers = [rows.columns, rows.columns[::-1], rows.columns[:-1]]
    for number, names in enumerate(headers):
        part = rows.where(F.col("c_custkey").cast("long") % 3 == number).select(*names)
        part.write.csv(staging.path(f"landing/customer{number}"), sep="|", header=True)
    return read_by_header(spark, staging.path("landing/*"), columns=rows.columns)


def ingest_new_files(spark, sf_dir):
    """Landed in two lots with a run after each, and one more run: every customer is there once."""
    rows, staging, name = customer_strings(spark, sf_dir), Staging(spark), f"{scratch_schema(spark)}.customer"
    columns = list(rows.columns)
    job = IngestJob(spark, "customer", staging.path("landing"), name, format_type="csv", columns=columns)
    for lot in (0, 1):
        part = rows.where(F.col("c_custkey").cast("long") % 2 == lot)
        part.write.mode("append").csv(staging.path("landing"), sep="|", header=True)
        job.run_new_files(staging.path("checkpoint"))
    return job.run_new_files(staging.path("checkpoint")).select(*columns)


def replaced_partitions(spark, sf_dir):
    """Orders loaded by status, then one status loaded again."""
    name = f"{scratch_schema(spark)}.orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    replace_partitions(orders, name, ["o_orderstatus"])
    again = orders.where("o_orderstatus = 'F'").withColumn("o_orderpriority", F.lit("again"))
    replace_partitions(again, name, ["o_orderstatus"])
    return read_table(spark, name)


def strict_format_flags(spark, sf_dir):
    """A month of 13 passes the format rule but not the strict check."""
    df = defect_orders(spark, sf_dir)
    odd = df.withColumn("file_dt", F.regexp_replace("file_dt", "-12-", "-13-"))
    return with_flags(odd, invalid_flags(contract("pass", strict=True))).select(
        "rid", "_is_order_id_invalid", "_is_file_dt_invalid"
    )


# Record sets


def invalid(policy):
    def query(spark, sf_dir):
        return listed(invalid_records(defect_orders(spark, sf_dir), contract(policy)))

    return query


def null_keys(spark, sf_dir):
    return listed(null_key_records(defect_orders(spark, sf_dir), contract()))


def composite_null_keys(spark, sf_dir):
    shape = contract().with_options(key=["order_id", "priority"])
    return listed(null_key_records(defect_orders(spark, sf_dir), shape))


def base_of_defects(spark, sf_dir):
    return nonnull_base(defect_orders(spark, sf_dir), contract())


def base_by_anti_join(spark, sf_dir):
    df = defect_orders(spark, sf_dir)
    return rows_without(df, null_key_records(df, contract()), "rid")


def row_number_all_columns(spark, sf_dir):
    return copy_numbers(base_of_defects(spark, sf_dir), list(COLUMNS), "rid")


def row_number_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return copy_numbers(documents, ["text"], "doc_id").select("doc_id", "source", "rn")


def row_number_parts_sliced(spark, sf_dir):
    """Few distinct rows, so every group is cut into slices of 8 row numbers, 8 slices to a block."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return copy_numbers(parts, ["p_type"], "p_partkey", slice_bits=3, row_id_bits=9)


def count_over_key(spark, sf_dir):
    return key_counts(base_of_defects(spark, sf_dir), ["order_id"], "rid").select("rid", "order_id", "rn")


def count_over_key_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return key_counts(events, ["user_id", "event_type"], "event_id")


def count_over_key_events_sliced(spark, sf_dir):
    """Every event type is beyond 100 rows, so its rows are counted in slices."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return key_counts(events, ["event_type"], "event_id", large_rows=100)


def row_dups(spark, sf_dir):
    return listed(row_duplicates(base_of_defects(spark, sf_dir), contract()))


DOCUMENTS = Contract({"text": "string", "lang": "string", "source": "string"}, ["text"], row_id="doc_id")


def row_duplicates_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return row_duplicates(documents, DOCUMENTS).select("doc_id", "lang", "source")


def key_dups(spark, sf_dir):
    return listed(key_duplicates(base_of_defects(spark, sf_dir), contract()))


def lineitem_rows(spark, sf_dir):
    """Line items as strings, numbered. They are kept, as several scans must see the same numbers."""
    shape = Contract(
        {"l_orderkey": "bigint", "l_linenumber": "int", "l_returnflag": "string", "l_shipdate": "date"},
        ["l_orderkey", "l_linenumber"],
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )
    return Staging(spark).keep(with_row_id(lines, shape), "rows"), shape


def key_duplicates_lineitem(spark, sf_dir):
    lines, shape = lineitem_rows(spark, sf_dir)
    return key_duplicates(lines, shape).select(*shape.columns)


def key_duplicates_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return key_duplicates(documents, DOCUMENTS).select("doc_id", "lang", "source")


def all_dups(by_name):
    """Both record sets below one another; the operator that gives them in one pass must agree."""

    def query(spark, sf_dir):
        base = base_of_defects(spark, sf_dir)
        parts = [row_duplicates(base, contract()), key_duplicates(base, contract())]
        return listed(union_records(parts, by_name))

    return query


def all_duplicates_in_one_pass(spark, sf_dir):
    return listed(all_duplicates(base_of_defects(spark, sf_dir), contract()))


def later_copies(spark, sf_dir):
    """A filter on a window's result: every copy of an order but the first."""
    return row_number_all_columns(spark, sf_dir).where(F.col("rn") > 1)


def melted_flags(spark, sf_dir):
    flags = {**invalid_flags(contract()), **null_flags(["order_id"])}
    df = with_flags(defect_orders(spark, sf_dir), flags)
    return melt_flags(df, IDS, list(flags), sort_by=["rid"])


def collected_reasons(spark, sf_dir):
    flags = {**invalid_flags(contract()), **null_flags(["order_id"])}
    df = with_flags(defect_orders(spark, sf_dir), flags)
    return listed(melt_flags(df, IDS, list(flags)).transform(collect_reasons, "rid"))


def reasons_by_naming_convention(spark, sf_dir):
    """The names of the flag columns follow from the contract."""
    shape = contract().with_options(key=["order_id", "priority"])
    df = with_flags(defect_orders(spark, sf_dir), null_flags(shape.key))
    return listed(flagged_records(df, IDS, shape.null_flags))


def flattened_reasons(spark, sf_dir):
    df = defect_orders(spark, sf_dir)
    parts = [invalid_records(df, contract()), null_key_records(df, contract())]
    return listed(merge_reasons(parts, "rid"))


def staged_quarantine(policy):
    """The quarantine set put together from the single record sets."""

    def build(spark, sf_dir):
        df, shape = defect_orders(spark, sf_dir), contract(policy)
        dups = all_duplicates(nonnull_base(df, shape), shape)
        return df, merge_reasons([invalid_records(df, shape), null_key_records(df, shape), dups], "rid")

    return build


def merged_quarantine(spark, sf_dir):
    return listed(staged_quarantine("flag")(spark, sf_dir)[1])


def good_by_anti_join(spark, sf_dir):
    df, quarantined = staged_quarantine("flag")(spark, sf_dir)
    return good_records(df, quarantined, contract())


# Whole scoring


def quarantine(policy, sizes=None):
    def query(spark, sf_dir):
        shape = contract(policy)
        return listed(bad(score(defect_orders(spark, sf_dir), shape, **(sizes or {})), shape))

    return query


def clean(spark, sf_dir, **options):
    shape = contract("flag", **options)
    scored = score(defect_orders(spark, sf_dir), shape)
    return typed(good(scored, shape), shape)


def good_typed(spark, sf_dir):
    return clean(spark, sf_dir).select(
        "order_id",
        F.typeof("order_id").alias("id_type"),
        "status",
        "priority",
        F.col("file_dt").cast("string").alias("file_dt"),
        F.typeof("file_dt").alias("day_type"),
    )


def good_untyped(spark, sf_dir):
    return clean(spark, sf_dir, typed=False)


def quarantine_documents(spark, sf_dir):
    scored = score(table(spark, sf_dir, "documents"), DOCUMENTS)
    return listed(bad(scored, DOCUMENTS)).select("doc_id", "lang", "source", "reason")


def quarantine_events(spark, sf_dir):
    """Events as strings: most users repeat, so nearly every row is a duplicate of some kind."""
    shape = Contract(
        {"user_id": "int", "event_type": "string", "value": "int"}, ["user_id", "value"], row_id="event_id"
    )
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.round("value").cast("bigint").cast("string").alias("value"),
    )
    return listed(bad(score(events, shape, **MANY_REPEATED), shape))


def quarantine_events_by_type(spark, sf_dir):
    """Five keys hold all events, far more than one window takes here: joined by row number."""
    shape = Contract({"event_type": "string", "user_id": "int"}, ["event_type"], row_id="event_id")
    events = table(spark, sf_dir, "events")
    return listed(bad(score(events, shape, window_rows=10, broadcast_rows=100), shape))


def counted_reasons(shape_of, sizes=None):
    def query(spark, sf_dir):
        df, shape = shape_of(spark, sf_dir)
        counts = reason_counts(score(df, shape, **(sizes or {})))
        return counts.select("reason", F.col("rows").alias("row_count"))

    return query


def defect_shape(spark, sf_dir):
    return defect_orders(spark, sf_dir), contract()


def dual_write_roundtrip(spark, sf_dir):
    """The cleansing job over a stored table: both written tables, told apart by ``side``."""
    schema = scratch_schema(spark)
    write_table(defect_orders(spark, sf_dir).drop("rid"), f"{schema}.orders_bronze")
    job = CleanseJob(
        spark,
        "orders",
        contract("pass", typed=True).with_options(row_id="_sk"),
        source=f"{schema}.orders_bronze",
        good_table=f"{schema}.orders_silver",
        bad_table=f"{schema}.orders_bad",
    )
    clean_rows, bad_rows = job.run()
    raw = [F.col(name).cast("string").alias(name) for name in COLUMNS]
    loaded = F.col("load_dt").isNotNull() & F.col("load_dttm").isNotNull()
    good_side = clean_rows.select(F.lit("good").alias("side"), *raw, F.lit("").alias("reason"), loaded.alias("loaded"))
    bad_side = listed(bad_rows).select(F.lit("bad").alias("side"), *raw, "reason", F.lit(False).alias("loaded"))
    return good_side.unionByName(bad_side)


def dual_write_bucketed(spark, sf_dir):
    """The cleansing job over a bucketed table, by the plan for large tables with few repeated keys."""
    schema = scratch_schema(spark)
    rows = defect_orders(spark, sf_dir).drop("rid")
    rows.write.bucketBy(7, "order_id").sortBy("status").saveAsTable(f"{schema}.raw")
    shape = contract("pass", typed=False).with_options(row_id="_sk")
    tables = {"source": f"{schema}.raw", "good_table": f"{schema}.good", "bad_table": f"{schema}.bad"}
    clean_rows, bad_rows = CleanseJob(spark, "orders", shape, **tables, **FEW_REPEATED).run()
    good_side = clean_rows.select(F.lit("good").alias("side"), *COLUMNS, F.lit("").alias("reason"))
    # Which copy is the first depends on where rows lie, so copies are told apart by their number only.
    return good_side.unionByName(listed(bad_rows).select(F.lit("bad").alias("side"), *COLUMNS, "reason"))


def dual_write_many_files(spark, sf_dir):
    """The cleansing job where the files are too many to number: row numbers hold a hash of the path."""
    schema = scratch_schema(spark)
    defect_orders(spark, sf_dir).drop("rid").repartition(9, "status", "file_dt").write.saveAsTable(f"{schema}.raw")
    shape = contract("pass", typed=False).with_options(row_id="_sk")
    tables = {"source": f"{schema}.raw", "good_table": f"{schema}.good", "bad_table": f"{schema}.bad"}
    clean_rows, bad_rows = CleanseJob(spark, "orders", shape, **tables, broadcast_files=1).run()
    good_side = clean_rows.select(F.lit("good").alias("side"), *COLUMNS, F.lit("").alias("reason"))
    return good_side.unionByName(listed(bad_rows).select(F.lit("bad").alias("side"), *COLUMNS, "reason"))


def appends_with_known_keys(spark, sf_dir):
    """The defect orders loaded in three appends that keep keys: the split is that of one run."""
    schema = scratch_schema(spark)
    shape = contract("pass", typed=False).with_options(row_id="_sk")
    tables = {"source": f"{schema}.raw", "good_table": f"{schema}.good", "bad_table": f"{schema}.bad"}
    job = CleanseJob(spark, "orders", shape, **tables, mode="append", keep_keys=True, key_buckets=8)
    for lot in range(3):
        write_table(defect_orders(spark, sf_dir).where(F.col("rid") % 3 == lot).drop("rid"), f"{schema}.raw")
        clean_rows, bad_rows = job.run()
    good_side = clean_rows.select(F.lit("good").alias("side"), *COLUMNS, F.lit("").alias("reason"))
    return good_side.unionByName(listed(bad_rows).select(F.lit("bad").alias("side"), *COLUMNS, "reason"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "table_scan": table_scan,
        "explicit_projection": explicit_projection,
        "schema_projection": schema_projection,
        "limit_preview": limit_preview,
        "csv_scan": csv_scan,
        "csv_scan_many_files": csv_scan_many_files,
        "csv_scan_declared_columns": csv_scan_declared_columns,
        "csv_scan_broken_lines": csv_scan_broken_lines,
        "csv_scan_by_header": csv_scan_by_header,
        "detected_format_scan": detected_format_scan,
        "lineage_columns": lineage_columns,
        "table_overwrite_roundtrip": table_overwrite_roundtrip,
        "table_append_roundtrip": table_append_roundtrip,
        "pipeline_tables": pipeline_tables,
        "ingest_job": ingest_job,
        "ingest_new_files": ingest_new_files,
        "replaced_partitions": replaced_partitions,
        "surrogate_key_unique": surrogate_key_unique,
        "format_flags_null_pass": format_flags("pass"),
        "format_flags_null_flag": format_flags("flag"),
        "format_flags_lineitem": format_flags_lineitem,
        "typed_format_flags": typed_format_flags,
        "strict_format_flags": strict_format_flags,
        "flagged_rows_filter": flagged_rows_filter,
        "invalid_records_pass": invalid("pass"),
        "invalid_records_flag": invalid("flag"),
        "null_key_records": null_keys,
        "composite_null_key_records": composite_null_keys,
        "nonnull_base": base_of_defects,
        "nonnull_base_anti_join": base_by_anti_join,
        "row_number_all_columns": row_number_all_columns,
        "later_copies": later_copies,
        "row_number_documents": row_number_documents,
        "row_number_parts_sliced": row_number_parts_sliced,
        "count_over_key": count_over_key,
        "count_over_key_events": count_over_key_events,
        "count_over_key_events_sliced": count_over_key_events_sliced,
        "row_duplicates": row_dups,
        "row_duplicates_documents": row_duplicates_documents,
        "key_duplicates": key_dups,
        "key_duplicates_lineitem": key_duplicates_lineitem,
        "key_duplicates_documents": key_duplicates_documents,
        "all_duplicates_by_name": all_dups(True),
        "all_duplicates_by_position": all_dups(False),
        "all_duplicates_in_one_pass": all_duplicates_in_one_pass,
        "melt_flags": melted_flags,
        "collect_reasons": collected_reasons,
        "reasons_by_naming_convention": reasons_by_naming_convention,
        "flatten_reasons": flattened_reasons,
        "merged_quarantine": merged_quarantine,
        "good_records": good_by_anti_join,
        "quarantine_standard": quarantine("pass"),
        "quarantine_framework": quarantine("flag"),
        "quarantine_few_repeated": quarantine("flag", FEW_REPEATED),
        "quarantine_many_repeated": quarantine("flag", MANY_REPEATED),
        "quarantine_without_bitmap": quarantine("flag", NO_BITMAP),
        "quarantine_documents": quarantine_documents,
        "quarantine_events": quarantine_events,
        "quarantine_events_by_type": quarantine_events_by_type,
        "good_typed": good_typed,
        "good_untyped": good_untyped,
        "dual_write_bucketed": dual_write_bucketed,
        "appends_with_known_keys": appends_with_known_keys,
        "dual_write_many_files": dual_write_many_files,
        "dual_write_roundtrip": dual_write_roundtrip,
        "quarantine_broken_lines": quarantine_broken_lines,
        "reason_counts": counted_reasons(defect_shape),
        "reason_counts_lineitem": counted_reasons(lineitem_rows),
        "reason_counts_lineitem_large": counted_reasons(lineitem_rows, MANY_REPEATED),
    }
