"""Each query of ``checks.queries`` as plain SQL over the same tables, written on its own."""

from __future__ import annotations

DEFECTS = r"""
defects AS (
    SELECT o_orderkey * 10 AS rid,
           CASE WHEN o_orderkey % 50 = 0 THEN NULL
                WHEN o_orderkey % 53 = 0 THEN 'x' || CAST(o_orderkey AS VARCHAR)
                ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
           o_orderstatus AS status,
           CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderpriority END AS priority,
           CASE WHEN o_orderkey % 47 = 0 THEN strftime(o_orderdate, '%Y%m%d')
                WHEN o_orderkey % 59 = 0 THEN NULL
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS file_dt
    FROM orders
    UNION ALL
    SELECT o_orderkey * 10 + 1, CAST(o_orderkey AS VARCHAR), o_orderstatus,
           CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderpriority END,
           CASE WHEN o_orderkey % 47 = 0 THEN strftime(o_orderdate, '%Y%m%d')
                WHEN o_orderkey % 59 = 0 THEN NULL
                ELSE strftime(o_orderdate, '%Y-%m-%d') END
    FROM orders WHERE o_orderkey % 41 = 0
    UNION ALL
    SELECT o_orderkey * 10 + 2, CAST(o_orderkey AS VARCHAR), 'Z', o_orderpriority,
           strftime(o_orderdate, '%Y-%m-%d')
    FROM orders WHERE o_orderkey % 43 = 0
)"""

# The two format rules and, further down, the names of the flags.
INT = "'^[0-9]+$'"
DAY = r"'\d{4}-\d{2}-\d{2}$'"
DATA = "order_id, status, priority, file_dt"


def _checks(policy: str) -> str:
    """``flagged``: every defect row with each check's outcome."""
    null_is_invalid = "TRUE" if policy == "flag" else "FALSE"
    return f"""
{DEFECTS},
numbered AS (
    SELECT rid, row_number() OVER (PARTITION BY {DATA} ORDER BY rid) AS copy_no
    FROM defects WHERE order_id IS NOT NULL
),
crowded AS (
    SELECT order_id FROM defects JOIN numbered USING (rid)
    WHERE copy_no = 1 GROUP BY order_id HAVING count(*) > 1
),
flagged AS (
    SELECT d.*,
           coalesce(NOT regexp_matches(d.order_id, {INT}), {null_is_invalid}) AS id_invalid,
           coalesce(NOT regexp_matches(d.file_dt, {DAY}), {null_is_invalid}) AS day_invalid,
           d.order_id IS NULL AS id_null,
           coalesce(n.copy_no > 1, FALSE) AS dup_row,
           coalesce(n.copy_no = 1, FALSE) AND d.order_id IN (SELECT order_id FROM crowded) AS dup_key
    FROM defects d LEFT JOIN numbered n USING (rid)
)"""


# Comma-separated in the order a sorted list of the names has.
REASONS = {
    "dup_key": "_is_dup_key",
    "dup_row": "_is_dup_row",
    "day_invalid": "_is_file_dt_invalid",
    "id_invalid": "_is_order_id_invalid",
    "id_null": "_is_order_id_null",
}


def _records(policy: str, *flags: str) -> str:
    """Rows with any of ``flags`` and the list of those they have."""
    names = ", ".join(f"CASE WHEN {f} THEN '{REASONS[f]}' END" for f in REASONS if f in flags)
    return f"""WITH {_checks(policy)}
SELECT rid, {DATA}, concat_ws(',', {names}) AS reason
FROM flagged WHERE {' OR '.join(flags)}"""


EVERY = tuple(REASONS)

NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)"
TYPED_LINES = f"""
    WITH shown AS (
        SELECT l_returnflag, l_orderkey AS k, l_linenumber AS n,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ship,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
               CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity
        FROM lineitem
    ), lines AS (
        SELECT l_returnflag,
               CASE WHEN k % 37 = 0 THEN '-' || k ELSE CAST(k AS VARCHAR) END AS l_orderkey,
               CASE WHEN k % 41 = 0 THEN n || 'L' ELSE CAST(n AS VARCHAR) END AS l_linenumber,
               CASE n WHEN 2 THEN quantity || 'e1' WHEN 3 THEN quantity || 'e' ELSE quantity END AS l_quantity,
               CASE n WHEN 4 THEN '$' || price WHEN 5 THEN '-' || price ELSE price END AS l_extendedprice,
               CASE n WHEN 1 THEN ship[:10] WHEN 2 THEN replace(ship, ' ', 'T') ELSE ship END AS shipped,
               CASE WHEN n = 6 THEN 'yes' WHEN n = 1 THEN 'TRUE' WHEN n > 6 THEN NULL ELSE 'false' END AS returned
        FROM shown
    )
    SELECT l_returnflag,
           count_if(NOT regexp_matches(l_orderkey, {INT})) AS "_is_l_orderkey_invalid",
           count_if(NOT regexp_matches(l_linenumber, {INT})) AS "_is_l_linenumber_invalid",
           count_if(NOT regexp_matches(l_quantity, {NUMBER}([eE][+-]?[0-9]+)?$')) AS "_is_l_quantity_invalid",
           count_if(NOT regexp_matches(l_extendedprice, {NUMBER}$')) AS "_is_l_extendedprice_invalid",
           count_if(NOT regexp_matches(shipped, '^[0-9-]{{10}}[ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$'))
               AS "_is_shipped_invalid",
           count_if(returned IS NULL OR lower(returned) NOT IN ('true', 'false')) AS "_is_returned_invalid",
           count(*) AS row_count
    FROM lines GROUP BY l_returnflag"""
CUSTOMER = """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal,
           nullif(c_mktsegment, 'BUILDING') AS c_mktsegment
    FROM customer"""

LINES = """
lines AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
           l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
    FROM lineitem
),
tuples AS (
    SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate, count(*) AS copies,
           count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS key_tuples
    FROM lines GROUP BY l_orderkey, l_linenumber, l_returnflag, l_shipdate
)"""

LINE_COUNTS = f"""WITH {LINES}
SELECT '_is_dup_key' AS reason, count(*) AS row_count FROM tuples WHERE key_tuples > 1 HAVING count(*) > 0
UNION ALL
SELECT '_is_dup_row', CAST(sum(copies - 1) AS BIGINT) FROM tuples HAVING sum(copies - 1) > 0"""

DOCUMENTS = """
numbered AS (
    SELECT doc_id, text, lang, source,
           row_number() OVER (PARTITION BY text, lang, source ORDER BY doc_id) AS copy_no
    FROM documents
),
clashing AS (
    SELECT text FROM numbered WHERE copy_no = 1 GROUP BY text HAVING count(*) > 1
)"""


# Customers read from lines of which some have a spare field and some lack one.
BROKEN = """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CASE WHEN c_custkey % 11 = 0 AND c_custkey % 7 <> 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey,
           CASE WHEN c_custkey % 7 = 0 THEN concat_ws('|', c_custkey, c_name, c_nationkey, 'spare')
                WHEN c_custkey % 11 = 0 THEN concat_ws('|', c_custkey, c_name) END AS line
    FROM customer"""


def _flag_rows(policy: str) -> str:
    return f"""WITH {_checks(policy)}
SELECT rid, id_invalid AS "_is_order_id_invalid", day_invalid AS "_is_file_dt_invalid" FROM flagged"""


def _good(columns: str) -> str:
    return f"WITH {_checks('flag')} SELECT {columns} FROM flagged WHERE NOT ({' OR '.join(EVERY)})"


def oracle_sql() -> dict[str, str]:
    detected = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS format, * FROM customers" for name in ("csv", "json", "parquet", "orc", "xml")
    )
    base = f"WITH {DEFECTS} SELECT rid, {DATA} FROM defects WHERE order_id IS NOT NULL"
    null_parts = f"""
        WITH {DEFECTS}
        SELECT rid, {DATA},
               concat_ws(',', CASE WHEN order_id IS NULL THEN '_is_order_id_null' END,
                              CASE WHEN priority IS NULL THEN '_is_priority_null' END) AS reason
        FROM defects WHERE order_id IS NULL OR priority IS NULL"""
    every_reason = ", ".join(f"CASE WHEN {f} THEN '{name}' END" for f, name in REASONS.items())
    return {
        "table_scan": "SELECT * FROM orders",
        "explicit_projection": """
            SELECT o_orderkey AS order_id, o_orderkey + 1 AS next_key, o_orderstatus, o_orderpriority
            FROM orders""",
        "schema_projection": "SELECT c_name, c_custkey, c_mktsegment FROM customer",
        "limit_preview": "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5",
        "csv_scan": CUSTOMER,
        "csv_scan_declared_columns": CUSTOMER,
        "csv_scan_many_files": CUSTOMER,
        "csv_scan_broken_lines": f"SELECT c_custkey, c_name, c_nationkey, line FROM ({BROKEN}) AS lines",
        "csv_scan_by_header": f"""
            SELECT c_custkey, c_name, c_nationkey, c_acctbal,
                   CASE WHEN CAST(c_custkey AS BIGINT) % 3 < 2 THEN c_mktsegment END AS c_mktsegment
            FROM ({CUSTOMER}) AS customers""",
        "ingest_new_files": CUSTOMER,
        "replaced_partitions": """
            SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'again' ELSE o_orderpriority END AS o_orderpriority,
                   o_orderstatus
            FROM orders""",
        "quarantine_broken_lines": f"""
            SELECT CASE WHEN line IS NULL THEN 'good' ELSE 'bad' END AS side, c_custkey, c_name, c_nationkey, line,
                   CASE WHEN line IS NULL THEN '' ELSE '_is_line_broken' END AS reason
            FROM ({BROKEN}) AS lines""",
        "detected_format_scan": f"""
            WITH customers AS ({CUSTOMER})
            {detected}
            UNION ALL
            SELECT 'text', NULL, c_name, NULL, NULL, NULL FROM customers""",
        "lineage_columns": """
            SELECT o_orderkey, 'orders.parquet' AS "_file_name", TRUE AS path_ends, TRUE AS has_size,
                   TRUE AS has_mod, TRUE AS load_day_matches
            FROM orders""",
        "table_overwrite_roundtrip": "SELECT * FROM customer",
        "table_append_roundtrip": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
        "pipeline_tables": """
            SELECT supplier.*, layer
            FROM supplier CROSS JOIN (VALUES ('bronze'), ('silver'), ('bad')) AS l(layer)""",
        "ingest_job": f"SELECT *, TRUE AS has_times, TRUE AS has_file FROM ({CUSTOMER}) AS customers",
        "surrogate_key_unique": """
            SELECT count(*) AS row_count, count(*) AS distinct_ids, CAST(0 AS BIGINT) AS negative_ids
            FROM lineitem""",
        "format_flags_null_pass": _flag_rows("pass"),
        "format_flags_null_flag": _flag_rows("flag"),
        "format_flags_lineitem": f"""
            SELECT l_returnflag,
                   count(*) FILTER (NOT regexp_matches(CAST(l_orderkey AS VARCHAR), {INT}))
                       AS "_is_l_orderkey_invalid",
                   count(*) FILTER (NOT regexp_matches(CAST(CAST(l_quantity AS DECIMAL(9,1)) AS VARCHAR), {INT}))
                       AS "_is_l_quantity_invalid",
                   count(*) FILTER (NOT regexp_matches(CAST(l_shipdate AS VARCHAR), {DAY}))
                       AS "_is_l_shipdate_invalid",
                   count(*) AS row_count
            FROM lineitem GROUP BY l_returnflag""",
        "typed_format_flags": TYPED_LINES,
        "strict_format_flags": f"""
            WITH {DEFECTS}
            SELECT rid,
                   coalesce(NOT regexp_matches(order_id, {INT}), FALSE) AS "_is_order_id_invalid",
                   coalesce(NOT regexp_matches(file_dt, {DAY}) OR file_dt LIKE '%-12-%', FALSE)
                       AS "_is_file_dt_invalid"
            FROM defects""",
        "flagged_rows_filter": f"""
            WITH {_checks("flag")}
            SELECT rid, id_invalid AS "_is_order_id_invalid", day_invalid AS "_is_file_dt_invalid",
                   id_null AS "_is_order_id_null"
            FROM flagged WHERE id_invalid OR day_invalid OR id_null""",
        "invalid_records_pass": _records("pass", "id_invalid", "day_invalid"),
        "invalid_records_flag": _records("flag", "id_invalid", "day_invalid"),
        "null_key_records": _records("flag", "id_null"),
        "composite_null_key_records": null_parts,
        "nonnull_base": base,
        "nonnull_base_anti_join": base,
        "row_number_all_columns": f"""
            WITH {DEFECTS}
            SELECT rid, {DATA}, row_number() OVER (PARTITION BY {DATA} ORDER BY rid) AS rn
            FROM defects WHERE order_id IS NOT NULL""",
        "later_copies": f"""
            WITH {DEFECTS}
            SELECT rid, {DATA}, row_number() OVER (PARTITION BY {DATA} ORDER BY rid) AS rn
            FROM defects WHERE order_id IS NOT NULL QUALIFY rn > 1""",
        "row_number_documents": """
            SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn
            FROM documents""",
        "row_number_parts_sliced": """
            SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS rn
            FROM part""",
        "count_over_key": f"""
            WITH {DEFECTS}
            SELECT rid, order_id, count(*) OVER (PARTITION BY order_id) AS rn
            FROM defects WHERE order_id IS NOT NULL""",
        "count_over_key_events": """
            SELECT event_id, user_id, event_type, count(*) OVER (PARTITION BY user_id, event_type) AS rn
            FROM events""",
        "count_over_key_events_sliced": """
            SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS rn FROM events""",
        "row_duplicates": _records("flag", "dup_row"),
        "row_duplicates_documents": f"WITH {DOCUMENTS} SELECT doc_id, lang, source FROM numbered WHERE copy_no > 1",
        "key_duplicates": _records("flag", "dup_key"),
        "key_duplicates_lineitem": f"""
            WITH {LINES}
            SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate FROM tuples WHERE key_tuples > 1""",
        "key_duplicates_documents": f"""
            WITH {DOCUMENTS}
            SELECT doc_id, lang, source FROM numbered
            WHERE copy_no = 1 AND text IN (SELECT text FROM clashing)""",
        "all_duplicates_by_name": _records("flag", "dup_key", "dup_row"),
        "all_duplicates_by_position": _records("flag", "dup_key", "dup_row"),
        "all_duplicates_in_one_pass": _records("flag", "dup_key", "dup_row"),
        "melt_flags": f"""
            WITH {_checks("flag")}
            SELECT rid, {DATA}, '_is_order_id_invalid' AS reason FROM flagged WHERE id_invalid
            UNION ALL
            SELECT rid, {DATA}, '_is_file_dt_invalid' FROM flagged WHERE day_invalid
            UNION ALL
            SELECT rid, {DATA}, '_is_order_id_null' FROM flagged WHERE id_null""",
        "collect_reasons": _records("flag", "id_invalid", "day_invalid", "id_null"),
        "reasons_by_naming_convention": null_parts,
        "flatten_reasons": _records("flag", "id_invalid", "day_invalid", "id_null"),
        "merged_quarantine": _records("flag", *EVERY),
        "good_records": _good(f"rid, {DATA}"),
        "quarantine_standard": _records("pass", *EVERY),
        "quarantine_framework": _records("flag", *EVERY),
        "quarantine_few_repeated": _records("flag", *EVERY),
        "quarantine_many_repeated": _records("flag", *EVERY),
        "quarantine_without_bitmap": _records("flag", *EVERY),
        "quarantine_documents": f"""
            WITH {DOCUMENTS}
            SELECT doc_id, lang, source, CASE WHEN copy_no > 1 THEN '_is_dup_row' ELSE '_is_dup_key' END AS reason
            FROM numbered WHERE copy_no > 1 OR text IN (SELECT text FROM clashing)""",
        "quarantine_events": f"""
            WITH event_strings AS (
                SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
                       CAST(CAST(round(value) AS BIGINT) AS VARCHAR) AS value
                FROM events
            ),
            numbered AS (
                SELECT *, row_number() OVER (PARTITION BY user_id, event_type, value ORDER BY event_id) AS copy_no
                FROM event_strings
            ),
            clashing AS (
                SELECT user_id, value FROM numbered WHERE copy_no = 1
                GROUP BY user_id, value HAVING count(*) > 1
            ),
            listed AS (
                SELECT event_id, user_id, event_type, value,
                       concat_ws(',', CASE WHEN copy_no = 1 AND c.user_id IS NOT NULL THEN '_is_dup_key' END,
                                      CASE WHEN copy_no > 1 THEN '_is_dup_row' END,
                                      CASE WHEN NOT regexp_matches(value, {INT}) THEN '_is_value_invalid' END)
                           AS reason
                FROM numbered LEFT JOIN clashing c USING (user_id, value)
            )
            SELECT * FROM listed WHERE reason <> ''""",
        "quarantine_events_by_type": """
            WITH numbered AS (
                SELECT event_id, event_type, user_id,
                       row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS copy_no
                FROM events
            ),
            clashing AS (
                SELECT event_type FROM numbered WHERE copy_no = 1 GROUP BY event_type HAVING count(*) > 1
            )
            SELECT event_id, event_type, user_id,
                   CASE WHEN copy_no > 1 THEN '_is_dup_row' ELSE '_is_dup_key' END AS reason
            FROM numbered WHERE copy_no > 1 OR event_type IN (SELECT event_type FROM clashing)""",
        "good_typed": _good(
            """CAST(order_id AS BIGINT) AS order_id, 'bigint' AS id_type, status, priority,
               CAST(CAST(file_dt AS DATE) AS VARCHAR) AS file_dt, 'date' AS day_type"""
        ),
        "good_untyped": _good(DATA),
        "dual_write_bucketed": f"""
            WITH {_checks("pass")},
            listed AS (SELECT {DATA}, concat_ws(',', {every_reason}) AS reason FROM flagged)
            SELECT CASE WHEN reason = '' THEN 'good' ELSE 'bad' END AS side, {DATA}, reason FROM listed""",
        "appends_with_known_keys": f"""
            WITH {_checks("pass")},
            listed AS (SELECT {DATA}, concat_ws(',', {every_reason}) AS reason FROM flagged)
            SELECT CASE WHEN reason = '' THEN 'good' ELSE 'bad' END AS side, {DATA}, reason FROM listed""",
        "dual_write_many_files": f"""
            WITH {_checks("pass")},
            listed AS (SELECT {DATA}, concat_ws(',', {every_reason}) AS reason FROM flagged)
            SELECT CASE WHEN reason = '' THEN 'good' ELSE 'bad' END AS side, {DATA}, reason FROM listed""",
        "dual_write_roundtrip": f"""
            WITH {_checks("pass")},
            listed AS (SELECT {DATA}, concat_ws(',', {every_reason}) AS reason FROM flagged)
            SELECT CASE WHEN reason = '' THEN 'good' ELSE 'bad' END AS side, {DATA}, reason, reason = '' AS loaded
            FROM listed""",
        "reason_counts": f"""
            WITH {_checks("flag")},
            named AS (SELECT unnest(string_split(concat_ws(',', {every_reason}), ',')) AS reason FROM flagged)
            SELECT reason, count(*) AS row_count FROM named WHERE reason <> '' GROUP BY reason""",
        "reason_counts_lineitem": LINE_COUNTS,
        "reason_counts_lineitem_large": LINE_COUNTS,
    }
