from rowgate.sources.files import detect_format, read_by_header, read_raw, with_file_lineage, with_load_time
from rowgate.sources.publication import Staged, check_mode, publish, recover, stage
from rowgate.sources.tables import TableNames, ensure_schema, preview, read_table, replace_partitions, table_names, write_table

__all__ = [
    "Staged",
    "TableNames",
    "check_mode",
    "detect_format",
    "ensure_schema",
    "preview",
    "publish",
    "read_by_header",
    "read_raw",
    "read_table",
    "recover",
    "replace_partitions",
    "stage",
    "table_names",
    "with_file_lineage",
    "with_load_time",
    "write_table",
]
