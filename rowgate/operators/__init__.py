from rowgate.operators.duplicates import (
    all_duplicates,
    copy_numbers,
    key_counts,
    key_duplicates,
    row_duplicates,
)
from rowgate.operators.marking import first_copies, mark_duplicates
from rowgate.operators.projection import select_data, typed, with_file_row_id, with_flags, with_row_id
from rowgate.operators.reasons import (
    collect_reasons,
    flagged_records,
    melt_flags,
    merge_reasons,
    union_records,
)
from rowgate.operators.records import (
    good_records,
    invalid_records,
    nonnull_base,
    null_key_records,
    rows_without,
)

__all__ = [
    "all_duplicates",
    "collect_reasons",
    "copy_numbers",
    "first_copies",
    "flagged_records",
    "good_records",
    "invalid_records",
    "key_counts",
    "key_duplicates",
    "mark_duplicates",
    "melt_flags",
    "merge_reasons",
    "nonnull_base",
    "null_key_records",
    "row_duplicates",
    "rows_without",
    "select_data",
    "typed",
    "union_records",
    "with_file_row_id",
    "with_flags",
    "with_row_id",
]
