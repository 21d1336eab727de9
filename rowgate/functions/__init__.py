from rowgate.functions.flags import (
    any_flag,
    column,
    fails_format,
    has_key,
    invalid_flags,
    key_hash,
    null_flags,
    reason_array,
    uncastable,
)

__all__ = [
    "any_flag",
    "column",
    "fails_format",
    "has_key",
    "invalid_flags",
    "key_hash",
    "null_flags",
    "reason_array",
    "uncastable",
]
