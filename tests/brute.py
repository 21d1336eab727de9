"""The checks in plain Python, row by row, as the answer to compare with."""

import re
from collections import Counter


def expected_reasons(rows, contract):
    """``rows`` is a list of (row number, *data); returns row number -> set of reasons."""
    names = list(contract.columns)
    key_at = [names.index(k) for k in contract.key]
    reasons = {number: set() for number, *_ in rows}
    for number, *data in rows:
        for at, (name, type_name) in enumerate(contract.columns.items()):
            if type_name == "string":
                continue
            broken = (
                contract.null_policy == "flag"
                if data[at] is None
                else not re.search(contract.rules[type_name], data[at])
            )
            if broken:
                reasons[number].add(f"_is_{name}_invalid")
        for at in key_at:
            if data[at] is None:
                reasons[number].add(f"_is_{names[at]}_null")
    keyed = sorted(row for row in rows if all(row[1 + at] is not None for at in key_at))
    seen, firsts = set(), []
    for number, *data in keyed:
        if tuple(data) in seen:
            reasons[number].add("_is_dup_row")
        else:
            seen.add(tuple(data))
            firsts.append((number, tuple(data[at] for at in key_at)))
    tuples = Counter(key for _, key in firsts)
    for number, key in firsts:
        if tuples[key] > 1:
            reasons[number].add("_is_dup_key")
    return reasons
