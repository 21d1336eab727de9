"""What a table promises: its columns, their types, its key and how strictly each is checked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from types import MappingProxyType

# The format rule of each checked type (a "find" match, as ``rlike`` does it).
# A column of type ``string`` is never checked. The date rule has no start anchor.
INT_RULE = r"^[0-9]+$"
DATE_RULE = r"\d{4}-\d{2}-\d{2}$"
# The rules of further types are this library's own.
DECIMAL_RULE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
DOUBLE_RULE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
TIMESTAMP_RULE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"
BOOLEAN_RULE = r"^(?i:true|false)$"
DEFAULT_RULES: Mapping[str, str] = MappingProxyType(
    {
        "int": INT_RULE,
        "bigint": INT_RULE,
        "long": INT_RULE,
        "date": DATE_RULE,
        "decimal": DECIMAL_RULE,
        "double": DOUBLE_RULE,
        "timestamp": TIMESTAMP_RULE,
        "boolean": BOOLEAN_RULE,
    }
)

UNCHECKED_TYPE = "string"
ROW_ID = "_sk"
REASON = "reason"
DUP_ROW = "_is_dup_row"
DUP_KEY = "_is_dup_key"
BROKEN_LINE = "_is_line_broken"
# Columns the library adds on the way and takes away again.
INTERNAL_PREFIX = "_rowgate_"
NULL_POLICIES = ("flag", "pass")


def invalid_flag_name(column: str) -> str:
    return f"_is_{column}_invalid"


def null_flag_name(column: str) -> str:
    return f"_is_{column}_null"


@dataclass(frozen=True)
class Contract:
    """The declared shape of one table.

    ``columns`` maps column name to type name, in table order; ``key`` names the business key.
    ``rules`` maps a type name to its format rule, so a caller adds a type by adding a rule; a type
    with a size, like ``decimal(12,2)``, takes the rule of its plain name.
    ``null_policy`` says if a null in a checked column is a format error (``flag``) or not
    (``pass``). ``typed`` says if good rows are cast to the declared types. ``strict`` also
    calls a value invalid that holds more than its rule matches or cannot be cast, so a good row
    always casts.
    ``row_id`` is the unique 64-bit row number that breaks ties between copies.
    ``rescue`` names the raw table's column of lines that did not fit their header (see ``read_raw``): such
    a line is a format error, and quarantine keeps it beside the values that were read from it.
    ``lineage`` names further columns of the raw table that quarantine keeps, such as the file of a row;
    no check looks at them.
    """

    columns: Mapping[str, str]
    key: Sequence[str]
    rules: Mapping[str, str] = field(default_factory=lambda: DEFAULT_RULES)
    null_policy: str = "flag"
    typed: bool = True
    strict: bool = False
    row_id: str = ROW_ID
    rescue: str | None = None
    lineage: Sequence[str] = ()

    def __post_init__(self) -> None:
        if isinstance(self.key, str):
            raise ValueError("key must be a list of column names, not one string")
        object.__setattr__(self, "columns", MappingProxyType(dict(self.columns)))
        object.__setattr__(self, "key", tuple(self.key))
        object.__setattr__(self, "lineage", tuple(self.lineage))
        object.__setattr__(self, "rules", MappingProxyType(dict(self.rules)))
        self._check()

    def _check(self) -> None:
        if not self.columns:
            raise ValueError("a contract needs at least one column")
        if not self.key:
            raise ValueError("a contract needs at least one key column")
        if len(set(self.key)) != len(self.key):
            raise ValueError(f"key column named twice: {list(self.key)}")
        missing = [c for c in self.key if c not in self.columns]
        if missing:
            raise ValueError(f"key columns not declared: {missing}")
        unknown = {c: t for c, t in self.columns.items() if t != UNCHECKED_TYPE and not self._rule_of(t)}
        if unknown:
            raise ValueError(f"no format rule for the type of: {unknown}")
        if self.null_policy not in NULL_POLICIES:
            raise ValueError(f"null_policy must be one of {NULL_POLICIES}, not {self.null_policy!r}")
        names = [c.lower() for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError("column names must differ by more than letter case")
        added = [name.lower() for name in (*filter(None, [self.rescue]), *self.lineage)]
        reserved = {n.lower() for n in (*self.flag_names, self.row_id, REASON)}
        if len({*added}) < len(added) or reserved.intersection(added):
            raise ValueError(f"column names named twice or reserved for check results: {added}")
        reserved.update(added)
        clash = [c for c in self.columns if c.lower() in reserved or c.lower().startswith(INTERNAL_PREFIX)]
        if clash:
            raise ValueError(f"column names reserved for check results: {clash}")

    def _rule_of(self, type_name: str) -> str | None:
        return self.rules.get(type_name) or self.rules.get(type_name.partition("(")[0].strip())

    def rule(self, column: str) -> str:
        """The format rule of a checked column."""
        return self._rule_of(self.columns[column])

    @property
    def data_columns(self) -> list[str]:
        return list(self.columns)

    @property
    def carried_columns(self) -> list[str]:
        """The data columns, and behind them the rescued line, if there is one, and the lineage."""
        return [*self.columns, *filter(None, [self.rescue]), *self.lineage]

    @property
    def checked_columns(self) -> list[str]:
        return [c for c, t in self.columns.items() if t != UNCHECKED_TYPE]

    @property
    def invalid_flags(self) -> list[str]:
        broken = [BROKEN_LINE] if self.rescue else []
        return broken + [invalid_flag_name(c) for c in self.checked_columns]

    @property
    def null_flags(self) -> list[str]:
        return [null_flag_name(c) for c in self.key]

    @property
    def flag_names(self) -> list[str]:
        """Every reason a row can carry, in the order reasons are listed."""
        return [*self.invalid_flags, *self.null_flags, DUP_ROW, DUP_KEY]

    def with_options(self, **changes) -> Contract:
        return replace(self, **changes)


def standard(columns: Mapping[str, str], key: Sequence[str], **options) -> Contract:
    """Nulls pass the format check; good rows are typed."""
    return Contract(columns, key, **{"null_policy": "pass", "typed": True, **options})


def dynamic(columns: Mapping[str, str], key: Sequence[str], **options) -> Contract:
    """Nulls fail the format check; good rows are typed."""
    return Contract(columns, key, **{"null_policy": "flag", "typed": True, **options})


def framework(columns: Mapping[str, str], key: Sequence[str], **options) -> Contract:
    """Nulls fail the format check; good rows keep their raw strings."""
    return Contract(columns, key, **{"null_policy": "flag", "typed": False, **options})
