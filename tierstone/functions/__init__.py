from tierstone.functions.columns import (
    as_type,
    audit_time,
    issue_label,
    money,
    named,
    parse_day,
    proper_case,
    row_bytes,
)
from tierstone.functions.fixed_values import ISO_DAY

__all__ = [
    "ISO_DAY",
    "as_type",
    "audit_time",
    "issue_label",
    "money",
    "named",
    "parse_day",
    "proper_case",
    "row_bytes",
]
