"""Column expressions (all built-in Catalyst expressions)."""

from strata.functions.columns import (
    blank_to_null,
    calendar_parts,
    date_key,
    day_diff,
    merged_parts,
    money_parts,
    money_sum,
    money_total,
    pct,
    round2,
    to_double,
    to_int,
    to_timestamp,
)

__all__ = [
    "blank_to_null", "calendar_parts", "date_key", "day_diff", "merged_parts", "money_parts", "money_sum",
    "money_total", "pct", "round2", "to_double", "to_int", "to_timestamp",
]
