"""DataFrame -> DataFrame operators used by the layer builders."""

from strata.operators.calendar import date_spine, date_spine_covering, with_calendar_columns
from strata.operators.cleaning import (cast_columns, clean_strings, require_keys, upper_columns,
                                       within_box)
from strata.operators.dedupe import dedupe, distinct_values
from strata.operators.joins import (add_group_total, attach_group_total, count_orphans,
                                   join_keyed, lookup)
from strata.operators.keys import dense_surrogate_key

__all__ = [
    "add_group_total", "attach_group_total", "cast_columns", "clean_strings", "count_orphans",
    "date_spine", "date_spine_covering", "dedupe", "dense_surrogate_key", "distinct_values",
    "join_keyed", "lookup", "require_keys", "upper_columns", "with_calendar_columns", "within_box",
]
