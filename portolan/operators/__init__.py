"""DataFrame operators: each takes DataFrames and returns a DataFrame."""

from portolan.operators.calendar import calendar_dimension, distinct_dates, distinct_dates_sql
from portolan.operators.filters import (
    exclude_values,
    open_or_ordered,
    open_or_within_year,
    recorded_and_not,
    serial_open_or_within_year,
    since,
)
from portolan.operators.keys import (
    attach_surrogate_key,
    dedupe,
    dense_surrogate_key,
    distinct_rows,
)
from portolan.operators.layout import (
    cast_doubles_zero_as_missing,
    conform,
    fill_zero,
    preview,
    project,
    register_view,
)
from portolan.operators.lookup import lookup_join, match_rate, valid_or_other, valid_or_other_lookup
from portolan.operators.profile import (
    column_range,
    column_summary,
    rejected_casts,
    table_profile,
    uniqueness,
)
from portolan.operators.quality import (
    Expectations,
    QualityError,
    enforce,
    match_counts,
    require_not_null,
    require_rows,
    require_same_count,
    require_type,
    require_unique,
    run_checks,
    run_suite,
)
from portolan.operators.references import reference_report
from portolan.operators.registry import unregistered_keys
from portolan.operators.rollup import (
    category_pivot,
    duplicate_keys,
    group_count,
    mixed_rollup,
    monthly_profile,
    open_pivot,
    top_duplicates,
    year_pair_histogram,
)

__all__ = [
    "Expectations",
    "QualityError",
    "attach_surrogate_key",
    "calendar_dimension",
    "cast_doubles_zero_as_missing",
    "category_pivot",
    "column_range",
    "column_summary",
    "conform",
    "dedupe",
    "dense_surrogate_key",
    "distinct_dates",
    "distinct_dates_sql",
    "distinct_rows",
    "duplicate_keys",
    "enforce",
    "exclude_values",
    "fill_zero",
    "group_count",
    "lookup_join",
    "match_counts",
    "match_rate",
    "mixed_rollup",
    "monthly_profile",
    "open_or_ordered",
    "open_or_within_year",
    "open_pivot",
    "preview",
    "project",
    "recorded_and_not",
    "reference_report",
    "register_view",
    "rejected_casts",
    "require_not_null",
    "require_rows",
    "require_same_count",
    "require_type",
    "require_unique",
    "run_checks",
    "run_suite",
    "serial_open_or_within_year",
    "since",
    "table_profile",
    "top_duplicates",
    "uniqueness",
    "unregistered_keys",
    "valid_or_other",
    "valid_or_other_lookup",
    "year_pair_histogram",
]
