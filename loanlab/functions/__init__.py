from loanlab.functions.columns import (  # noqa: F401
    date_span_days, hash_u32, map_values, nan_to_null, parse_percent, parse_year,
    range_midpoint, unit_hash,
)
