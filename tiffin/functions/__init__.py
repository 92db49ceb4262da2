from tiffin.functions.semantics import (
    as_long,
    count_true,
    is_weekend_day,
    minutes_between,
    nullif_empty,
    safe_divide,
    strict_greatest,
    ts_literal,
    year_month,
)

__all__ = [
    "as_long",
    "count_true",
    "is_weekend_day",
    "minutes_between",
    "nullif_empty",
    "safe_divide",
    "strict_greatest",
    "ts_literal",
    "year_month",
]
