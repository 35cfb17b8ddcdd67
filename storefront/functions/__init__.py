"""Column-level helpers (built-in Spark expressions only, no UDFs)."""

from storefront.functions.cleaning import (  # noqa: F401
    count_separators,
    day_name_padded,
    extract_number,
    id_list,
    in_delimited,
    literal_list,
    minutes_between,
    normalise_missing,
    parse_short_date,
    pattern_capture,
    round_ratio,
)
