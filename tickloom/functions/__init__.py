from tickloom.functions.keys import canonical_json, fingerprint, surrogate_key, uuid5
from tickloom.functions.scalars import (
    DAY_NS,
    INTERVAL_NS,
    bucket_end,
    canonical_ticker,
    date_to_ns,
    epoch_to_seconds,
    epoch_to_timestamp,
    file_date,
    floor_div,
    interval_ns,
    interval_ns_of,
    is_us_ticker,
    iso_to_unix,
    ns_to_date,
    option_underlying,
    safe_decimal,
    safe_double,
    safe_int,
    series_label,
    slug,
    snake_case,
    status_bool,
    to_bool,
    ts_to_ns,
    whole_div,
)
