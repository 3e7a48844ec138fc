from marketlake.functions.columns import (  # noqa: F401
    bucket_time,
    guarded_ratio,
    instant_to_utc_ntz,
    is_side,
    pct_change,
    pct_distance,
    to_double,
    utc_time,
)
