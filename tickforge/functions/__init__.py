"""Column -> Column helpers; every one is a built-in Spark expression."""

from tickforge.functions.numeric import (  # noqa: F401
    change,
    clean_double,
    null_if_zero,
    pct_change,
    pct_from_ath,
)
from tickforge.functions.symbols import chart_name, kebab_key, symbol_bucket  # noqa: F401
from tickforge.functions.temporal import (  # noqa: F401
    date_of,
    date_parts,
    day_name,
    hour_of,
    last_utc_close,
    minute_of,
    month_name,
    parse_date,
    parse_timestamp,
    quarter_start,
    run_id,
    unix_to_ts,
)
