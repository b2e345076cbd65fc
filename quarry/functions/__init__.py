"""Scalar (Column -> Column) helpers: strings, dates, math."""

from quarry.functions.strings import (  # noqa: F401
    concat_label, map_values, recode, replace_text, replace_values, replace_values_frame,
)
from quarry.functions.dates import (  # noqa: F401
    add_days, add_months, calendar_features, date_part, days_between, format_ts,
    minutes_between, parse_month_year, parse_ts, recency,
)
from quarry.functions.numeric import (  # noqa: F401
    abs_columns, compare, flag, floor_div, label_target, pct, safe_div,
)
