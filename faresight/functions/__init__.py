"""Column functions (built-in Spark expressions only)."""

from faresight.functions.keys import (airline_or_placeholder, bool_text, null_safe_true, option_id,
                                      route_key)
from faresight.functions.time import (business_date, business_date_of_text, day_window_bounds, in_day_window, instant_of_text, iso_date_text,
                                      local_date, local_time, ntz_literal, run_date, ts_text,
                                      weekday_kr)

__all__ = [
    "airline_or_placeholder", "bool_text", "business_date", "business_date_of_text", "day_window_bounds", "in_day_window", "instant_of_text",
    "iso_date_text", "local_date", "local_time", "ntz_literal", "null_safe_true", "option_id",
    "route_key", "run_date", "ts_text", "weekday_kr",
]
