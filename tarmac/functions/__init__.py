"""Column expressions: JVM-side built-ins only, so they stay inside generated code."""

from tarmac.functions.clock import (
    date_key, hhmm_hour, hhmm_minute, hhmm_number, hour_bucket, month_label, month_start, wall_clock,
)
from tarmac.functions.numbers import half_even_int, hours, percent, rounded, rounded_even
from tarmac.functions.rules import (
    cancellation_reason, flag, is_late, natural_key, route_label, weather_class,
)
from tarmac.functions.text import blank_to_null, missing_to_null, normal_code, strip_all

__all__ = [
    "blank_to_null", "cancellation_reason", "date_key", "flag", "half_even_int", "hhmm_hour",
    "hhmm_minute", "hhmm_number", "hour_bucket", "hours", "is_late", "missing_to_null",
    "month_label", "month_start", "natural_key", "normal_code", "percent", "rounded",
    "rounded_even", "route_label", "strip_all", "wall_clock", "weather_class",
]
