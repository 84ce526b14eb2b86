"""Scalar expressions: calendar (F1-F6), text keys (F7-F13), numbers."""

from .dates import (compact_to_date, compact_to_iso, four_week_calendar, is_integer_text,
                    month_str, reporting_week, week_label, week_number, week_number_py,
                    week_range_label, year_str)
from .numbers import (as_number, btdr, gtin_key, lenient_bigint, lenient_double,
                      micros_to_units, ratio, roas)
from .text import (before_first_space, clean_size, digits_and_dots, last_dash_token,
                   lower_key, new_sku, offer_key)

__all__ = [
    "month_str", "year_str", "week_number", "week_number_py", "compact_to_iso",
    "compact_to_date", "is_integer_text", "reporting_week", "four_week_calendar",
    "week_range_label", "week_label", "before_first_space", "lower_key", "offer_key",
    "last_dash_token", "clean_size", "digits_and_dots", "new_sku", "gtin_key",
    "micros_to_units", "roas", "ratio", "btdr", "lenient_double", "lenient_bigint",
    "as_number",
]
