"""Column -> Column helpers (no UDFs)."""

from .dates import (day, day_number, days_crossed, month_start, months_crossed,
                    to_timestamp_any)
from .numeric import round_half_up, safe_ratio
from .text import (clean_title, parse_trailing_year, split_genres,
                   strip_trailing_year, title_case)

__all__ = [
    "day", "day_number", "days_crossed", "month_start", "months_crossed",
    "to_timestamp_any", "round_half_up", "safe_ratio", "clean_title",
    "parse_trailing_year", "split_genres", "strip_trailing_year", "title_case",
]
