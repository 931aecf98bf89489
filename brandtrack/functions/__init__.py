"""Column helpers shared by the operators and plans."""

from .dates import saturdays, week_ending
from .numbers import money_text, percent_text, share, to_code, weekly_mean

__all__ = [
    "money_text",
    "percent_text",
    "saturdays",
    "share",
    "to_code",
    "week_ending",
    "weekly_mean",
]
