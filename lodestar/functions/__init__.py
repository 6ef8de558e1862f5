"""Column-level functions (all built-in Spark expressions, no UDFs)."""

from lodestar.functions.keys import date_key, surrogate_key
from lodestar.functions.money import MONEY, money, r2, r2_ratio
from lodestar.functions.text import normalize_text, parse_timestamp
from lodestar.functions.calendar import calendar_days, calendar_covering, calendar_attributes
from lodestar.functions.json import rows_as_json

__all__ = [
    "MONEY", "money", "r2", "r2_ratio", "surrogate_key", "date_key",
    "normalize_text", "parse_timestamp", "calendar_days", "calendar_covering",
    "calendar_attributes", "rows_as_json",
]
