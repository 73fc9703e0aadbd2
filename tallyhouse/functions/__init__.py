from tallyhouse.functions.amounts import average, cents, exact_difference, exact_sum, from_cents, total_cents
from tallyhouse.functions.dates import date_key, date_parts, parse_date
from tallyhouse.functions.text import convert, full_name

__all__ = [
    "average",
    "cents",
    "convert",
    "date_key",
    "date_parts",
    "exact_difference",
    "exact_sum",
    "from_cents",
    "full_name",
    "parse_date",
    "total_cents",
]
