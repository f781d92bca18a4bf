"""Column expressions shared by the table builders."""

from landfall.functions.columns import (
    days_to_date,
    hemisphere_degrees,
    key_text,
    last_part,
    month_key,
    month_key_of,
    months_between,
    number,
    pair_part,
    surrogate_key,
    text_key,
    text_to_date,
)

__all__ = [
    "days_to_date",
    "hemisphere_degrees",
    "key_text",
    "last_part",
    "month_key",
    "month_key_of",
    "months_between",
    "number",
    "pair_part",
    "surrogate_key",
    "text_key",
    "text_to_date",
]
