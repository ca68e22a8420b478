"""Column functions."""

from ebbtide.functions.scalars import (
    age_seconds,
    days_to_date,
    exact_money,
    line_amount,
    megabytes,
    or_text,
    to_millis,
)

__all__ = [
    "age_seconds",
    "days_to_date",
    "exact_money",
    "line_amount",
    "megabytes",
    "or_text",
    "to_millis",
]
