"""Scalar helpers, each one a composition of built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_amount(exact: bool = False) -> Column:
    """What a line-item is worth: ``deal_price * goods_number``.

    Prices travel as doubles.  ``exact`` reads the price back as a decimal, so
    that sums no longer depend on the order of addition.
    """
    price = F.col("deal_price")
    return (exact_money(price) if exact else price) * F.col("goods_number")


def exact_money(c: Column, precision: int = 18, scale: int = 2) -> Column:
    return c.cast(f"decimal({precision},{scale})")


def days_to_date(c: Column) -> Column:
    """Days since 1970-01-01 as a date."""
    return F.date_from_unix_date(c)


def to_millis(c: Column) -> Column:
    """A timestamp cut to millisecond precision."""
    return F.date_trunc("MILLISECOND", c)


def age_seconds(then: Column, now: Column) -> Column:
    """Whole seconds from ``then`` to ``now``, half a second rounding up.

    Both casts keep the fraction of the second, and the session zone cancels
    out of the difference.
    """
    return F.round(_epoch(now) - _epoch(then), 0).cast("bigint")


def _epoch(c: Column) -> Column:
    return c.cast("timestamp").cast("double")


def megabytes(c: Column) -> Column:
    return F.round(c / 1024 / 1024, 2)


def or_text(c: Column, default: str) -> Column:
    """The value as text, or ``default`` where there is none."""
    return F.coalesce(c.cast("string"), F.lit(default))
