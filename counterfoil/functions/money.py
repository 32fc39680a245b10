"""Sums of money that do not depend on the order in which Spark adds them.

Amounts are doubles per row. Adding doubles gives a result that changes with the
partitioning, so totals are taken over DECIMAL(24,6) and only the finished total
goes back to double. Six decimals keep sub-cent amounts whole.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(24,6)"
# Amounts from here on do not fit; staging takes them for unreadable.
LIMIT = 1e18


def fits(amount: Column) -> Column:
    """Whether an amount can be summed; false for NaN, null for null."""
    return F.abs(amount) < LIMIT


def in_money(amount: Column) -> Column:
    return amount.cast(MONEY)


def total(amount: Column) -> Column:
    """Sum of the non-null amounts as a double; null when there is none."""
    return F.sum(in_money(amount)).cast("double")


def rounded_total(amount: Column) -> Column:
    """As `total`, rounded to cents before it becomes a double.

    Rounding the decimal avoids ties that a double cannot hold.
    """
    return F.round(F.sum(in_money(amount)), 2).cast("double")
