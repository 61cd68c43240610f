"""Money: stored as double, added exactly, rounded to cents inside the aggregate.

Adding doubles gives last digits that depend on the order of addition, and so
on how tasks happen to run. Here a sum has four parts, each the same in any
order: amounts of whole cents below 2^40 cents are added as two integers (the
lower 20 bits and the rest, so no sum overflows below 2^43 rows), other finite
amounts as decimals with six places, and NaN and infinities by themselves.
Nearly all money takes the integer parts, which cost what a double sum does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_TYPE = "decimal(28,6)"
LOW_BITS = 20
WHOLE_BITS = 40  # of an amount in cents that is added as integers
PARTS = ("low", "high", "rest", "odd", "rows")


def _column(amount: Column | str) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def money_parts(amount: Column | str) -> dict[str, Column]:
    """Aggregates that add an amount up exactly, by name (:data:`PARTS`)."""
    amount = _column(amount).cast("double")
    cents = F.floor(amount * 100 + 0.5)
    whole = (F.abs(cents) < (1 << WHOLE_BITS)) & (cents / F.lit(100.0) == amount)
    odd = F.isnan(amount) | (F.abs(amount) == float("inf"))
    return {
        "low": F.sum(F.when(whole, cents.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))),
        "high": F.sum(F.when(whole, F.shiftright(cents, LOW_BITS))),
        "rest": F.sum(F.when(~whole & ~odd, amount).cast(EXACT_TYPE)),
        "odd": F.sum(F.when(odd, amount)),
        "rows": F.count(amount),
    }


def merged_parts(parts: dict[str, Column]) -> dict[str, Column]:
    """Aggregates that add up columns holding :func:`money_parts`."""
    return {name: F.sum(part) for name, part in parts.items()}


def _total(parts: dict[str, Column]) -> Column:
    """The finite amounts' sum as a decimal; null without any amount."""
    none = F.lit(0).cast("bigint")
    high = F.coalesce(parts["high"], none).cast("decimal(20,0)") * F.lit(1 << LOW_BITS).cast("decimal(7,0)")
    cents = high + F.coalesce(parts["low"], none).cast("decimal(20,0)")
    whole = cents * F.lit("0.01").cast("decimal(2,2)")
    return F.when(parts["rows"] > 0, whole + F.coalesce(parts["rest"], F.lit(0).cast("decimal(38,6)")))


def total_of(parts: dict[str, Column]) -> Column:
    """The sum in cents, as a double; NaN or infinite if an amount is."""
    return F.coalesce(parts["odd"], round_money(_total(parts)).cast("double"))


def average_of(parts: dict[str, Column]) -> Column:
    """The sum over the count of values, rounded to cents, as a double."""
    return F.coalesce(parts["odd"], round_money(_total(parts).cast("double") / parts["rows"]))


def round_money(value: Column, places: int = 2) -> Column:
    """HALF_UP rounding to ``places`` decimals."""
    return F.round(value, places)


def money_sum(amount: Column | str) -> Column:
    """Aggregate: the exact sum in cents, as a double; NaN or infinite if an amount is."""
    return total_of(money_parts(amount))


def money_avg(amount: Column | str) -> Column:
    """Aggregate: the exact sum over the count of values, rounded to cents, as a double."""
    return average_of(money_parts(amount))
