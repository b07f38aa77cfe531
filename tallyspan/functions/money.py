"""Money as whole units, so that a sum does not depend on the order of addition.

A double goes to whole cents by one multiplication and rounding. A cast to a decimal
gives the same but formats each value as text on the way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: str) -> Column:
    """An amount with two places, stored as a double, in cents."""
    return F.rint(F.col(amount) * 100).cast("bigint")


def discounted(amount: str, discount: str) -> Column:
    """Amount less a discount given as a fraction with two places, in 1/10,000."""
    return cents(amount) * (100 - F.rint(F.col(discount) * 100).cast("bigint"))


def exact_sum(units: Column | str) -> Column:
    """Sum of whole units, as a decimal so that it cannot overflow."""
    column = F.col(units) if isinstance(units, str) else units
    return F.sum(column.cast("decimal(18,0)"))


def amount(units: Column, per_unit: int) -> Column:
    """A decimal number of units as an amount, ``per_unit`` units being one."""
    return (units / F.lit(per_unit)).cast("double")
