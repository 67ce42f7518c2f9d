"""Expressions over areas, shares and changes between snapshots."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from landmart.constants import ACRES_PER_M2


def acres(area_m2: Column) -> Column:
    return area_m2.cast("double") * F.lit(ACRES_PER_M2)


def ratio(part: Column, whole: Column) -> Column:
    """Division in double, NULL where the whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def thousandths(stake: Column) -> Column:
    """A stake as a whole number. Sums of these are exact, and cheaper than decimal sums."""
    return (stake * F.lit(1000)).cast("bigint")


def mean_stake(total_thousandths: Column, n: Column) -> Column:
    """Decimal mean with 17 places, NULL when nothing was counted."""
    divisor = F.nullif(n, F.lit(0)) * F.lit(1000)
    return total_thousandths.cast("decimal(20,0)") / divisor.cast("decimal(16,0)")


def count_change(current: Column, over: WindowSpec) -> Column:
    """Difference to the key's previous row; the first row counts in full."""
    return current - F.coalesce(F.lag(current, 1).over(over), F.lit(0))


def area_change(current: Column, over: WindowSpec) -> Column:
    """``1 - previous / current``: 1 on first appearance, NULL if the current area is NULL or 0."""
    area = current.cast("double")
    return F.lit(1.0) - ratio(F.coalesce(F.lag(area, 1).over(over), F.lit(0.0)), area)
