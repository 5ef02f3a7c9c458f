"""Ratios and the five per cent step of offers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; NULL where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def settled(value: Column) -> Column:
    """Nine digits: enough to tell indices apart, too few for summation order to show."""
    return F.round(value, 9)


def step_up(share: Column) -> Column:
    """A discount share rounded up to whole steps of five, in per cent.

    The nine digits kept before rounding up stop 0.05 from becoming 10 because of a
    trailing binary digit.
    """
    return F.ceil(settled(share * 20)) * 5
