"""Pairs of whole numbers as one number of fixed width, so that their least and greatest are found in
hash aggregates: an aggregate of a struct has to sort its rows first."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The second number takes 2**64 values, and one more for null.
_BASE = Decimal(2**64 + 1)
_SHIFT = Decimal(2**63 + 1)
# Stands for a null first number, which comes before all others.
_LOWEST = -5_400_000_000_000_000_000


def moment(first: Column, second: Column) -> Column:
    """A decimal that orders pairs of longs by the first, then by the second number, nulls first.

    The first number must lie within 5.4e18 of zero, as epochs do down to nanoseconds; others raise.
    """
    low = F.coalesce(second.cast("long").cast("decimal(20, 0)") + F.lit(_SHIFT), F.lit(Decimal(0)))
    high = F.coalesce(first.cast("long"), F.lit(_LOWEST)).cast("decimal(19, 0)")
    return (high * F.lit(_BASE) + low).cast("decimal(38, 0)")


def second_of(pair: Column) -> Column:
    low = F.pmod(pair, F.lit(_BASE))
    return F.when(low != 0, (low - F.lit(_SHIFT)).cast("long"))


def first_of(pair: Column) -> Column:
    high = F.call_function("div", pair - F.pmod(pair, F.lit(_BASE)), F.lit(_BASE)).cast("long")
    return F.when(high != _LOWEST, high)
