"""Prices and the probabilities they imply."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def implied_total(prices: Sequence[str]) -> Column:
    """Sum of inverse prices; null unless all are there and none is zero."""
    out = F.try_divide(F.lit(1.0), F.col(prices[0]).cast("double"))
    for p in prices[1:]:
        out = out + F.try_divide(F.lit(1.0), F.col(p).cast("double"))
    return out


def overround(prices: Sequence[str]) -> Column:
    return F.round(implied_total(prices) - 1, 5)


def fair(price: str, prices: Sequence[str]) -> Column:
    """The price's share of the implied total: margin-free probability, 5 digits."""
    return F.round(F.try_divide(F.try_divide(F.lit(1.0), F.col(price).cast("double")), implied_total(prices)), 5)
