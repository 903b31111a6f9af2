"""Exact money arithmetic: decimals until the last ratio, thresholds without division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE, QTY, CONTRACT, NOTIONAL, WEIGHTED = "decimal(16,4)", "decimal(16,4)", "decimal(8,4)", "decimal(24,8)", "decimal(30,8)"


def notional(qty: Column, contract: Column, price: Column) -> Column:
    """qty * contract value * price, exact for up to eight decimals."""
    return ((qty * contract).cast("decimal(20,8)") * price).cast(NOTIONAL)


def weighted(price: Column, amount: Column) -> Column:
    return (price * amount).cast(WEIGHTED)


def plain(amount: Column, digits: int = 4) -> Column:
    """A decimal as a double with few enough digits to be exact."""
    return F.round(amount, digits).cast(f"decimal(22,{digits})").cast("double")


def ratio(a: Column, b: Column, digits: int = 6) -> Column:
    """Double quotient rounded at the end; null where the divisor is 0."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), digits)


def half_even(x: Column, digits: int) -> Column:
    return F.bround(x, digits)
