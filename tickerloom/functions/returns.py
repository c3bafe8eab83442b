"""Factor and return arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom.schemas import FACTOR


def price_factor(reference: Column, previous_close: Column) -> Column:
    """Exchange reference price over the previous close, 18 decimals."""
    return (reference / previous_close).cast(FACTOR)


def dividend_factor(close: Column, amount: Column) -> Column:
    """Share of the close left after paying `amount`.

    Divided as doubles: a (20,4) / (33,16) decimal division would keep only six
    decimals. The stored factor has about 16 significant digits.
    """
    c = close.cast("double")
    return (c / (c + amount.cast("double"))).cast(FACTOR)


def simple_return(numerator: Column, base: Column) -> Column:
    """``numerator / base - 1`` as a double, NULL when the base is missing or zero."""
    return F.try_divide(numerator.cast("double"), base.cast("double")) - F.lit(1.0)


def price_return(close: Column, reference: Column) -> Column:
    return simple_return(close, reference)


def total_return(close: Column, dividend: Column, reference: Column) -> Column:
    """Return with the day's gross dividend added to the close."""
    paid = close.cast("double") + F.coalesce(dividend.cast("double"), F.lit(0.0))
    return simple_return(paid, reference)


def index_return(close: Column, previous: Column) -> Column:
    return simple_return(close, previous)
