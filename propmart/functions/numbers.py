"""Numeric expressions (X7-X9) and the price-text predicate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from propmart.schemas import PRICE_SENTINELS


def text_to_double(text: Column) -> Column:
    """Number in a text column, null when it does not parse or is NaN."""
    value = F.trim(text).try_cast("double")
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def is_price_text(text: Column, sentinels: Iterable[str] = PRICE_SENTINELS) -> Column:
    """price text that holds a real number (not a sentinel, not NaN/null).

    X13: membership, negation and conjunction as ``isin``, ``~`` and ``&``.
    """
    return (~text.isin(*sentinels)) & text_to_double(text).isNotNull()


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Half away from zero on the decimal form, as SQL rounds."""
    return F.round(value, digits)


def round_exact(value: Column, digits: int = 2) -> Column:
    """A double rounded as its exact binary value asks, ties to the even digit.

    ``2.675`` lies below the tie and gives 2.67, ``0.125`` is one and gives
    0.12.  ``|x| * 10**digits`` is taken without error, as a rounded product
    and what the rounding left out (the factor is split so that all partial
    products are exact); the part past the whole number is then compared with
    one half.  Values of 2**52 and more, NaN and infinities stay as they are;
    ``digits`` is 0 to 7.
    """
    if not 0 <= digits <= 7:
        raise ValueError("digits must be 0 to 7")
    scale = F.lit(float(10**digits))
    x = F.abs(value.cast("double"))
    split = x * F.lit(134217729.0)  # 2**27 + 1
    high = split - (split - x)
    product = x * scale
    left_out = (high * scale - product) + (x - high) * scale
    whole = F.floor(product).cast("double")
    over = (product - whole) - F.lit(0.5)
    past = over + left_out
    up = (past > 0) | ((past == 0) & (F.pmod(whole, F.lit(2.0)) == 1))
    rounded = (whole + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / scale
    small = (x < F.lit(float(2**52))) & (product < F.lit(float(2**52)))
    signed = F.when(value < 0, -rounded).otherwise(rounded)
    return F.when(small, signed).otherwise(value.cast("double"))


def payback_years(price: Column, monthly_rent: Column) -> Column:
    """``price / (12 * monthly rent)``; null instead of an error at zero rent."""
    return F.try_divide(price.cast("double"), F.lit(12.0) * monthly_rent)
