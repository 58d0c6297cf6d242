"""Money arithmetic and rounding.

Staged amounts have two decimals, so sums run over whole cents in a 64-bit integer: the result
does not depend on the order in which partitions arrive, and an overflow raises instead of drifting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(amount: Column | str = "amount") -> Column:
    return F.rint(col(amount) * 100).cast("long")


def round_cents(value: Column | str) -> Column:
    """``round(value, 2)``, half away from zero by the number's text.

    Rounding by text costs several times what arithmetic does, so that is left to values within a thousandth of a cent of a half
    cent, and to those that are not positive or from 1e9 on. Elsewhere both give the double nearest to the same number of cents.
    """
    number = col(value)
    scaled = number * 100
    clear = (number > 0) & (number < 1e9) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(clear, F.rint(scaled) / 100.0).otherwise(F.round(number, 2))


def money_sum(amount: Column | str = "amount", where: Column | None = None) -> Column:
    """Exact sum; with ``where``, rows that fail it count as zero."""
    value = cents(amount)
    if where is not None:
        value = F.when(where, value).otherwise(F.lit(0).cast("long"))
    return F.sum(value) / 100.0


def money_avg(amount: Column | str = "amount") -> Column:
    return F.try_divide(F.sum(cents(amount)) / 100.0, F.count(col(amount)))


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; null counts as no."""
    return F.count(F.when(condition, F.lit(1)))


def flag(condition: Column) -> Column:
    """1 or 0; a null condition is 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Divide, with 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), digits)


def in_any_band(amount: Column, bands) -> Column:
    """Closed bands, as the audit rule states them."""
    hit = F.lit(False)
    for band in bands:
        hit = hit | amount.between(band.low, band.high)
    return hit


def below_any_limit(amount: Column, bands) -> Column:
    """Half-open bands up to the limit itself, as the model feature states them."""
    hit = F.lit(False)
    for band in bands:
        hit = hit | ((amount >= band.low) & (amount < band.limit))
    return hit


def targeted_limit(amount: Column, bands) -> Column:
    """The approval limit that an amount sits just below; null outside every band."""
    limit = F.lit(None).cast("int")
    for band in reversed(bands):
        limit = F.when(amount.between(band.low, band.high), F.lit(band.limit)).otherwise(limit)
    return limit


def nearest_limit_distance(amount: Column, limits) -> Column:
    return F.least(*[F.abs(amount - F.lit(float(limit))) for limit in limits])


def leading_digit(amount: Column) -> Column:
    """First character of the number's text if it is 1 to 9, else 0.

    From 1 up to 1e15 it is that of the whole part, whose text is made much faster than that of a double.
    """
    digit = F.regexp_extract(amount.cast("string"), "^([1-9])", 1)
    by_text = F.coalesce(F.nullif(digit, F.lit("")).cast("int"), F.lit(0))
    whole = F.substring(amount.cast("long").cast("string"), 1, 1).cast("int")
    return F.when((amount >= 1) & (amount < 1e15), whole).otherwise(by_text)


def clean_text(value: Column | str) -> Column:
    """Trim spaces; an empty text is null."""
    return F.nullif(F.trim(col(value)), F.lit(""))
