"""Calendar expressions. Two weekday numberings are in use: Sunday = 0 in the ledger, Monday = 1 in the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def parse_date(text: Column) -> Column:
    """ISO date text to a date; anything else is null.

    Plain dates are cast, which takes a fraction of the formatter's time and gives the same day; year zero and all other
    texts are left to the formatter.
    """
    plain = text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & (text >= "0001")
    return F.when(plain, text.try_cast("date")).otherwise(F.try_to_date(text, "yyyy-MM-dd"))


def sunday_zero(day: Column) -> Column:
    return F.dayofweek(day) - 1


def monday_one(day: Column) -> Column:
    return F.weekday(day) + 1


def day_name(day: Column) -> Column:
    name = F.element_at(F.array(*[F.lit(name) for name in DAY_NAMES]), F.dayofweek(day))
    return F.when(day.isNotNull(), name)  # Spark takes the element of a full array for never null


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def period_label(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
