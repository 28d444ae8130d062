"""Gregorian to Ethiopian dates, as column arithmetic on the day number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Julian day number of 1970-01-01, and of the first day of the calendar.
_UNIX_EPOCH_DAY = 2440588
_FIRST_DAY = 1723856
_FOUR_YEARS = 1461


def ethiopian_date(text: Column) -> Column:
    """'YYYY-MM-DD' in the Ethiopian calendar; text that is no date comes back unchanged.

    Twelve months have 30 days; the thirteenth has five, or six every fourth year.
    """
    day = F.when(text.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}\z"), text.try_cast("date"))
    n = F.unix_date(day) + (_UNIX_EPOCH_DAY - _FIRST_DAY)
    in_cycle = n % _FOUR_YEARS
    # The last day of a four-year cycle is day 365 of its fourth year.
    last = F.floor(in_cycle / (_FOUR_YEARS - 1))
    in_year = in_cycle % 365 + 365 * last
    year = 4 * F.floor(n / _FOUR_YEARS) + F.floor(in_cycle / 365) - last
    shown = F.format_string(
        "%04d-%02d-%02d", year, F.floor(in_year / 30) + 1, (in_year % 30 + 1).cast("long")
    )
    return F.when(n >= 0, shown).otherwise(text)
