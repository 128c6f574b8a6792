"""Trading-calendar predicates as plain column expressions: no calendar table, no join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: US federal holidays. (month, day, first year) moved to the nearest weekday,
# and (month, ISO weekday, earliest day, latest day, first year) by weekday of the month.
FIXED_HOLIDAYS = [(1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0)]
WEEKDAY_HOLIDAYS = [
    (1, 1, 15, 21, 1986),
    (2, 1, 15, 21, 0),
    (5, 1, 25, 31, 0),
    (9, 1, 1, 7, 0),
    (10, 1, 8, 14, 0),
    (11, 4, 22, 28, 0),
]


def iso_weekday(d: Column) -> Column:
    """Monday is 1, Sunday 7."""
    return F.weekday(d) + 1


def is_weekend(d: Column) -> Column:
    return iso_weekday(d) > 5


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _fixed(d: Column) -> Column:
    return _any(
        [(F.month(d) == m) & (F.day(d) == k) & (F.year(d) >= y) for m, k, y in FIXED_HOLIDAYS]
    )


def is_federal_holiday(d: Column) -> Column:
    """Observed US federal holiday: a fixed one falling on Saturday counts on Friday, one on
    Sunday on Monday."""
    weekday = iso_weekday(d)
    observed = (
        (_fixed(d) & (weekday <= 5))
        | (_fixed(F.date_add(d, 1)) & (weekday == 5))
        | (_fixed(F.date_sub(d, 1)) & (weekday == 1))
    )
    moving = _any(
        [
            (F.month(d) == m) & (weekday == wd) & F.day(d).between(lo, hi) & (F.year(d) >= y)
            for m, wd, lo, hi, y in WEEKDAY_HOLIDAYS
        ]
    )
    return observed | moving
