"""Holidays by rule: fixed dates, the n-th weekday of a month, and days counted from Easter, as expressions on a date column.

A date is tested by itself, without a table of holidays and without a join, in any year of the Gregorian calendar.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONDAY, TUESDAY, WEDNESDAY, THURSDAY, FRIDAY, SATURDAY, SUNDAY = range(7)


@dataclass(frozen=True)
class Fixed:
    """The same date each year, from the year ``since`` on."""

    month: int
    day: int
    since: int = 0

    def on(self, day: Column) -> Column:
        return (F.month(day) == self.month) & (F.dayofmonth(day) == self.day) & (F.year(day) >= self.since)


@dataclass(frozen=True)
class NthWeekday:
    """The n-th weekday (Monday is 0) of a month; -1 is the last one."""

    month: int
    weekday: int
    n: int
    since: int = 0

    def on(self, day: Column) -> Column:
        if self.n > 0:
            nth = F.floor((F.dayofmonth(day) - 1) / 7) + 1 == self.n
        else:
            to_the_end = F.dayofmonth(F.last_day(day)) - F.dayofmonth(day)
            nth = F.floor(to_the_end / 7) + 1 == -self.n
        return (F.month(day) == self.month) & (F.weekday(day) == self.weekday) & nth & (F.year(day) >= self.since)


@dataclass(frozen=True)
class FromEaster:
    """Days after Easter Sunday, or before it if negative."""

    days: int
    since: int = 0

    def on(self, day: Column) -> Column:
        # The offset may lead into another year only beyond two months, which no rule does.
        return (F.date_sub(day, self.days) == easter(F.year(day))) & (F.year(day) >= self.since)


Rule = Fixed | NthWeekday | FromEaster


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year, from the golden number, the epact and the Sunday after the full moon."""

    def div(value: Column, by: int) -> Column:
        return F.floor(value / by)

    century = div(year, 100)
    skipped = century - div(century, 4)
    moon = (19 * (year % 19) + skipped - div(8 * century + 13, 25) + 15) % 30
    # Days of the full moon after 21 March; its latest values are moved so that no two years of a cycle share one.
    late = F.when((moon == 29) | ((moon == 28) & (year % 19 > 10)), 1).otherwise(0)
    full_moon = F.date_add(F.make_date(year, F.lit(3), F.lit(21)), (moon - late).cast("int"))
    return F.date_add(full_moon, 7 - (F.weekday(full_moon) + 1) % 7)


def is_holiday(day: Column, rules: Iterable[Rule], observed: bool = False) -> Column:
    """Whether a rule falls on the date. With ``observed`` also a Friday before and a Monday after a weekend holiday; false
    for no rules, NULL for a NULL date."""

    def any_of(of: Column) -> Column:
        return reduce(Column.__or__, [rule.on(of) for rule in rules], of != of)

    rules = list(rules)
    found = any_of(day)
    if observed:
        friday, monday = F.weekday(day) == FRIDAY, F.weekday(day) == MONDAY
        found = found | (friday & any_of(F.date_add(day, 1))) | (monday & any_of(F.date_sub(day, 1)))
    return found


#: Federal holidays of the United States (fixed values).
US_FEDERAL: tuple[Rule, ...] = (
    Fixed(1, 1),
    NthWeekday(1, MONDAY, 3, since=1986),
    NthWeekday(2, MONDAY, 3),
    NthWeekday(5, MONDAY, -1),
    Fixed(6, 19, since=2021),
    Fixed(7, 4),
    NthWeekday(9, MONDAY, 1),
    NthWeekday(10, MONDAY, 2),
    Fixed(11, 11),
    NthWeekday(11, THURSDAY, 4),
    Fixed(12, 25),
)

#: Closing days of the euro payment system, on which banks do not settle (fixed values).
SETTLEMENT: tuple[Rule, ...] = (Fixed(1, 1), FromEaster(-2), FromEaster(1), Fixed(5, 1), Fixed(12, 25), Fixed(12, 26))
