"""Composite windows (months and ten-day dekads), step arithmetic and seasons as date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def align_to_composite(d: Column, freq: str = "month") -> Column:
    """Start of the month or dekad that holds a date; dekads start on days 1, 11 and 21."""
    first = F.trunc(d, "month")
    if freq == "month":
        return first
    day = F.dayofmonth(d)
    return F.date_add(first, F.when(day <= 10, 0).when(day <= 20, 10).otherwise(20))


def advance_slot(d: Column, freq: str = "month") -> Column:
    """Start of the slot after the one that holds a date."""
    start = align_to_composite(d, freq)
    following = F.add_months(F.trunc(d, "month"), 1)
    if freq == "month":
        return following
    return F.when(F.dayofmonth(start) == 21, following).otherwise(F.date_add(start, 10))


def slot_end(d: Column, freq: str = "month") -> Column:
    """Last day of the slot that holds a date."""
    return F.date_sub(advance_slot(d, freq), 1)


def enumerate_slots(start: Column, end: Column, freq: str = "month") -> Column:
    """Slot starts from the slot of ``start`` to that of ``end``; empty when reversed."""
    a, b = align_to_composite(start, freq), align_to_composite(end, freq)
    months = F.sequence(F.trunc(a, "month"), F.trunc(F.greatest(a, b), "month"), F.expr("INTERVAL 1 MONTH"))
    if freq != "month":
        months = F.flatten(F.transform(months, lambda m: F.array(m, F.date_add(m, 10), F.date_add(m, 20))))
    return F.filter(months, lambda s: (s >= a) & (s <= b))


def step_ordinal(d: Column, freq: str = "month") -> Column:
    """Months or dekads since year 0."""
    months = F.year(d) * 12 + F.month(d) - 1
    if freq == "month":
        return months
    return months * 3 + F.least(F.lit(2), F.floor((F.dayofmonth(d) - 1) / 10).cast("int"))


def step_date(ordinal: Column, freq: str = "month") -> Column:
    """Start date of a step ordinal."""
    months = ordinal if freq == "month" else F.floor(ordinal / 3)
    first = F.make_date(F.floor(months / 12).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1))
    return first if freq == "month" else F.date_add(first, (F.pmod(ordinal, F.lit(3)) * 10).cast("int"))


def step_in_year(d: Column, freq: str = "month") -> Column:
    return F.pmod(step_ordinal(d, freq), F.lit(12 if freq == "month" else 36))


def month_shift(a: Column, b: Column) -> Column:
    """Months from ``a`` to ``b`` within a year, 0 to 11."""
    return F.pmod(F.month(b) - F.month(a), F.lit(12))


def day_in_month(year: Column, month: Column | int, day: int) -> Column:
    """Date of a month and day in a year, the day cut to the month's end."""
    first = F.make_date(year, month if isinstance(month, Column) else F.lit(month), F.lit(1))
    return F.least(F.date_add(first, day - 1), F.last_day(first))


def resolve_season_bounds(reference: Column, start: tuple[int, int], end: tuple[int, int], year_offset: int) -> tuple[Column, Column]:
    """The season of a (month, day) window for a reference date: the one that holds it or ends next.

    ``year_offset`` is 1 when the window ends in the year after it starts.
    """
    past = (F.month(reference) > end[0]) | ((F.month(reference) == end[0]) & (F.dayofmonth(reference) > end[1]))
    end_year = F.year(reference) + F.when(past, 1).otherwise(0)
    return day_in_month(end_year - year_offset, *start), day_in_month(end_year, *end)


def in_season(d: Column, start: Column, end: Column, freq: str | None = None) -> Column:
    """Whether a date lies in a season; with a frequency the bounds widen to whole composites."""
    if freq:
        start, end = align_to_composite(start, freq), slot_end(end, freq)
    return (d >= start) & (d <= end)


def doy_season_dates(sos: Column, eos: Column, year: Column) -> tuple[Column, Column]:
    """Season dates of start and end days of year in a reference year.

    The end is Jan 1 plus eos days; when the end isn't after the start the season began the year before.
    """
    first = F.make_date(year, F.lit(1), F.lit(1))
    end = F.date_add(first, eos)
    length = F.when(eos > sos, eos - sos).otherwise(365 - sos + eos)
    return F.date_sub(end, length), end


def dekad_date(dekad: Column, year: Column, mode: str) -> Column:
    """Month bound of a dekad counted 1 to 108 over the year before, the target year and the year after.

    ``first``: start of the month, third dekads counting as the next month; ``last``: end of the month, first dekads
    counting as the month before.
    """
    k = (dekad - 1).cast("int")
    months = (year - 1) * 12 + F.floor(k / 3).cast("int")
    within = F.pmod(k, F.lit(3))
    months = months + (F.when(within == 2, 1).otherwise(0) if mode == "first" else F.when(within == 0, -1).otherwise(0))
    start = step_date(months)
    return start if mode == "first" else F.last_day(start)
