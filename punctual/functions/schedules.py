"""Deadline dates of the four schedules as array expressions.

A workflow's dates are built as one array in its own row, so the configuration is read once and
neighbouring deadlines are found by position, without a window shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual import schemas as S
from punctual.functions.instants import deadline_instant


@dataclass(frozen=True)
class ScheduleWindow:
    """How far each schedule reaches around the local date.

    Daily limits are days before and after today; the others are first and last step numbers. A
    weekly window steps from the latest matching weekday, or from the first one on or after
    ``weekly_reach_back`` days ago when that is set.
    """

    daily: tuple[int, int]
    weekly: tuple[int, int]
    fortnightly: tuple[int, int]
    monthly: tuple[int, int]
    weekly_reach_back: int | None = None


# The reach of each view.
CURRENT = ScheduleWindow(daily=(2, 1), weekly=(-2, 1), fortnightly=(-2, 1), monthly=(-2, 1))
HISTORY = ScheduleWindow(
    daily=(61, 31), weekly=(-1, 14), fortnightly=(-5, 3), monthly=(-3, 2), weekly_reach_back=61
)
FIXED_DATE_HISTORY = ScheduleWindow(
    daily=(61, 2), weekly=(-1, 14), fortnightly=(-5, 3), monthly=(-3, 2), weekly_reach_back=61
)


def weekday_number(name: Column) -> Column:
    """Sunday is 1, as in ``dayofweek``; an unknown name gives null."""

    return F.nullif(F.array_position(F.array(*map(F.lit, S.WEEKDAYS)), name).cast("int"), F.lit(0))


def _steps(limits: tuple[int, int], date_at: Callable[[Column], Column]) -> Column:
    return F.transform(F.sequence(F.lit(limits[0]), F.lit(limits[1])), date_at)


def _weekly(today: Column, weekday: Column, window: ScheduleWindow) -> Column:
    if window.weekly_reach_back is None:
        anchor = F.date_sub(today, F.pmod(F.dayofweek(today) - weekday, F.lit(7)))
    else:
        start = F.date_sub(today, window.weekly_reach_back)
        anchor = F.date_add(start, F.pmod(weekday - F.dayofweek(start), F.lit(7)))
    return _steps(window.weekly, lambda week: F.date_add(anchor, week * 7))


def _fortnightly(today: Column, first: Column, window: ScheduleWindow) -> Column:
    passed = F.greatest(F.floor(F.datediff(today, first) / F.lit(14.0)).cast("int"), F.lit(0))
    return _steps(window.fortnightly, lambda step: F.date_add(first, (passed + step) * 14))


def _monthly(today: Column, day: Column, window: ScheduleWindow) -> Column:
    def date_in(step: Column) -> Column:
        first_day = F.add_months(F.trunc(today, "month"), step)
        return F.date_add(first_day, F.least(day, F.dayofmonth(F.last_day(first_day))) - 1)

    return _steps(window.monthly, date_in)


def deadline_dates(window: ScheduleWindow) -> Column:
    """Array of local deadline dates; needs ``local_today`` and the schedule columns."""

    today, frequency = F.col("local_today"), F.col("frequency")
    daily = F.sequence(F.date_sub(today, window.daily[0]), F.date_add(today, window.daily[1]))
    return (
        F.when(frequency == "daily", daily)
        .when(frequency == "weekly", _weekly(today, weekday_number(F.col("day_of_week")), window))
        .when(frequency == "fortnightly", _fortnightly(today, F.col("first_deadline_date"), window))
        .when(frequency == "monthly", _monthly(today, F.col("day_of_month"), window))
    )


def ordered_deadlines(window: ScheduleWindow) -> Column:
    """Array of (deadline_utc, deadline_date) in time order."""

    def with_instant(date: Column) -> Column:
        at = deadline_instant(date, F.col("completion_time"), F.col("timezone"))
        return F.struct(at.alias("deadline_utc"), date.alias("deadline_date"))

    dates = F.filter(deadline_dates(window), lambda date: date.isNotNull())
    return F.sort_array(F.transform(dates, with_instant))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it.

    A plain column would be copied into every mention when the optimiser merges projections.
    """

    return F.get(F.transform(F.array(value), body), F.lit(0))


def period_array(window: ScheduleWindow) -> Column:
    """Array of periods in time order: each deadline with the one before and the one after it."""

    def with_neighbours(deadlines: Column) -> Column:
        def period(deadline: Column, position: Column) -> Column:
            return F.struct(
                deadline["deadline_date"].alias("deadline_date"),
                F.get(deadlines, position - 1)["deadline_utc"].alias("previous_deadline_utc"),
                deadline["deadline_utc"].alias("deadline_utc"),
                F.get(deadlines, position + 1)["deadline_utc"].alias("next_deadline_utc"),
            )

        return F.transform(deadlines, period)

    return let(ordered_deadlines(window), with_neighbours)


def last_and_next_period(window: ScheduleWindow, as_of: Column) -> Column:
    """Struct of the latest due and the next eligible period, null where there is none."""

    def choose(periods: Column) -> Column:
        due = F.filter(periods, lambda period: period["deadline_utc"] <= as_of)
        upcoming = F.filter(periods, lambda period: period["deadline_utc"] > as_of)
        return F.struct(
            F.try_element_at(due, F.lit(-1)).alias("last"), F.get(upcoming, F.lit(0)).alias("next")
        )

    return let(F.filter(period_array(window), is_eligible), choose)


def is_eligible(period: Column | None = None) -> Column:
    """The first generated date only bounds a period, and so do fortnightly dates before the anchor."""

    def field(name: str) -> Column:
        return F.col(name) if period is None else period[name]

    started = (F.col("frequency") != "fortnightly") | (
        field("deadline_date") >= F.col("first_deadline_date")
    )
    return field("previous_deadline_utc").isNotNull() & started
