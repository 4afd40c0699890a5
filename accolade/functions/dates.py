"""Business-day and calendar arithmetic on columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from accolade.policy import Policy


def resolve_as_of(policy: Policy, now_utc: dt.datetime | None = None) -> dt.date:
    """The run's business day: the policy's date, else derived from the clock.

    Resolved once on the driver, so every operator of a run sees the same literal and
    Catalyst can fold it into scan filters.
    """
    if policy.as_of_date is not None:
        return policy.as_of_date
    now = now_utc or dt.datetime.now(dt.timezone.utc)
    return (now + dt.timedelta(hours=policy.utc_offset_hours - policy.day_start_hour)).date()


def business_day(ts: Column, start_hour: int) -> Column:
    """Day a local timestamp belongs to when days roll over at ``start_hour``."""
    return (ts - F.make_dt_interval(hours=F.lit(start_hour))).cast("date")


def in_business_days(ts: Column, first: dt.date, last: dt.date, start_hour: int) -> Column:
    """Raw-timestamp form of ``business_day(ts) between first and last``.

    The comparison is on the bare column, so it reaches the parquet scan.
    """
    low = dt.datetime.combine(first, dt.time()) + dt.timedelta(hours=start_hour)
    high = dt.datetime.combine(last, dt.time()) + dt.timedelta(days=1, hours=start_hour)
    as_ntz = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    return (ts >= as_ntz(low)) & (ts < as_ntz(high))


def days_ago(as_of: dt.date, days: int) -> Column:
    """Literal date ``days`` before ``as_of`` (negative = after)."""
    return F.lit(as_of - dt.timedelta(days=days))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def year_boundaries(start: Column, end: Column) -> Column:
    """Number of 1 January crossings between two dates."""
    return F.year(end) - F.year(start)


def add_years(day: Column, years: Column | int) -> Column:
    """Same month and day ``years`` later; 29 February falls back to 28 February."""
    n = F.lit(years) if isinstance(years, int) else years
    return F.add_months(day, (n * 12).cast("int"))


def _month_day(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)


def age_on(born: Column, ref: Column) -> Column:
    """Completed years from ``born`` to ``ref``."""
    not_reached = (_month_day(born) > _month_day(ref)).cast("int")
    return year_boundaries(born, ref) - not_reached


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_index(day: Column) -> Column:
    """Months since year 0, so consecutive months differ by one."""
    return F.year(day) * 12 + F.month(day)
