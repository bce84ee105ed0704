"""Time expressions: observation days, report windows, series."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def observation_day(published_at: Column) -> Column:
    """Day of an end-of-hour stamp: 01:00 to the next midnight is one day."""
    return F.to_date(published_at - F.expr("INTERVAL 1 HOUR"))


def observation_hour(published_at: Column) -> Column:
    """Hour 1..24 of an end-of-hour stamp within its observation day."""
    return F.hour(published_at - F.expr("INTERVAL 1 HOUR")) + 1


def _wall_clock(ts: Column, **fields: Column) -> Column:
    """Midnight of the stamp's day plus some of its clock fields, without zone.

    Built from fields instead of truncating, because truncation goes through the
    session's time zone and moves stamps around its clock changes.
    """
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(**fields)


def floor_second(ts: Column) -> Column:
    return _wall_clock(ts, hours=F.hour(ts), mins=F.minute(ts), secs=F.second(ts))


def floor_minute(ts: Column) -> Column:
    return _wall_clock(ts, hours=F.hour(ts), mins=F.minute(ts))


def floor_hour(ts: Column) -> Column:
    return _wall_clock(ts, hours=F.hour(ts))


def hours_before(as_of: Column, hours: int) -> Column:
    """Top of the hour ``hours`` hours before ``as_of``."""
    return floor_hour(as_of) - F.make_dt_interval(hours=F.lit(hours))


def days_before(as_of: Column, days: int) -> Column:
    return F.date_sub(F.to_date(as_of), days)


def month_start(as_of: Column) -> Column:
    return F.to_date(F.date_trunc("month", as_of))


def last_month_start(as_of: Column) -> Column:
    return F.add_months(month_start(as_of), -1)


def last_quarter_start(as_of: Column) -> Column:
    """First day of the last full quarter before ``as_of``."""
    return F.add_months(F.to_date(F.date_trunc("quarter", as_of)), -3)


def quarter_start(as_of: Column) -> Column:
    return F.to_date(F.date_trunc("quarter", as_of))


def week_end(as_of: Column) -> Column:
    """Friday of the Sunday-to-Saturday week that holds ``as_of``."""
    return F.date_add(F.to_date(as_of), F.lit(6) - F.dayofweek(as_of))


def week_start(as_of: Column) -> Column:
    """Saturday that opens the seven-day report week ending on :func:`week_end`."""
    return F.date_sub(week_end(as_of), 6)


def hour_series(first: Column, last: Column) -> Column:
    """Every hour from ``first`` to ``last``, both included, as an array."""
    return F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))


def day_series(first: Column, last: Column) -> Column:
    """Every day from ``first`` to ``last``, both included, as an array."""
    return F.sequence(F.to_date(first), F.to_date(last), F.expr("INTERVAL 1 DAY"))
