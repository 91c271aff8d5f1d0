"""Time helpers: explicit `as_of` literals and calendar arithmetic as columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal (the driver's parquet timestamps are NTZ)."""
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = value
    return F.lit(text).cast("timestamp_ntz")


def date_lit(value: dt.datetime | dt.date) -> Column:
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value)


def days_before(ts: Column, days) -> Column:
    """`ts - n days`, time of day kept (legacy DATE_ADD(ts, -n, 'DAY'))."""
    n = days if isinstance(days, Column) else F.lit(days)
    return ts - F.make_dt_interval(days=n)


def days_after(ts: Column, days) -> Column:
    n = days if isinstance(days, Column) else F.lit(days)
    return ts + F.make_dt_interval(days=n)


def hours_after(ts: Column, hours) -> Column:
    n = hours if isinstance(hours, Column) else F.lit(hours)
    return ts + F.make_dt_interval(hours=n)


def minutes_before(ts: Column, minutes) -> Column:
    n = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return ts - F.make_dt_interval(mins=n)


def months_before_date(d: dt.date, months: int) -> dt.date:
    """Calendar months back with month-end clamping (relativedelta rules).

    Computed on the driver for a scalar `as_of`; `F.add_months` does the same
    for columns.
    """
    y, m = divmod(d.year * 12 + (d.month - 1) - months, 12)
    m += 1
    import calendar

    day = min(d.day, calendar.monthrange(y, m)[1])
    return dt.date(y, m, day)


def months_before(ts: dt.datetime, months: int) -> dt.datetime:
    d = months_before_date(ts.date(), months)
    return dt.datetime.combine(d, ts.time())


def yyyymmdd(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")
