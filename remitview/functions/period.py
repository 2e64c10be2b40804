"""Report period: the calendar month before the run date (M1-M3).

The run date is always an explicit argument; nothing here reads the clock
inside a query, so a rerun for a past month gives the same rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def prev_month_window(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the calendar month before ``as_of`` (inclusive)."""
    first_this_month = as_of.replace(day=1)
    last_prev = first_this_month - dt.timedelta(days=1)
    return last_prev.replace(day=1), last_prev


def prev_month_bounds(as_of: Column) -> tuple[Column, Column]:
    """Column form of :func:`prev_month_window` for a date column."""
    prev = F.add_months(as_of, -1)
    return F.trunc(prev, "MM"), F.last_day(prev)


def run_stamps(as_of: dt.date) -> dict[str, str]:
    """Run-date stamps used in output names (``MMDDYYYY`` and ``YYYYMMDD``)."""
    return {"mmddyyyy": as_of.strftime("%m%d%Y"), "yyyymmdd": as_of.strftime("%Y%m%d")}


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))
