"""Period predicates around an explicit reference time.

``as_of`` is a Python date or datetime. It becomes a literal, so the bounds are
constants when the plan is made and reach the file scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from perkline.fixed_values import WINDOW_MONTHS


def _moment(as_of: dt.date | dt.datetime) -> Column:
    return F.lit(as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else as_of.isoformat()).cast(
        "timestamp_ntz"
    )


def window_start(as_of: dt.date | dt.datetime, months: int = WINDOW_MONTHS) -> Column:
    """Midnight of the day ``months`` before ``as_of``; month ends are clamped."""
    return F.add_months(_moment(as_of).cast("date"), -months).cast("timestamp_ntz")


def in_window(
    moment: Column,
    as_of: dt.date | dt.datetime,
    months: int = WINDOW_MONTHS,
    bounded: bool = False,
) -> Column:
    """Inside the rolling window. ``bounded`` also drops rows after ``as_of``."""
    inside = moment >= window_start(as_of, months)
    return inside & (moment <= _moment(as_of)) if bounded else inside


def too_old(moment: Column, as_of: dt.date | dt.datetime, months: int = WINDOW_MONTHS) -> Column:
    return moment < window_start(as_of, months)


def in_future(moment: Column, as_of: dt.date | dt.datetime) -> Column:
    return moment > _moment(as_of)


def outside(moment: Column, start: dt.date | dt.datetime, end: dt.date | dt.datetime) -> Column:
    return (moment < _moment(start)) | (moment > _moment(end))
