"""Predicate factories: each returns a boolean Column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import RUN_COMMANDS, STATUSES
from .clock import midnight


def as_day(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)  # ValueError before any job runs
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value).cast("date")


def as_offset(value: dt.time | dt.timedelta | str) -> dt.timedelta:
    """A time of day (or ``HH:MM[:SS]`` text) as an offset from midnight."""
    if isinstance(value, str):
        value = dt.time.fromisoformat(value)
    if isinstance(value, dt.time):
        value = dt.timedelta(
            hours=value.hour,
            minutes=value.minute,
            seconds=value.second,
            microseconds=value.microsecond,
        )
    return value


def is_status(command: Column) -> Column:
    return command.isin(*STATUSES)


def commands_in(command: Column, names=RUN_COMMANDS) -> Column:
    return command.isin(*names)


def in_date_range(day: Column, first, last) -> Column:
    """Inclusive at both ends."""
    return day.between(as_day(first), as_day(last))


def in_calendar(day: Column, start, stop) -> Column:
    """Half-open: ``start`` is in, ``stop`` is out."""
    return (day >= as_day(start)) & (day < as_day(stop))


def later_than(moment: Column, day: Column | dt.date | str, time) -> Column:
    """At or after ``day`` + ``time``; for nodes that run over midnight."""
    return moment >= midnight(as_day(day)) + F.lit(as_offset(time))
