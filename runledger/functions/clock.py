"""Dates, clocks and durations as plain Column expressions.

Log clocks carry no zone, so everything here stays on ``TIMESTAMP_NTZ`` and
whole microseconds; nothing depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


# Fixed value: the form of a log time, one or two digits a field.
_LOG_TIME = r"^(\d{1,2}):(\d{1,2}):(\d{1,2}) (\d{1,2})\.(\d{1,2})\.(\d{4})$"


def parse_log_time(text: Column) -> Column:
    """``H:M:S d.m.Y`` with one- or two-digit fields; null when malformed."""
    hour, minute, second, day, month, year = (F.regexp_extract(text, _LOG_TIME, k).try_cast("int") for k in range(1, 7))
    return F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("double"))


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from ``start`` to ``end``."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def clock_us(day: Column, moment: Column) -> Column:
    """Offset of ``moment`` from the midnight that opens ``day``."""
    return micros_between(midnight(day), moment)


def run_key(day: Column) -> Column:
    """The ``yyyyMMddHH`` label of a run day."""
    return F.date_format(midnight(day), "yyyyMMddHH")


def days_and_seconds(micros: Column) -> tuple[Column, Column]:
    """A duration as (whole days, remaining whole seconds)."""
    seconds = F.floor(micros / F.lit(1_000_000)).cast("bigint")
    return F.floor(seconds / F.lit(86400)).cast("bigint"), F.pmod(seconds, F.lit(86400))


def format_clock(micros: Column) -> Column:
    """``D days HH:MM:SS[.ffffff]``; null for null.

    Days are floored and the rest is never negative: one microsecond less than
    zero is ``-1 days 23:59:59.999999``.
    """
    days, seconds = days_and_seconds(micros)
    fraction = F.pmod(micros, F.lit(1_000_000))
    base = F.format_string(
        "%d days %02d:%02d:%02d",
        days,
        F.floor(seconds / 3600).cast("bigint"),
        F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("bigint"),
        F.pmod(seconds, F.lit(60)),
    )
    shown = F.when(fraction == 0, base).otherwise(F.concat(base, F.format_string(".%06d", fraction)))
    return F.when(micros.isNotNull(), shown)


def hex_epoch(moment: Column) -> Column:
    """Epoch seconds of a zone-less moment, read as UTC, as 8 hex digits."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.floor(micros_between(epoch, moment) / F.lit(1_000_000)).cast("bigint")
    return F.lpad(F.lower(F.hex(seconds)), 8, "0")
