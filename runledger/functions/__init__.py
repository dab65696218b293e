"""Column-level helpers: clocks, paths and predicates."""

from .clock import (
    clock_us,
    days_and_seconds,
    format_clock,
    hex_epoch,
    micros_between,
    midnight,
    parse_log_time,
    run_key,
)
from .path import ancestors, depth, is_under, name, parent, segments
from .predicate import commands_in, in_calendar, in_date_range, is_status, later_than

__all__ = [
    "ancestors",
    "clock_us",
    "commands_in",
    "days_and_seconds",
    "depth",
    "format_clock",
    "hex_epoch",
    "in_calendar",
    "in_date_range",
    "is_status",
    "is_under",
    "later_than",
    "micros_between",
    "midnight",
    "name",
    "parent",
    "parse_log_time",
    "run_key",
    "segments",
]
