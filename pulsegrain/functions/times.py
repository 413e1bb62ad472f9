"""Dates, ages and offsets from epoch microseconds.

Plain integer arithmetic: no session time zone or daylight saving involved, and
all of it runs inside generated code.
"""

from __future__ import annotations

from pulsegrain import fixed_values as fv
from pulsegrain.functions.sqltext import struct

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def _floor_div(value: str, unit: int) -> str:
    return f"(({value}) - pmod({value}, {unit})) div {unit}"


def utc_date(ts: str) -> str:
    """Calendar day in UTC."""
    return f"date_from_unix_date(int({_floor_div(f'unix_micros({ts})', MICROS_PER_DAY)}))"


def hour_number(ts: str) -> str:
    """Whole hours since the epoch."""
    return _floor_div(f"unix_micros({ts})", MICROS_PER_HOUR)


def offset_name(hours: int) -> str:
    return f"{'minus' if hours < 0 else 'plus'}_{abs(hours)}"


def zone_dates(hour: str) -> str:
    """Calendar day at each whole-hour offset from UTC, as one struct.

    ``hour`` is an :func:`hour_number`, best computed once per row.
    """
    return struct({
        offset_name(n): f"date_from_unix_date(int(floor(({hour} + {n}) / 24)))"
        for n in fv.ZONE_OFFSETS})


def age_in_days(later: str, earlier: str) -> str:
    """Days as whole hours, cut toward zero, over 24, rounded down."""
    return (f"floor(((unix_micros({later}) - unix_micros({earlier})) div {MICROS_PER_HOUR}) "
            "/ 24)")


def wall_clock_age(later: str, earlier: str) -> str:
    """Days as minute boundaries crossed over 1440, rounded down."""
    end = _floor_div(f"unix_micros({later})", MICROS_PER_MINUTE)
    start = _floor_div(f"unix_micros({earlier})", MICROS_PER_MINUTE)
    return f"floor(({end} - {start}) / 1440)"


def zone_ages(age: str) -> str:
    """A :func:`wall_clock_age` at each offset.

    Whole-hour offsets move both ends by the same number of minutes, so every
    field holds the same age.
    """
    return struct({offset_name(n): age for n in fv.ZONE_OFFSETS})


def age_group(age: str) -> str:
    """Cohort label. A NULL age fails every test and lands in the last group."""
    tests = " ".join(f"WHEN {age} <= {upper} THEN '{label}'" for upper, label in fv.AGE_GROUPS)
    return (f"CASE WHEN {age} = 0 THEN '{fv.AGE_GROUP_ZERO}' {tests} "
            f"ELSE '{fv.AGE_GROUP_REST}' END")


def offset_text(seconds: str) -> str:
    """``+HH:MM`` from an offset in seconds."""
    clock = f"pmod(abs({seconds}), 86400)"
    return (f"concat(if({seconds} >= 0, '+', '-'), lpad(string({clock} div 3600), 2, '0'), ':', "
            f"lpad(string(({clock} div 60) % 60), 2, '0'))")


def within_a_day_after(ts: str, start: str) -> str:
    """``ts`` is at most 24 hours after ``start``, both ends included."""
    return f"unix_micros({ts}) - unix_micros({start}) BETWEEN 0 AND {MICROS_PER_DAY}"
