"""Which days a run covers. ``run_date`` is always given, never read from a clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pulsegrain import fixed_values as fv
from pulsegrain.config import Settings

EPOCH = dt.date(1970, 1, 1)
MICROS_PER_DAY = 86_400_000_000


def micros_at_midnight(day: dt.date) -> int:
    return (day - EPOCH).days * MICROS_PER_DAY


@dataclass(frozen=True)
class DateWindow:
    """Days from ``start`` to ``end``, both included."""

    start: dt.date
    end: dt.date

    def has_date(self, day: str) -> str:
        return f"{day} BETWEEN DATE '{self.start}' AND DATE '{self.end}'"

    def has_day_of_micros(self, micros: str) -> str:
        """The same on epoch microseconds; a plain range, so it reaches the scan."""
        after = micros_at_midnight(self.end + dt.timedelta(days=1))
        return f"({micros} >= {micros_at_midnight(self.start)} AND {micros} < {after})"

    def has_instant(self, ts: str) -> str:
        """Between midnight of ``start`` and midnight of ``end``: of the last day
        only its first instant. Compared with literals, so it reaches the scan."""
        return (f"({ts} >= TIMESTAMP '{self.start} 00:00:00+00:00' "
                f"AND {ts} <= TIMESTAMP '{self.end} 00:00:00+00:00')")

    def has_shard(self, suffix: str) -> str:
        first, last = (d.strftime(fv.SHARD_DATE_FORMAT) for d in (self.start, self.end))
        return f"replace({suffix}, '{fv.INTRADAY_PREFIX}', '') BETWEEN '{first}' AND '{last}'"

    def covers_shard(self, suffix: str) -> bool:
        """:meth:`has_shard` of the name of a folder."""
        first, last = (d.strftime(fv.SHARD_DATE_FORMAT) for d in (self.start, self.end))
        return first <= suffix.replace(fv.INTRADAY_PREFIX, "") <= last


@dataclass(frozen=True)
class Run:
    """One build: which settings, which day it is, whole history or the last days."""

    settings: Settings
    run_date: dt.date
    incremental: bool = True

    def analytics(self, extend: int = 0) -> DateWindow:
        s = self.settings
        if self.incremental:
            return self._trailing(s.analytics_incremental_days + extend)
        return DateWindow(s.analytics_start, s.analytics_end or self._tomorrow)

    def crash(self, extend: int = 0) -> DateWindow:
        s = self.settings
        if self.incremental:
            # A configured number of days is taken as it is, without extension.
            days = s.crash_incremental_days
            return self._trailing(fv.INCREMENTAL_DAYS + extend if days is None else days)
        return DateWindow(s.crash_start, s.crash_end or self._tomorrow)

    def shards(self, extend: int = 0) -> DateWindow:
        """Shards are cut in a local time zone, so look one day further back."""
        return self.analytics(extend + fv.SHARD_LOOKBACK_DAYS)

    def checking(self) -> Run:
        """The run that data checks use: always the trailing window."""
        return replace(self, incremental=True)

    @property
    def _tomorrow(self) -> dt.date:
        return self.run_date + dt.timedelta(days=1)

    def _trailing(self, days: int) -> DateWindow:
        return DateWindow(self.run_date - dt.timedelta(days=days), self._tomorrow)
