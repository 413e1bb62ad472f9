"""Build every table of a run, in dependency order, each from written tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from pulsegrain import fixed_values as fv
from pulsegrain.operators.lookups import Lookups
from pulsegrain.plans.app_health import build_app_health
from pulsegrain.plans.crash_raw import build_crash_events, build_crash_events_raw
from pulsegrain.plans.events_raw import build_events_raw
from pulsegrain.plans.installs import (
    build_events_wid, build_events_wid_forced_nulls, build_installs_raw)
from pulsegrain.plans.usage import (
    build_errors, build_events, build_events_count, build_events_forced_nulls, build_installs,
    ui_rows)
from pulsegrain.session import tune
from pulsegrain.sources.comments import CRASH_EVENTS_RAW, EVENTS_RAW, with_comments
from pulsegrain.sources.exports import scan_analytics, scan_crashes
from pulsegrain.sources.tables import read_days, write_days
from pulsegrain.windows import DateWindow, Run

WRITES_AT_ONCE = 4  # as many models as the reference builds at once


@dataclass(frozen=True)
class Warehouse:
    """A folder with one subfolder per table. A table keeps its schema, so it may have no rows."""

    spark: SparkSession
    root: str
    run: Run
    table_format: str = "parquet"
    may_erase: bool = False

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, table: str, window: DateWindow | None = None) -> DataFrame:
        days = window or self.run.analytics()
        return read_days(self.spark, self.path(table), days.start, days.end, self.table_format)

    def write(self, table: str, df: DataFrame, cluster_by=(), in_place: bool = False) -> None:
        write_days(df, self.path(table), cluster_by, not self.run.incremental,
                   self.table_format, self.may_erase, in_place)

    def write_all(self, *writes: Callable[[], None]) -> None:
        """Writes that do not need each other, some at a time: the last tasks of one leave cores to the next.

        All of them end before the first error is raised.
        """
        with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
            started = [pool.submit(inheritable_thread_target(self.spark)(write)) for write in writes]
        for write in started:
            write.result()


def build_all(spark: SparkSession, root: str, run: Run, lookups: Lookups,
              analytics: Callable[[SparkSession, Run], DataFrame] = scan_analytics,
              crashes: Callable[[SparkSession, Run], DataFrame] = scan_crashes,
              may_erase: bool = False) -> Warehouse:
    """Recompute the run's days of every table, with the session tuned for it.

    A table may turn out empty; a full refresh replaces rows by none only if
    ``may_erase``.
    Running it again changes nothing. No table is read and written at once:
    each step reads what earlier steps wrote.
    """
    run.settings.require_mandatory()
    # A repeated code would multiply events.
    lookups = Lookups.checked(lookups.country, lookups.language)
    w = Warehouse(tune(spark), root, run, may_erase=may_erase)
    by_event, by_app = fv.EVENT_CLUSTER_KEYS, fv.INSTALL_CLUSTER_KEYS

    events_raw = build_events_raw(analytics(spark, run), lookups, run, in_file_order=True)
    crash_events_raw = build_crash_events_raw(crashes(spark, run), run)
    w.write_all(
        lambda: w.write("events_raw", with_comments(events_raw, EVENTS_RAW), by_event, in_place=True),
        lambda: w.write("crash_events_raw", with_comments(crash_events_raw, CRASH_EVENTS_RAW)))

    stored = w.read("events_raw")
    lookback = run.analytics(extend=fv.INSTALL_LOOKBACK_DAYS)
    w.write_all(
        lambda: w.write("events", build_events(stored, run), by_event),
        lambda: w.write("installs_raw", build_installs_raw(w.read("events_raw", lookback), run), by_app),
        lambda: w.write("events_forced_nulls", build_events_forced_nulls(stored, run), by_event),
        lambda: w.write("crash_events", build_crash_events(w.read("crash_events_raw", run.crash()), run)),
        lambda: w.write("events_count", build_events_count(stored, run)))

    every_install = w.read("installs_raw", DateWindow(
        dt.date.fromisoformat(fv.FIRST_COHORT_DATE), run.analytics().end))
    events, forced = w.read("events"), w.read("events_forced_nulls")
    w.write_all(
        lambda: w.write("events_wid", build_events_wid(stored, every_install, run), by_event),
        lambda: w.write("events_wid_forced_nulls",
                        build_events_wid_forced_nulls(stored, every_install, run), by_event),
        lambda: w.write("installs", build_installs(w.read("installs_raw"), run), by_event),
        lambda: w.write("errors", build_errors(events, run)),
        lambda: w.write("ui", ui_rows(events, forced, run), by_event))

    w.write_all(
        lambda: w.write("ui_wid", ui_rows(w.read("events_wid"), w.read("events_wid_forced_nulls"), run),
                        by_event),
        lambda: w.write("app_health", build_app_health(events, forced, w.read("installs"),
                                                       w.read("crash_events", run.crash()), run)))
    return w
