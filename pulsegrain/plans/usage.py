"""Daily rollups of the event table, and the tables cut from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain import fixed_values as fv
from pulsegrain.functions.sqltext import literal
from pulsegrain.functions.text import in_name_list
from pulsegrain.functions.times import age_group, utc_date
from pulsegrain.operators.determinants import dimensions
from pulsegrain.operators.rollup import rollup
from pulsegrain.windows import Run


def _events_rollup(rows: DataFrame, run: Run, sentinel: frozenset[str]) -> DataFrame:
    settings = run.settings
    keys = {"event_date": "event_date", "install_age_group": age_group("install_age")}
    dims = dimensions(rows.schema, fv.EVENT_DIMENSIONS, settings.fields_left_out_of_rollups, sentinel)
    return rollup(rows, keys, dims, "user_pseudo_id", settings.metrics)


def build_events(events_raw: DataFrame, run: Run) -> DataFrame:
    """The ``events`` rollup: day, age group and all dimensions."""
    rows = events_raw.where(run.analytics().has_date("event_date"))
    return _events_rollup(rows, run, frozenset())


def build_events_forced_nulls(events_raw: DataFrame, run: Run) -> DataFrame:
    """The same over the configured events, with some dimensions collapsed.

    Distinct users are counted anew at this level: they cannot be summed up
    from the finer rollup.
    """
    rows = (events_raw.where(run.analytics().has_date("event_date"))
            .where(in_name_list("event_name", run.settings.sentinel_events)))
    return _events_rollup(rows, run, run.settings.sentinel_fields)


def build_installs(installs_raw: DataFrame, run: Run) -> DataFrame:
    """The ``installs`` rollup: day, install day, age and all dimensions."""
    rows = installs_raw.where(run.analytics().has_date("event_date"))
    keys = {"event_date": "event_date", "install_date": utc_date("install_ts"),
            "install_age": "install_age"}
    dims = dimensions(rows.schema, fv.EVENT_DIMENSIONS, run.settings.fields_left_out_of_rollups)
    return rollup(rows, keys, dims, "user_pseudo_id")


def build_events_count(events_raw: DataFrame, run: Run) -> DataFrame:
    """Engagement events per day, platform and account."""
    rows = (events_raw.where(run.analytics().has_date("event_date"))
            .where(f"event_name = {literal(fv.ENGAGEMENT_EVENT)}"))
    return (rows.groupBy("event_date", "platform", "user_id")
            .agg(F.count(F.lit(1)).alias("user_engagement")))


def ui_rows(plain: DataFrame, forced: DataFrame, run: Run) -> DataFrame:
    """UI events of a rollup and of its collapsed twin, one above the other."""
    in_window = run.analytics().has_date("event_date")
    wanted = in_name_list("event_name", fv.UI_EVENTS)
    return (plain.where(in_window).where(wanted)
            .unionByName(forced.where(in_window).where(wanted)))


def build_errors(events: DataFrame, run: Run) -> DataFrame:
    """Error events of the ``events`` rollup."""
    patterns = [f"LIKE {literal(pattern)}" for pattern in fv.ERROR_PATTERNS]
    return (events.where(run.analytics().has_date("event_date"))
            .where(in_name_list("event_name", patterns)))
