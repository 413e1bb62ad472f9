"""Who installed when: one row per user, and events joined to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrain import fixed_values as fv
from pulsegrain.functions.sqltext import aliased, expressions, literal, name, struct
from pulsegrain.functions.text import in_name_list, reverse_dotted
from pulsegrain.functions.times import (
    age_in_days, hour_number, utc_date, within_a_day_after, zone_dates)
from pulsegrain.operators.dedup import COUNT_COLUMN
from pulsegrain.operators.determinants import dimensions
from pulsegrain.operators.rollup import aggregate, metric_input
from pulsegrain.windows import Run

# Functions of carried columns: cheaper to compute again than to shuffle.
DERIVED = {
    "event_date": utc_date("event_ts"),
    "install_age": age_in_days("event_ts", "install_ts"),
    "reverse_app_id": reverse_dotted("app_id"),
    "event_dates": zone_dates("__event_hour"),
    "install_dates": zone_dates("__install_hour"),
}


def _candidates(events_raw: DataFrame, run: Run, carried: list[str]) -> DataFrame:
    """Per user the earliest row of each kind, as structs that start with ``event_ts``."""
    wide = run.analytics(extend=fv.INSTALL_LOOKBACK_DAYS)
    near_install = within_a_day_after("event_ts", "install_ts")
    row = struct({c: name(c) for c in ("event_ts", *carried)})
    known = struct({c: c for c in ("event_ts", "user_id")})
    # Rows that only tell the user id travel without the other columns.
    rows = (events_raw.where(wide.has_date("event_date"))
            .where(f"{near_install} OR user_id IS NOT NULL")
            .selectExpr("user_pseudo_id", "event_name",
                        f"if({near_install}, {row}, NULL) AS row",
                        f"if(user_id IS NOT NULL, {known}, NULL) AS known"))

    def earliest(event_name: str | None) -> Column:
        if event_name is None:
            return F.expr("min(row)")
        return F.expr(f"min(if(event_name = {literal(event_name)}, row, NULL))")

    kinds = {"sdk": fv.SDK_INSTALL_EVENT, "first": fv.DEFAULT_INSTALL_EVENT, "any": None}
    if run.settings.custom_install_event:
        kinds = {"custom": run.settings.custom_install_event, **kinds}
    return (rows.groupBy("user_pseudo_id")
            .agg(*[earliest(event).alias(kind) for kind, event in kinds.items()],
                 F.min("known").alias("known"))
            .where("any IS NOT NULL"))


def build_installs_raw(events_raw: DataFrame, run: Run) -> DataFrame:
    """The ``installs_raw`` table, from one pass over the events.

    The configured install event comes first, then the SDK's, then
    ``first_open``, then any event within a day of the install. Scalars fall
    back one by one, structs and arrays come whole from the best row.
    """
    carried = [c for c in events_raw.columns
               if c not in {*DERIVED, COUNT_COLUMN, "event_ts", "user_pseudo_id", "user_id"}]
    users = _candidates(events_raw, run, carried)
    kinds = [c for c in users.columns if c not in ("user_pseudo_id", "known")]
    window = run.analytics()

    # Rows without a user are no one's: they never combine, and the earliest
    # one inside the window stands for all of them.
    def inside(kind: str) -> str:
        day = utc_date(f"{kind}.event_ts")
        return f"if({window.has_date(day)}, {kind}, NULL)"

    alone = (f"coalesce({inside('any')}, "
             f"array_min(array({', '.join(inside(k) for k in kinds)})))")
    identified = "user_pseudo_id IS NOT NULL"
    users = users.selectExpr(
        "user_pseudo_id",
        f"if({identified}, known.user_id, NULL) AS user_id",
        f"if({identified}, any, {alone}) AS any",
        *[f"if({identified}, {k}, NULL) AS {k}" for k in kinds if k != "any"])
    users = users.selectExpr("*", f"coalesce({', '.join(kinds)}) AS best")

    def value(column: str) -> str:
        if isinstance(events_raw.schema[column].dataType, (T.StructType, T.ArrayType)):
            return aliased(name("best", column), column)
        return aliased(f"coalesce({', '.join(name(k, column) for k in kinds)})", column)

    picked = (users.where(window.has_date(utc_date("best.event_ts")))
              .selectExpr("user_pseudo_id", "user_id", value("event_ts"),
                          *[value(c) for c in carried]))
    picked = picked.selectExpr("*", aliased(hour_number("event_ts"), "__event_hour"),
                               aliased(hour_number("install_ts"), "__install_hour"))
    return picked.selectExpr(*[aliased(DERIVED.get(c, name(c)), c)
                               for c in events_raw.columns if c != COUNT_COLUMN])


def build_cohorts(events_raw: DataFrame, installs_raw: DataFrame, run: Run,
                  forced_nulls: bool = False) -> DataFrame:
    """Events by the dimensions of the event and of the user's install.

    ``forced_nulls`` collapses the configured dimensions on both sides and
    keeps the configured events only. Events of users without an install
    drop out. A user with very many events is split by adaptive execution,
    which ``tune`` lets add a shuffle for it; the grouping counts users
    wherever their rows lie.
    """
    settings = run.settings
    left_out = settings.fields_left_out_of_rollups
    sentinel = settings.sentinel_fields if forced_nulls else frozenset()
    events = events_raw.where(run.analytics().has_date("event_date"))
    if forced_nulls:
        events = events.where(in_name_list("event_name", settings.sentinel_events))
    installed = installs_raw.where(f"event_date >= DATE '{fv.FIRST_COHORT_DATE}'")

    # Group columns are built before the join: less to shuffle, and the two
    # sides share no name but the user's.
    event_dims = dimensions(events.schema, fv.EVENT_DIMENSIONS, left_out, sentinel)
    install_dims = dimensions(installed.schema, fv.EVENT_DIMENSIONS, left_out, sentinel,
                              prefix="install_")
    left = events.selectExpr("user_pseudo_id", "event_ts", "event_date", "install_age",
                             *expressions(event_dims.keys), *metric_input(settings.metrics))
    right = installed.selectExpr("user_pseudo_id",
                                 aliased(utc_date("install_ts"), "install_date"),
                                 *expressions(install_dims.keys))
    joined = left.join(right, "user_pseudo_id")
    # An age group would follow from the age and add no rows, so it is no key.
    keys = ["event_date", *event_dims.keys, "install_age", "install_date", *install_dims.keys]
    grouped = aggregate(joined, keys, "user_pseudo_id", settings.metrics)
    return (event_dims + install_dims).finished(grouped, [
        "event_date", *event_dims.outputs, "install_age", "install_date", *install_dims.outputs,
        *grouped.columns[len(keys):]])


def build_events_wid(events_raw, installs_raw, run) -> DataFrame:
    """The cohort table."""
    return build_cohorts(events_raw, installs_raw, run, False)


def build_events_wid_forced_nulls(events_raw, installs_raw, run) -> DataFrame:
    """The cohort table with collapsed dimensions."""
    return build_cohorts(events_raw, installs_raw, run, True)
