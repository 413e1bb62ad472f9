"""Data checks: each returns the violating rows, so an empty result is a pass."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain import fixed_values as fv
from pulsegrain.functions.sqltext import aliased, expressions, literal, name
from pulsegrain.functions.times import offset_name, utc_date
from pulsegrain.operators.dedup import COUNT_COLUMN
from pulsegrain.operators.dims import flat_columns
from pulsegrain.windows import DateWindow, Run


def raw_counts(events_raw: DataFrame, export: DataFrame, run: Run) -> DataFrame:
    """Per settled day: events counted with their copies, and rows in the source.

    The last days are left out because exports still change them.
    """
    check = run.checking()
    window = check.analytics(extend=2)
    settled = f"event_date <= DATE '{run.run_date - dt.timedelta(days=fv.SETTLING_DAYS)}'"
    kept = (events_raw.where(window.has_date("event_date")).where(settled)
            .groupBy("event_date").agg(F.sum(COUNT_COLUMN).alias("kept_cnt")))
    source = export.where(window.has_day_of_micros("event_timestamp"))
    if "table_suffix" in export.columns:
        source = source.where(check.shards(extend=3).has_shard("table_suffix"))
    source = (source.selectExpr(
        aliased(utc_date("timestamp_micros(event_timestamp)"), "event_date"))
        .where(settled).groupBy("event_date").agg(F.count(F.lit(1)).alias("source_cnt")))
    return kept.join(source, "event_date", "left")


def raw_reconciliation(events_raw: DataFrame, export: DataFrame, run: Run) -> DataFrame:
    """Days on which the event table lost or invented rows.

    A day missing from the source has no count to compare and passes.
    """
    return raw_counts(events_raw, export, run).where("kept_cnt != source_cnt")


UNIQUE_SINCE = dt.date.fromisoformat(fv.FIRST_UNIQUE_INSTALL_DATE)


def install_counts(installs_raw: DataFrame, run: Run,
                   first_day: dt.date = UNIQUE_SINCE) -> DataFrame:
    """Users and rows in the checked days from ``first_day`` on."""
    rows = (installs_raw.where(run.checking().analytics(extend=2).has_date("event_date"))
            .where(f"event_date >= DATE '{first_day}'").where("user_pseudo_id IS NOT NULL"))
    return rows.agg(F.countDistinct("user_pseudo_id").alias("dist_cnt"),
                    F.count(F.lit(1)).alias("cnt"))


def install_uniqueness(installs_raw: DataFrame, run: Run,
                       first_day: dt.date = UNIQUE_SINCE) -> DataFrame:
    """One row if some user has more than one install."""
    return install_counts(installs_raw, run, first_day).where("dist_cnt < cnt")


SKETCH_LOG_K = 12
SKETCH_ERROR = 0.05  # three times the standard error of such a sketch

PROFILED = ("event_dates", "install_dates",
            *[d for d in fv.EVENT_DIMENSIONS if d != "reverse_app_id"])


def _profiled(events_raw: DataFrame, run: Run) -> dict[str, str]:
    inner = [f"{s}.{offset_name(n)}" for s in ("event_dates", "install_dates")
             for n in fv.ZONE_OFFSETS[1:-1]]
    return flat_columns(events_raw.schema, PROFILED, {*run.settings.fields_left_out_of_rollups, *inner})


def profile_sketches(events_raw: DataFrame, run: Run) -> DataFrame:
    """event_date and a sketch of the distinct values of each rollup dimension, by day.

    One pass over the dimensions; what is shuffled is a few kilobytes for each dimension, day and task.
    Sketches of days can be kept as a table and merged for any range of days.
    """
    return events_raw.groupBy("event_date").agg(*[
        F.expr(f"hll_sketch_agg(string({value}), {SKETCH_LOG_K})").alias(column)
        for column, value in _profiled(events_raw, run).items()])


def dimensions_over(events_raw: DataFrame, run: Run, days: DateWindow, limit: int,
                    sketches: DataFrame | None = None) -> DataFrame:
    """dim_name, over: whether a dimension has more than ``limit`` distinct values in these days.

    Merged sketches decide; only dimensions whose estimate is within ``SKETCH_ERROR`` of the limit are
    counted, by one pass over just their columns. One row of estimates reaches the driver.
    """
    columns = _profiled(events_raw, run)
    in_days = days.has_date("event_date")
    sketches = profile_sketches(events_raw.where(in_days), run) if sketches is None else sketches.where(in_days)
    estimates = sketches.agg(*[F.expr(f"coalesce(hll_sketch_estimate(hll_union_agg({name(c)})), 0)").alias(c)
                               for c in columns]).first()
    near = [c for c in columns if limit * (1 - SKETCH_ERROR) <= estimates[c] <= limit * (1 + SKETCH_ERROR) + 1]
    found = {c: estimates[c] > limit for c in columns if c not in near}
    if near:
        # Counted one by one over pairs, not as many distinct counts of a row.
        pairs = ", ".join(f"struct({literal(c)} AS dim_name, string({columns[c]}) AS value)" for c in near)
        values = events_raw.where(in_days).selectExpr(f"inline(array({pairs}))")
        counts = values.where("value IS NOT NULL").distinct().groupBy("dim_name").count()
        exact = {r.dim_name: r["count"] for r in counts.collect()}
        found |= {c: exact.get(c, 0) > limit for c in near}
    return events_raw.sparkSession.createDataFrame([(c, found[c]) for c in columns], "dim_name string, over boolean")


def dimension_cardinality(events_raw: DataFrame, run: Run, day: dt.date) -> DataFrame:
    """Distinct values of every rollup dimension on one day, most first.

    Values become (name, value) pairs and are made distinct, instead of one
    distinct count per column: that would repeat whole rows per dimension. Of
    the date-per-offset structs only the outermost offsets are profiled.
    """
    columns = _profiled(events_raw, run)
    pairs = ", ".join(f"struct({literal(c)} AS dim_name, string({name(c)}) AS value)"
                      for c in columns)
    values = (events_raw.where(f"event_date = DATE '{day}'").selectExpr(*expressions(columns))
              .selectExpr(f"inline(array({pairs}))"))
    # One NULL per dimension, so that a day without values still has all lines.
    names = events_raw.sparkSession.createDataFrame(
        [(c, None) for c in columns], "dim_name string, value string")
    return (values.unionByName(names).distinct()
            .groupBy("dim_name").agg(F.count("value").alias("dist_cnt"))
            .orderBy(F.desc("dist_cnt"), "dim_name"))
