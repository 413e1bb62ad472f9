"""Usage, installs and crashes side by side."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain import fixed_values as fv
from pulsegrain.config import MeasureSpec
from pulsegrain.functions.sqltext import aliased, expressions, name, struct
from pulsegrain.functions.text import in_name_list
from pulsegrain.functions.versions import version_from_normalized
from pulsegrain.windows import Run

KEYS = tuple(fv.HEALTH_DIMENSIONS)
# The four inputs. The first one's keys decide what the others can match.
SOURCES = ("analytics", "analytics_forced_nulls", "installs", "crashlytics")


def measures_of(measures: tuple[MeasureSpec, ...], model: str) -> dict[str, str]:
    return {column: sql for m in measures if m.model == model
            for column, sql in m.columns().items()}


def _event_names(measures: tuple[MeasureSpec, ...], model: str) -> list[str]:
    return list(dict.fromkeys(m.event_name for m in measures
                              if m.model == model and m.event_name is not None))


def by_health_keys(rows: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """Group a rollup to the health grain; aggregates may use any of its columns."""
    if not aggregates:
        return rows.selectExpr(*expressions(fv.HEALTH_DIMENSIONS)).distinct()
    keys = [F.expr(path).alias(key) for key, path in fv.HEALTH_DIMENSIONS.items()]
    return rows.groupBy(*keys).agg(*[F.expr(sql).alias(measure)
                                     for measure, sql in aggregates.items()])


def health_inputs(events: DataFrame, events_forced_nulls: DataFrame, installs: DataFrame,
                  crash_events: DataFrame, run: Run) -> dict[str, DataFrame]:
    """Each input aggregated to the health grain, before anything is combined."""
    measures = run.settings.measures
    for m in measures:
        if m.ignores_filter:
            warnings.warn(f"measure {m.name!r}: additional_filter has no effect together "
                          "with a LIKE event name", stacklevel=3)
    usage_days = run.analytics().has_date("event_date")
    forced_names = _event_names(measures, "analytics_forced_nulls")
    rows = {
        "analytics": events.where(usage_days).where(
            in_name_list("event_name", _event_names(measures, "analytics"))),
        "analytics_forced_nulls": events_forced_nulls.where(usage_days).where(
            in_name_list("event_name", forced_names) if forced_names else "false"),
        "installs": installs.where(usage_days),
        "crashlytics": crash_events.where(run.crash().has_date("event_date")),
    }
    return {source: by_health_keys(df, {"installs": "SUM(users)"} if source == "installs"
                                   else measures_of(measures, source))
            for source, df in rows.items()}


def combine(inputs: dict[str, DataFrame], merge_keys: bool = False) -> DataFrame:
    """All inputs on their nine keys, in one grouping instead of three outer joins.

    An input's row joins the analytics row of the same keys. Keys that analytics
    does not have, and keys with a NULL part, match nothing: there each input
    keeps a row of its own, so one key can appear up to once per input.
    ``merge_keys`` merges those rows too.

    The inputs are already spread by these keys, and keys without a match are
    spread like all others instead of meeting in one NULL group.
    """
    columns = {source: [c for c in df.columns if c not in KEYS] for source, df in inputs.items()}
    measures = [c for names in columns.values() for c in names]
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.selectExpr("*", f"'{source}' AS __source") for source, df in inputs.items()])
    # A measure is filled by its own input alone, which has each key once.
    merged = stacked.groupBy(*KEYS).agg(
        *[F.expr(f"bool_or(__source = '{source}')").alias(f"__has_{source}")
          for source in inputs],
        *[F.expr(f"first({name(c)}, true)").alias(c) for c in measures])
    if merge_keys:
        return merged.select(*KEYS, *measures)

    complete = " AND ".join(f"{key} IS NOT NULL" for key in KEYS)
    alone = ", ".join(f"if(__has_{source}, '{source}', NULL)" for source in inputs)
    rows = merged.selectExpr("*", f"""explode(if(__has_{SOURCES[0]} AND {complete},
        array('all'), array_compact(array({alone})))) AS __row""")
    return rows.selectExpr(*KEYS, *[
        aliased(f"if(__row IN ('all', '{source}'), {name(c)}, NULL)", c)
        for source, names in columns.items() for c in names])


def key_matches(inputs: dict[str, DataFrame]) -> DataFrame:
    """source, event_date, n_keys, n_incomplete, n_unmatched: keys that :func:`combine` leaves alone.

    Incomplete keys have a NULL part and match nothing; unmatched ones are complete, but usage does not have them.
    Rows of an input that disagree with usage in one key show here before they show as extra rows of the
    table. Only the keys are read, and grouped once.
    """
    stacked = reduce(DataFrame.unionAll, [df.selectExpr(*KEYS, f"'{source}' AS source")
                                          for source, df in inputs.items()])
    complete = " AND ".join(f"{key} IS NOT NULL" for key in KEYS)
    met = stacked.groupBy(*KEYS).agg(F.collect_set("source").alias("sources"))
    each = met.selectExpr("event_date", f"({complete}) AS complete", "explode(sources) AS source",
                          f"array_contains(sources, '{SOURCES[0]}') AS used")
    return each.groupBy("source", "event_date").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if(F.expr("NOT complete")).alias("n_incomplete"),
        F.count_if(F.expr("complete AND NOT used")).alias("n_unmatched"))


def build_app_health(events: DataFrame, events_forced_nulls: DataFrame, installs: DataFrame,
                     crash_events: DataFrame, run: Run, merge_keys: bool = False) -> DataFrame:
    """The ``app_health`` table.

    Measures named ``*_users`` add up distinct counts of finer groups, so they
    count a person once per group.
    """
    inputs = health_inputs(events, events_forced_nulls, installs, crash_events, run)
    return combine(inputs, merge_keys).selectExpr(
        "event_date", "platform", "app_id", "reverse_app_id",
        aliased(version_from_normalized("app_version_join_value"), "app_version"),
        aliased(version_from_normalized("platform_version_join_value"), "platform_version"),
        aliased(struct({"type": "device_hardware_type",
                        "manufacturer": "device_hardware_manufacturer",
                        "os_model": "device_hardware_os_model"}), "device_hardware"),
        "installs",
        *[name(c) for m in run.settings.measures for c in m.columns()])
