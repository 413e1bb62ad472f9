"""One query per operator and one per table, over the whole ``events`` table."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
from collections.abc import Callable

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness import exports
from harness.settings import FIRST_WEEK, SETTINGS, TRAILING, WHOLE
from pulsegrain import Run
from pulsegrain import fixed_values as fv
from pulsegrain.config import ANALYTICS_TYPES, CRASH_TYPES
from pulsegrain.functions import text, times, versions
from pulsegrain.functions.params import key_value, with_parameter_struct
from pulsegrain.functions.sqltext import expressions, name, struct
from pulsegrain.operators.dedup import keep_one_copy
from pulsegrain.operators.dims import (
    aligned_struct, dimension_columns, flat_columns, pack)
from pulsegrain.operators.lookups import with_country, with_language
from pulsegrain.plans import app_health, checks, crash_raw, usage
from pulsegrain.plans import events_raw as raw_plan
from pulsegrain.plans import installs as install_plan
from pulsegrain.plans.build import build_all
from pulsegrain.sources.comments import EVENTS_RAW, with_comments
from pulsegrain.sources.exports import ANALYTICS_EXPORT, scan_analytics, scan_crashes
from pulsegrain.sources.scratch import scratch_path
from pulsegrain.sources.seeds import COUNTRY, LANGUAGE, read_lookups
from pulsegrain.sources.tables import read_days, write_days

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROFILE_DAY = dt.date(2024, 1, 10)
OVER = (2, 5, 12, 39, 40)
NAMES = ("first_open", "user_engagement", "LIKE 'error_%'", "like 'ui_view%'")


def _as_json(value: str, kind: T.DataType) -> str:
    """A value with instants as microseconds, as they are compared."""
    if isinstance(kind, T.ArrayType):
        return f"transform({value}, x -> {_as_json('x', kind.elementType)})"
    if isinstance(kind, T.StructType):
        return struct({f.name: _as_json(f"{value}.{name(f.name)}", f.dataType) for f in kind.fields})
    return f"unix_micros({value})" if isinstance(kind, T.TimestampType) else value


def plain(df: DataFrame) -> DataFrame:
    """Flat scalar columns: days as text, instants as microseconds, lists as JSON text."""
    types = {}
    for field in df.schema.fields:
        inner = field.dataType
        if isinstance(inner, T.StructType):
            types.update({f"{field.name}_{f.name}": f.dataType for f in inner.fields})
        else:
            types[field.name] = inner
    columns = {}
    for column, value in flat_columns(df.schema).items():
        if isinstance(types[column], T.DateType):
            value = f"string({value})"
        elif isinstance(types[column], T.TimestampType):
            value = f"unix_micros({value})"
        elif isinstance(types[column], T.ArrayType):
            value = f"to_json({_as_json(value, types[column])}, map('ignoreNullFields', 'false'))"
        columns[column] = value
    return df.selectExpr(*expressions(columns))


def registered(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(spark, sf_dir))

    QUERIES[query.__name__] = run
    return query


# Tables that several queries start from.

def events_raw_of(spark, sf_dir, run: Run = WHOLE, in_file_order: bool = False) -> DataFrame:
    return raw_plan.build_events_raw(exports.analytics_export(spark, sf_dir),
                                     exports.lookups(spark), run, in_file_order)


def installs_raw_of(spark, sf_dir, run: Run = WHOLE) -> DataFrame:
    return install_plan.build_installs_raw(events_raw_of(spark, sf_dir, WHOLE), run)


def crash_raw_of(spark, sf_dir) -> DataFrame:
    return crash_raw.build_crash_events_raw(exports.crash_export(spark, sf_dir), WHOLE)


def stored_events(spark, sf_dir) -> DataFrame:
    """``events_raw`` as a written table with all its columns, as later steps of a build find it."""
    path = scratch_path(spark, "events_raw")
    write_days(events_raw_of(spark, sf_dir, in_file_order=True), path, fv.EVENT_CLUSTER_KEYS, in_place=True)
    return read_days(spark, path, WHOLE.analytics().start, WHOLE.analytics().end)


def identified(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("event_id", "copy_no", *expressions(columns))


def timed(spark, sf_dir) -> DataFrame:
    return exports.analytics_export(spark, sf_dir).selectExpr(
        "event_bundle_sequence_id", "table_suffix",
        "timestamp_micros(event_timestamp) AS event_ts",
        "timestamp_micros(user_first_touch_timestamp) AS install_ts")


# Expressions.

@registered
def version_parts(spark, sf_dir):
    rows = exports.analytics_flat(spark, sf_dir).selectExpr(
        "*", f"{versions.clean_version('app_version')} AS app_clean",
        f"{versions.version_without_os('os_version', 'os_name')} AS bare")
    rows = rows.selectExpr("*", f"{versions.clean_version('bare')} AS os_clean")
    return identified(rows, {
        "app": versions.version_struct("app_version", "app_version", "app_clean"),
        "os": versions.version_struct("os_version", "bare", "os_clean")})


@registered
def version_record(spark, sf_dir):
    rows = exports.analytics_flat(spark, sf_dir)
    joined = versions.join_value(versions.clean_version("app_version"), "app_version")
    rows = rows.selectExpr("*", f"{joined} AS join_value")
    return identified(rows, {"join_value": "join_value",
                             "version": versions.version_from_normalized("join_value")})


@registered
def install_age(spark, sf_dir):
    age = times.age_in_days("event_ts", "install_ts")
    return timed(spark, sf_dir).selectExpr("*", f"{age} AS install_age")


@registered
def age_groups(spark, sf_dir):
    ages = QUERIES["install_age"](spark, sf_dir)
    return (ages.groupBy(F.expr(times.age_group("install_age")).alias("install_age_group"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.min("install_age").alias("youngest"),
                 F.max("install_age").alias("oldest")))


@registered
def wall_clock_age(spark, sf_dir):
    age = times.wall_clock_age("event_ts", "install_ts")
    rows = timed(spark, sf_dir).selectExpr("*", f"{age} AS age")
    return rows.selectExpr("*", f"{times.zone_ages('age')} AS ages").drop("event_ts",
                                                                         "install_ts")


@registered
def tz_dates(spark, sf_dir):
    rows = timed(spark, sf_dir).selectExpr("*", f"{times.hour_number('event_ts')} AS hour")
    return rows.selectExpr("event_bundle_sequence_id", "table_suffix",
                           f"{times.zone_dates('hour')} AS on")


@registered
def tz_offset(spark, sf_dir):
    return identified(exports.analytics_flat(spark, sf_dir), {
        "tz_offset_s": "tz_offset_s",
        "device_time_zone_offset": times.offset_text("tz_offset_s")})


@registered
def reverse_id(spark, sf_dir):
    return identified(exports.analytics_flat(spark, sf_dir), {
        "app_id": "app_id", "reverse_app_id": text.reverse_dotted("app_id")})


@registered
def null_if_empty(spark, sf_dir):
    return identified(exports.analytics_flat(spark, sf_dir), {
        "advertising_id": f"lower({text.null_if_empty('advertising_id')})"})


@registered
def platform_from_suffix(spark, sf_dir):
    return identified(exports.crash_flat(spark, sf_dir), {
        "table_suffix": "table_suffix", "platform": text.platform_of_shard("table_suffix")})


@registered
def name_list_filter(spark, sf_dir):
    rows = exports.analytics_flat(spark, sf_dir)
    listed = F.expr(text.in_name_list("event_name", NAMES))
    anything = F.expr(text.in_name_list("event_name", []))
    return (rows.groupBy("event_name")
            .agg(F.count_if(listed).alias("listed"), F.count_if(anything).alias("all_rows")))


# Key/value arrays and structs.

@registered
def kv_extract(spark, sf_dir):
    rows = exports.analytics_export(spark, sf_dir).select(
        "event_bundle_sequence_id", "table_suffix", "event_name", "event_params",
        F.col("user_properties").alias("properties"))
    rows = with_parameter_struct(rows, "event_parameters", "event_params",
                                 SETTINGS.extracted_event_parameters, ANALYTICS_TYPES)
    rows = with_parameter_struct(rows, "user_properties", "properties",
                                 SETTINGS.user_properties, ANALYTICS_TYPES)
    return rows.drop("event_params", "properties")


@registered
def kv_extract_crash(spark, sf_dir):
    analytics_user = key_value("custom_keys", fv.CRASH_ANALYTICS_USER_KEY)
    app_user = key_value("custom_keys", fv.CRASH_APP_USER_KEY)
    rows = exports.crash_export(spark, sf_dir).selectExpr(
        "event_id", "received_timestamp", "user.id", f"{analytics_user} AS pseudo_id",
        f"coalesce(user.id, {app_user}) AS user_id", "custom_keys AS keys")
    with_keys = with_parameter_struct(rows, "custom_keys", "keys", SETTINGS.crash_keys,
                                      CRASH_TYPES)
    return with_parameter_struct(with_keys, "no_keys", "keys", (), CRASH_TYPES).drop("keys")


@registered
def struct_pack_unpack(spark, sf_dir):
    raw = events_raw_of(spark, sf_dir)
    wanted = ["app_id", "app_version", "geo", "device_hardware"]
    ignored = SETTINGS.fields_left_out_of_rollups
    flat = raw.selectExpr("event_ts", *expressions(flat_columns(
        raw.schema, wanted, ignored, {"device_hardware.type"}, prefix="x_")))
    packed = flat.selectExpr("event_ts", *expressions(
        pack(raw.schema, wanted, ignored, "x_")))
    return packed.selectExpr("event_ts", *expressions(
        dimension_columns(packed.schema, wanted)))


@registered
def schema_align(spark, sf_dir):
    rows = exports.crash_export(spark, sf_dir)
    unity = aligned_struct(rows.schema, "unity_metadata", fv.UNITY_METADATA)
    return rows.selectExpr("event_id", "received_timestamp", f"{unity} AS unity")


# Lookups.

@registered
def geo_lookup(spark, sf_dir):
    rows = exports.analytics_flat(spark, sf_dir)
    return with_country(rows, exports.lookups(spark), "country").select(
        "event_id", "copy_no", "country", "iso_country_name", "iso_country_alpha_2")


@registered
def language_lookup(spark, sf_dir):
    rows = exports.analytics_flat(spark, sf_dir)
    return with_language(rows, exports.lookups(spark), "language").select(
        "event_id", "copy_no", "language", "iso_language_alpha_2",
        "iso_language_country_alpha_2")


# Copies.

@registered
def dedup_events(spark, sf_dir):
    return keep_one_copy(exports.analytics_export(spark, sf_dir), fv.EVENT_COPY_KEYS, ["table_suffix"])


@registered
def dedup_crashes(spark, sf_dir):
    return keep_one_copy(exports.crash_export(spark, sf_dir), fv.CRASH_COPY_KEYS, ["received_timestamp"])


# Windows, shards, writes.

@registered
def window_filter(spark, sf_dir):
    window = TRAILING.analytics()
    rows = exports.analytics_export(spark, sf_dir)
    rows = rows.where(window.has_day_of_micros("event_timestamp"))
    ts = "timestamp_micros(event_timestamp)"
    return rows.selectExpr("event_bundle_sequence_id", "table_suffix",
                           f"{times.utc_date(ts)} AS event_date",
                           f"{window.has_instant(ts)} AS in_instants")


@registered
def shard_filter(spark, sf_dir):
    rows = exports.analytics_export(spark, sf_dir)
    return (rows.where(TRAILING.shards().has_shard("table_suffix"))
            .groupBy("table_suffix").agg(F.count(F.lit(1)).alias("cnt")))


@registered
def shard_scan(spark, sf_dir):
    """Write the feed as one folder per shard, then read only the run's shards."""
    root = scratch_path(spark, "shards")
    (exports.analytics_export(spark, sf_dir)
     .withColumn("shard", F.concat(F.lit("events_"), "table_suffix")).drop("table_suffix")
     .hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(root))
    settings = Run(type(SETTINGS)(analytics_source=root, analytics_shards="shard=events_*"),
                   TRAILING.run_date)
    rows = scan_analytics(spark, settings, schema=ANALYTICS_EXPORT)
    return rows.groupBy("table_suffix").agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("user_pseudo_id").alias("users"),
        F.min("event_timestamp").alias("first_event"))


@registered
def crash_shard_scan(spark, sf_dir):
    """Write the crash feed as one folder per shard, then read all of them."""
    root = scratch_path(spark, "crash_shards")
    (exports.crash_export(spark, sf_dir)
     .withColumnRenamed("table_suffix", "shard").write.partitionBy("shard").parquet(root))
    run = Run(type(SETTINGS)(crash_source=root, crash_shards="shard=*"), TRAILING.run_date)
    return scan_crashes(spark, run)


@registered
def crash_trailing_window(spark, sf_dir):
    """Crashes of the last days only, by the instants of the window."""
    raw = crash_raw.build_crash_events_raw(exports.crash_export(spark, sf_dir), TRAILING)
    return raw.groupBy("event_date", "platform").agg(F.count(F.lit(1)).alias("cnt"))


@registered
def seed_scan(spark, sf_dir):
    """Code tables written as CSV and read back: na is a code, an empty name is none."""
    root = scratch_path(spark, "seeds")
    country, language = pd.DataFrame(exports.COUNTRIES), pd.DataFrame(exports.LANGUAGES)
    spark.createDataFrame(country, COUNTRY).coalesce(1).write.option("header", True).csv(f"{root}/country")
    spark.createDataFrame(language, LANGUAGE).coalesce(1).write.option("header", True).csv(f"{root}/language")
    codes = read_lookups(spark, f"{root}/country", f"{root}/language")
    rows = with_language(with_country(exports.analytics_flat(spark, sf_dir), codes, "country"), codes, "language")
    return rows.select("event_id", "copy_no", "iso_country_name", "iso_language_alpha_2",
                       "iso_language_country_alpha_2")


@registered
def incremental_overwrite(spark, sf_dir):
    """A full write, then a later run's last days on top of it."""
    raw = events_raw_of(spark, sf_dir)
    daily = raw.groupBy("event_date", "platform").agg(F.count(F.lit(1)).alias("cnt"))
    path = scratch_path(spark, "daily")
    write_days(daily.withColumn("written_by", F.lit("first")), path, ["platform"],
               full_refresh=True)
    again = daily.where(TRAILING.analytics().has_date("event_date"))
    write_days(again.withColumn("written_by", F.lit("second")), path, ["platform"])
    return read_days(spark, path, WHOLE.analytics().start, WHOLE.analytics().end)


@registered
def atomic_refresh(spark, sf_dir):
    """A refresh that stops half-way, between two that do not: its rows are never seen."""
    daily = events_raw_of(spark, sf_dir).groupBy("event_date", "platform").agg(F.count(F.lit(1)).alias("cnt"))
    path = scratch_path(spark, "refreshed")
    write_days(daily.withColumn("written_by", F.lit("first")), path, ["platform"], full_refresh=True)
    late = TRAILING.analytics().has_date("event_date")
    stops = daily.withColumn("written_by", F.expr(f"if({late}, string(raise_error('stop')), 'half')"))
    try:
        write_days(stops, path, ["platform"], full_refresh=True)
    except PySparkException:
        pass
    write_days(daily.where(late).withColumn("written_by", F.lit("second")), path, ["platform"])
    return read_days(spark, path, WHOLE.analytics().start, WHOLE.analytics().end)


@registered
def clustered_write(spark, sf_dir):
    """Per day of the written events: how many files begin before another one ends."""
    stored = stored_events(spark, sf_dir)
    key = F.struct(*fv.EVENT_CLUSTER_KEYS)
    files = stored.groupBy("event_date", F.input_file_name().alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("cnt"))
    in_order = Window.partitionBy("event_date").orderBy("low", "high")
    files = files.withColumn("overlaps", F.col("low") < F.lag("high").over(in_order))
    return files.groupBy("event_date").agg(F.sum("cnt").alias("cnt"), F.count_if("overlaps").alias("overlapping"),
                                           F.min("low.event_name").alias("first_name"),
                                           F.max("high.event_name").alias("last_name"))


# Tables.

@registered
def events_raw(spark, sf_dir):
    return events_raw_of(spark, sf_dir)


@registered
def platform_expression(spark, sf_dir):
    """A platform made from another column of the export."""
    settings = dataclasses.replace(
        SETTINGS, platform_expr="if(app_info.version LIKE '1%', 'one', lower(platform))")
    raw = raw_plan.build_events_raw(exports.analytics_export(spark, sf_dir), exports.lookups(spark),
                                    Run(settings, WHOLE.run_date, incremental=False))
    return raw.groupBy("platform").agg(F.count(F.lit(1)).alias("cnt"))


# Tables of a build, with two measures of each.
BUILT = {
    "events_raw": ("sum(duplicates_cnt)", "count(DISTINCT user_pseudo_id)"),
    "crash_events_raw": ("sum(duplicates_cnt)", "count(DISTINCT crashlytics_user_pseudo_id)"),
    **{t: ("sum(cnt)", "sum(users)") for t in (
        "events", "events_forced_nulls", "crash_events", "installs", "events_wid", "events_wid_forced_nulls",
        "errors", "ui", "ui_wid")},
    "events_count": ("sum(user_engagement)", "count(DISTINCT user_id)"),
    "installs_raw": ("sum(install_age)", "count(DISTINCT user_pseudo_id)"),
    "app_health": ("sum(installs)", "sum(crashlytics_all_errors_cnt)"),
}


@registered
def whole_build(spark, sf_dir):
    """Every table built and written, and each of them read again."""
    w = build_all(spark, scratch_path(spark, "warehouse"), WHOLE, exports.lookups(spark),
                  lambda session, run: exports.analytics_export(session, sf_dir),
                  lambda session, run: exports.crash_export(session, sf_dir))
    days = [w.read(table, WHOLE.crash() if table.startswith("crash") else None)
            .groupBy(F.lit(table).alias("table_name"), "event_date")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.expr(first).alias("first_measure"),
                 F.expr(second).alias("second_measure")) for table, (first, second) in BUILT.items()]
    return functools.reduce(DataFrame.unionByName, days)


@registered
def events_rollup(spark, sf_dir):
    return usage.build_events(events_raw_of(spark, sf_dir), WHOLE)


@registered
def metric_rollup(spark, sf_dir):
    events = usage.build_events(events_raw_of(spark, sf_dir), WHOLE)
    return (events.groupBy("event_date", "event_name", "platform")
            .agg(F.sum("cm_quantity_int_sum").alias("quantity"),
                 F.min("least_quantity").alias("least_quantity"),
                 F.max("cm_price_double_max").alias("best_price"),
                 F.max("cm_quantity_int_avg").alias("largest_average")))


@registered
def forced_null_rollup(spark, sf_dir):
    return usage.build_events_forced_nulls(events_raw_of(spark, sf_dir), WHOLE)


@registered
def ui_union(spark, sf_dir):
    raw = events_raw_of(spark, sf_dir)
    return usage.ui_rows(usage.build_events(raw, WHOLE),
                         usage.build_events_forced_nulls(raw, WHOLE), WHOLE)


@registered
def error_events(spark, sf_dir):
    return usage.build_errors(usage.build_events(events_raw_of(spark, sf_dir), WHOLE), WHOLE)


@registered
def events_count(spark, sf_dir):
    return usage.build_events_count(events_raw_of(spark, sf_dir), WHOLE)


@registered
def install_first_open(spark, sf_dir):
    return installs_raw_of(spark, sf_dir)


@registered
def install_trailing_window(spark, sf_dir):
    return installs_raw_of(spark, sf_dir, FIRST_WEEK)


@registered
def install_user_id(spark, sf_dir):
    return installs_raw_of(spark, sf_dir).select("user_pseudo_id", "user_id", "event_name")


@registered
def null_user_filter(spark, sf_dir):
    raw = events_raw_of(spark, sf_dir)
    return (raw.where(F.col("user_id").isNotNull()).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("cnt"), F.min("event_ts").alias("first_ts")))


@registered
def installs_rollup(spark, sf_dir):
    return usage.build_installs(installs_raw_of(spark, sf_dir), WHOLE)


@registered
def cohort_rollup(spark, sf_dir):
    raw = stored_events(spark, sf_dir)
    return install_plan.build_events_wid(raw, install_plan.build_installs_raw(raw, WHOLE), WHOLE)


@registered
def cohort_forced_null(spark, sf_dir):
    raw = stored_events(spark, sf_dir)
    return install_plan.build_events_wid_forced_nulls(
        raw, install_plan.build_installs_raw(raw, WHOLE), WHOLE)


@registered
def ui_union_cohort(spark, sf_dir):
    raw = stored_events(spark, sf_dir)
    installs = install_plan.build_installs_raw(raw, WHOLE)
    return usage.ui_rows(install_plan.build_events_wid(raw, installs, WHOLE),
                         install_plan.build_events_wid_forced_nulls(raw, installs, WHOLE), WHOLE)


@registered
def crash_events_raw(spark, sf_dir):
    return crash_raw_of(spark, sf_dir)


@registered
def crash_rollup(spark, sf_dir):
    return crash_raw.build_crash_events(crash_raw_of(spark, sf_dir), WHOLE)


def _health_inputs(spark, sf_dir):
    raw = stored_events(spark, sf_dir)
    installs = install_plan.build_installs_raw(raw, WHOLE)
    return (usage.build_events(raw, WHOLE), usage.build_events_forced_nulls(raw, WHOLE),
            usage.build_installs(installs, WHOLE),
            crash_raw.build_crash_events(crash_raw_of(spark, sf_dir), WHOLE))


@registered
def health_measures(spark, sf_dir):
    events = usage.build_events(events_raw_of(spark, sf_dir), WHOLE)
    return app_health.by_health_keys(
        events, app_health.measures_of(SETTINGS.measures, "analytics"))


@registered
def health_join(spark, sf_dir):
    inputs = app_health.health_inputs(*_health_inputs(spark, sf_dir), WHOLE)
    return app_health.combine(inputs)


@registered
def health_key_matches(spark, sf_dir):
    return app_health.key_matches(app_health.health_inputs(*_health_inputs(spark, sf_dir), WHOLE))


@registered
def app_health_table(spark, sf_dir):
    return app_health.build_app_health(*_health_inputs(spark, sf_dir), WHOLE)


@registered
def app_health_merged_keys(spark, sf_dir):
    return app_health.build_app_health(*_health_inputs(spark, sf_dir), WHOLE, merge_keys=True)


# Branches that are never taken, and what is refused.

def _refused(attempt: Callable[[], object]) -> bool:
    try:
        attempt()
    except ValueError:
        return True
    return False


@registered
def install_without_custom_event(spark, sf_dir):
    """No event of the app stands for an install: its branch is none."""
    settings = dataclasses.replace(SETTINGS, custom_install_event=None)
    run = Run(settings, WHOLE.run_date, incremental=False)
    return install_plan.build_installs_raw(events_raw_of(spark, sf_dir), run)


@registered
def health_without_forced_measures(spark, sf_dir):
    """No measure reads the collapsed rollup: it adds no keys."""
    kept = tuple(m for m in SETTINGS.custom_measures if m.get("model") != "analytics_forced_nulls")
    run = Run(dataclasses.replace(SETTINGS, custom_measures=kept), WHOLE.run_date, incremental=False)
    return app_health.combine(app_health.health_inputs(*_health_inputs(spark, sf_dir), run))


@registered
def day_filter_required(spark, sf_dir):
    """A written table cannot be read without its days."""
    path = scratch_path(spark, "filtered")
    write_days(events_raw_of(spark, sf_dir, in_file_order=True), path, in_place=True)
    days = FIRST_WEEK.analytics()
    refused = [_refused(lambda a=a, b=b: read_days(spark, path, a, b))
               for a, b in ((None, days.end), (days.start, None), (None, None))]
    return (read_days(spark, path, days.start, days.end).groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("cnt")).withColumn("refused", F.lit(all(refused))))


@registered
def commented_columns(spark, sf_dir):
    """Descriptions of a written table's columns, with how many rows have a value."""
    path = scratch_path(spark, "commented")
    raw = with_comments(events_raw_of(spark, sf_dir, in_file_order=True), EVENTS_RAW)
    write_days(raw, path, in_place=True)
    stored = read_days(spark, path, WHOLE.analytics().start, WHOLE.analytics().end)
    columns = [f.name for f in stored.schema.fields if "comment" in f.metadata]
    counts = stored.agg(*[F.count(name(c)).alias(c) for c in columns])
    counts = counts.unpivot([], columns, "column_name", "n_values")
    comment = F.create_map(*[F.lit(x) for c in columns for x in (c, stored.schema[c].metadata["comment"])])
    return counts.withColumn("description", comment[F.col("column_name")])


@registered
def version_kinds(spark, sf_dir):
    """A version in each form it can be asked for, and in one that it cannot."""
    refused = _refused(lambda: versions.version_as("app_version", "codename"))
    return identified(exports.analytics_flat(spark, sf_dir), {
        **{f"as_{kind.replace('.', '_')}": versions.version_as("app_version", kind) for kind in versions.KINDS},
        "refused": str(refused).lower()})


@registered
def mandatory_settings(spark, sf_dir):
    """Events by platform, and whether a build without the mandatory settings is refused."""
    unset = {"project": "", "analytics_source": "", "analytics_start": fv.FULL_REFRESH_START,
             "crash_start": fv.FULL_REFRESH_START}
    refused = [_refused(dataclasses.replace(SETTINGS, **{k: v}).require_mandatory) for k, v in unset.items()]
    SETTINGS.require_mandatory()
    raw = events_raw_of(spark, sf_dir)
    return (raw.groupBy("platform").agg(F.count(F.lit(1)).alias("cnt"))
            .withColumn("refused", F.lit(sum(refused))))


# Checks.

@registered
def dimension_cardinality(spark, sf_dir):
    return checks.dimension_cardinality(events_raw_of(spark, sf_dir), WHOLE, PROFILE_DAY)


@registered
def dimensions_over_limit(spark, sf_dir):
    """Dimensions with more distinct values than a limit, by merged sketches of the days."""
    raw = stored_events(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    write_days(checks.profile_sketches(raw, WHOLE), path)
    week = FIRST_WEEK.analytics()
    kept = read_days(spark, path, week.start, week.end)
    found = [checks.dimensions_over(raw, WHOLE, week, limit, kept).withColumn("value_limit", F.lit(limit))
             for limit in OVER]
    return functools.reduce(DataFrame.unionByName, found)


@registered
def raw_day_counts(spark, sf_dir):
    return checks.raw_counts(events_raw_of(spark, sf_dir),
                             exports.analytics_export(spark, sf_dir), TRAILING)


@registered
def raw_reconciliation(spark, sf_dir):
    """The check on an event table that forgot its copies: days that had some."""
    forgetful = events_raw_of(spark, sf_dir).withColumn("duplicates_cnt", F.lit(1))
    return checks.raw_reconciliation(forgetful, exports.analytics_export(spark, sf_dir),
                                     TRAILING)


@registered
def install_uniqueness(spark, sf_dir):
    """The check on an install table that holds its rows twice."""
    installs = installs_raw_of(spark, sf_dir)
    return checks.install_uniqueness(installs.unionByName(installs),
                                     FIRST_WEEK, dt.date(2023, 12, 1))
