"""Analytics export -> one row per event, with typed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain import fixed_values as fv
from pulsegrain.config import ANALYTICS_TYPES
from pulsegrain.functions.params import extraction
from pulsegrain.functions.sqltext import aliased, expressions, struct
from pulsegrain.functions.text import null_if_empty, reverse_dotted
from pulsegrain.functions.times import (
    age_in_days, hour_number, offset_text, utc_date, zone_dates)
from pulsegrain.functions.versions import (
    clean_found, version_found, version_parts, version_struct, version_without_os)
from pulsegrain.operators.dedup import COUNT_COLUMN, keep_one_copy
from pulsegrain.operators.lookups import Lookups, with_country, with_language
from pulsegrain.sources.tables import in_ranges
from pulsegrain.windows import Run

# Source columns that are used, under the name they have until the final select.
SOURCE = {
    "user_first_touch_timestamp": "user_first_touch_timestamp",
    "user_id": "user_id",
    "stream_id": "stream_id",
    "src_app_id": "app_info.id",
    "src_app_version": "app_info.version",
    "src_install_source": "app_info.install_source",
    "src_firebase_app_id": "app_info.firebase_app_id",
    "src_device_category": "device.category",
    "src_device_brand": "device.mobile_brand_name",
    "src_device_model": "device.mobile_model_name",
    "src_device_marketing": "device.mobile_marketing_name",
    "src_device_os_model": "device.mobile_os_hardware_model",
    "src_os_name": "device.operating_system",
    "src_os_version": "device.operating_system_version",
    "src_language": "device.language",
    "src_advertising_id": "device.advertising_id",
    "src_offset_seconds": "device.time_zone_offset_seconds",
    "src_city": "geo.city",
    "src_country": "geo.country",
    "src_continent": "geo.continent",
    "src_subcontinent": "geo.sub_continent",
    "src_region": "geo.region",
    "src_metro": "geo.metro",
    "src_source_name": "traffic_source.name",
    "src_source_medium": "traffic_source.medium",
    "src_source_source": "traffic_source.source",
    "src_revenue": "user_ltv.revenue",
    "src_currency": "user_ltv.currency",
    "user_properties_raw": "user_properties",
    "event_parameters_raw": "event_params",
}


def in_run(export: DataFrame, run: Run) -> DataFrame:
    """Rows of the run's days, as a range on the stored column so that it
    reaches the scan; and of the run's shards where the shard is known."""
    rows = export.where(run.analytics().has_day_of_micros("event_timestamp"))
    if "table_suffix" in export.columns:
        rows = rows.where(run.shards().has_shard("table_suffix"))
    return rows


def deduplicated(export: DataFrame, run: Run) -> DataFrame:
    """One row per event, reduced to the source columns in use.

    Of several copies the one in the first shard name stays, so a finished day
    wins over an intraday shard.
    """
    prefer = ["table_suffix"] if "table_suffix" in export.columns else []
    slim = in_run(export, run).selectExpr(
        *fv.EVENT_COPY_KEYS, *prefer,
        aliased(run.settings.platform_expr, "src_platform"),
        *[aliased(path, column) for column, path in SOURCE.items()])
    return keep_one_copy(slim, fv.EVENT_COPY_KEYS, prefer).drop(*prefer)


# The table, column by column, from the stages below.
COLUMNS = {
    "event_ts": "event_ts",
    "event_date": utc_date("event_ts"),
    "install_ts": "install_ts",
    "install_age": age_in_days("event_ts", "install_ts"),
    "user_pseudo_id": "lower(user_pseudo_id)",
    "user_id": "lower(user_id)",
    "app_id": "src_app_id",
    "reverse_app_id": reverse_dotted("src_app_id"),
    "event_name": "event_name",
    "platform": "src_platform",
    "appstore": "src_install_source",
    "app_version": version_struct("src_app_version", "src_app_version", clean_found("__app_found"),
                                  parts="__app_parts"),
    "platform_version": version_struct("src_os_version", "__os_version", clean_found("__os_found"),
                                       parts="__os_parts"),
    "user_properties": "",  # depends on the settings
    "event_parameters": "",
    "user_properties_raw": "user_properties_raw",
    "event_parameters_raw": "event_parameters_raw",
    "geo": struct({
        "city": "src_city", "country_firebase_value": "src_country",
        "iso_country_name": "iso_country_name", "iso_country_alpha_2": "iso_country_alpha_2",
        "continent": "src_continent", "subcontinent": "src_subcontinent",
        "region": "src_region", "metro": "src_metro"}),
    "device_hardware": struct({
        "type": "lower(src_device_category)", "manufacturer": "lower(src_device_brand)",
        "model_name": "src_device_model", "marketing_name": "src_device_marketing",
        "os_model": "lower(src_device_os_model)"}),
    "device_language": struct({
        "firebase_value": "src_language", "iso_language_alpha_2": "iso_language_alpha_2",
        "iso_country_alpha_2": "iso_language_country_alpha_2"}),
    "device_time_zone_offset": offset_text("src_offset_seconds"),
    "traffic_source": struct({"name": "src_source_name", "medium": "src_source_medium",
                              "source": "src_source_source"}),
    "users_ltv": struct({"revenue": "src_revenue", "currency": "src_currency"}),
    "other_ids": struct({
        "firebase_app_id": "lower(src_firebase_app_id)", "stream_id": "lower(stream_id)",
        "advertising_id": f"lower({null_if_empty('src_advertising_id')})"}),
    "event_dates": zone_dates("__event_hour"),
    "install_dates": zone_dates("__install_hour"),
    COUNT_COLUMN: COUNT_COLUMN,
}


def build_events_raw(export: DataFrame, lookups: Lookups, run: Run,
                     in_file_order: bool = False) -> DataFrame:
    """The ``events_raw`` table.

    Copies are removed first, so that only survivors are enriched and the wide
    derived columns never go through the shuffle. Nor do they with ``in_file_order``, which
    deals the survivors out by ranges of day and cluster keys, as the written table has them.
    """
    settings = run.settings
    user = extraction("user_properties", "user_properties_raw", settings.user_properties,
                      ANALYTICS_TYPES, settings.duplicate_keys)
    event = extraction("event_parameters", "event_parameters_raw",
                       settings.extracted_event_parameters, ANALYTICS_TYPES,
                       settings.duplicate_keys)
    rows = deduplicated(export, run)
    if in_file_order:
        day = F.expr(utc_date("timestamp_micros(event_timestamp)"))
        keys = [COLUMNS[c] for c in fv.EVENT_CLUSTER_KEYS]
        rows = in_ranges(rows, day, *keys, F.xxhash64(*fv.EVENT_COPY_KEYS), as_large_as=export)
        # The sample that finds the borders needs no codes, and joins after it may not move rows.
        lookups = lookups.sent_to_rows()
    rows = with_country(rows, lookups, "src_country")
    rows = with_language(rows, lookups, "src_language")
    # What is used several times is computed once per row, in one step: every
    # step copies the row.
    os_version = version_without_os("src_os_version", "src_os_name")
    found, os_found = version_found("src_app_version"), version_found(os_version)
    event_ts = "timestamp_micros(event_timestamp)"
    install_ts = "timestamp_micros(user_first_touch_timestamp)"
    rows = rows.selectExpr("*", *expressions({
        "event_ts": event_ts, "install_ts": install_ts,
        "__event_hour": hour_number(event_ts), "__install_hour": hour_number(install_ts),
        "__os_version": os_version,
        "__app_found": found, "__app_parts": version_parts(found),
        "__os_found": os_found, "__os_parts": version_parts(os_found),
        **user.positions, **event.positions}))
    return rows.selectExpr(*expressions({
        **COLUMNS, "user_properties": user.struct, "event_parameters": event.struct}))
