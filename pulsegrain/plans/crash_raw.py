"""Crash export -> one row per crash, and its daily rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulsegrain import fixed_values as fv
from pulsegrain.config import CRASH_TYPES
from pulsegrain.functions.params import key_value, with_parameter_struct
from pulsegrain.functions.sqltext import aliased, expressions, struct
from pulsegrain.functions.text import platform_of_shard, reverse_dotted
from pulsegrain.functions.times import utc_date
from pulsegrain.functions.versions import clean_version, version_parts, version_struct
from pulsegrain.operators.dedup import COUNT_COLUMN, keep_one_copy
from pulsegrain.operators.determinants import dimensions
from pulsegrain.operators.dims import aligned_struct
from pulsegrain.operators.rollup import rollup
from pulsegrain.windows import DateWindow, Run

# Source columns that are used, besides the keys, the shard and the arrival time.
SOURCE = {
    "event_ts": "event_timestamp",
    "src_bundle": "bundle_identifier",
    "src_issue_id": "issue_id",
    "src_issue_title": "issue_title",
    "src_issue_subtitle": "issue_subtitle",
    "error_type": "error_type",
    "process_state": "process_state",
    "src_app_orientation": "app_orientation",
    "src_device_orientation": "device_orientation",
    "src_app_version": "application.display_version",
    "src_app_build": "application.build_version",
    "src_os_version": "operating_system.display_version",
    "src_os_name": "operating_system.name",
    "src_os_state": "operating_system.modification_state",
    "src_os_device_type": "operating_system.device_type",
    "src_device_maker": "device.manufacturer",
    "src_device_model": "device.model",
    "src_device_arch": "device.architecture",
    "src_memory_used": "memory.used",
    "src_memory_free": "memory.free",
    "src_storage_used": "storage.used",
    "src_storage_free": "storage.free",
    "src_user_id": "user.id",
    "src_user_name": "user.name",
    "src_user_email": "user.email",
    "src_sdk_version": "crashlytics_sdk_version",
    "custom_keys_raw": "custom_keys",
    "logs": "logs",
    "breadcrumbs": "breadcrumbs",
    "blame_frame": "blame_frame",
    "android_exceptions": "exceptions",
    "ios_non_fatal": "errors",
    "threads": "threads",
}


def deduplicated(export: DataFrame, run: Run) -> DataFrame:
    """One row per crash, the one received first, with aligned engine metadata."""
    slim = export.where(run.crash().has_instant("event_timestamp")).selectExpr(
        *fv.CRASH_COPY_KEYS, "received_timestamp AS received_ts", "table_suffix",
        *[aliased(path, column) for column, path in SOURCE.items()],
        aliased(aligned_struct(export.schema, "unity_metadata", fv.UNITY_METADATA),
                "unity_metadata"))
    return keep_one_copy(slim, fv.CRASH_COPY_KEYS, ["received_ts", "table_suffix"])


def _columns(on_duplicate: str) -> dict[str, str]:
    def key(wanted: str) -> str:
        return key_value("custom_keys_raw", wanted, on_duplicate=on_duplicate)

    return {
        "event_ts": "event_ts",
        "event_date": utc_date("event_ts"),
        "received_ts": "received_ts",
        "crashlytics_user_pseudo_id": "installation_uuid",
        "firebase_analytics_user_pseudo_id": key(fv.CRASH_ANALYTICS_USER_KEY),
        "user_id": f"coalesce(src_user_id, {key(fv.CRASH_APP_USER_KEY)})",
        "app_id": "src_bundle",
        "reverse_app_id": reverse_dotted("src_bundle"),
        "event_id": "event_id",
        "platform": platform_of_shard("table_suffix"),
        "issue": struct({"id": "src_issue_id", "title": "src_issue_title",
                         "subtitle": "src_issue_subtitle", "variant_id": "variant_id"}),
        "error_type": "error_type",
        "process_state": "process_state",
        "orientation": struct({"app": "src_app_orientation",
                               "device": "src_device_orientation"}),
        "app_version": version_struct("src_app_version", "src_app_version", "__app_clean",
                                      {"build_no": "src_app_build"}, "__app_parts"),
        "platform_version": version_struct("src_os_version", "src_os_version", "__os_clean",
                                           {"name": "src_os_name"}, "__os_parts"),
        "jailbroken_state": "src_os_state",
        "device_hardware": struct({
            "type": "lower(src_os_device_type)", "manufacturer": "lower(src_device_maker)",
            "os_model": "lower(src_device_model)", "architecture": "src_device_arch"}),
        "custom_keys": "custom_keys",
        "custom_keys_raw": "custom_keys_raw",
        "memory": struct({"used_bytes": "src_memory_used", "free_bytes": "src_memory_free"}),
        "storage": struct({"used_bytes": "src_storage_used", "free_bytes": "src_storage_free"}),
        "user": struct({"name": "src_user_name", "email": "src_user_email"}),
        "crashlytics_sdk_version_string": "src_sdk_version",
        **{c: c for c in ("logs", "breadcrumbs", "blame_frame", "android_exceptions",
                          "ios_non_fatal", "threads", "unity_metadata", COUNT_COLUMN)},
    }


def build_crash_events_raw(export: DataFrame, run: Run) -> DataFrame:
    """The ``crash_events_raw`` table. ``export`` has ``table_suffix``, which
    names the platform."""
    settings = run.settings
    rows = deduplicated(export, run)
    rows = with_parameter_struct(rows, "custom_keys", "custom_keys_raw", settings.crash_keys,
                                 CRASH_TYPES, settings.duplicate_keys)
    rows = rows.selectExpr("*", aliased(clean_version("src_app_version"), "__app_clean"),
                           aliased(clean_version("src_os_version"), "__os_clean"))
    rows = rows.selectExpr("*", aliased(version_parts("__app_clean"), "__app_parts"),
                           aliased(version_parts("__os_clean"), "__os_parts"))
    return rows.selectExpr(*expressions(_columns(settings.duplicate_keys)))


def build_crash_events(crash_events_raw: DataFrame, run: Run,
                       window: DateWindow | None = None) -> DataFrame:
    """The ``crash_events`` rollup. Every custom key is a dimension, whatever its role."""
    rows = crash_events_raw.where((window or run.crash()).has_date("event_date"))
    dims = dimensions(rows.schema, fv.CRASH_DIMENSIONS)
    return rollup(rows, {"event_date": "event_date"}, dims, "crashlytics_user_pseudo_id")
