"""Descriptions of tables and columns, kept with the data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_VERSION = {
    "firebase_value": "Version text as exported",
    "major": "First numeric part",
    "minor": "Second numeric part",
    "bugfix": "Third numeric part",
    "major_minor": "First two parts as a number; 17.1 and 17.10 are equal",
    "major_minor_bugfix": "The leading one to three numeric parts as text",
    "normalized": "Sortable number, six digits per part, absent parts are 0",
    "join_value": "normalized as text, or the exported text if there is no number",
}


def _inside(struct: str, descriptions: Mapping[str, str]) -> dict[str, str]:
    return {f"{struct}.{name}": text for name, text in descriptions.items()}


EVENTS_RAW = {
    "event_ts": "When the event happened",
    "event_date": "UTC day of event_ts",
    "install_ts": "First contact of the user with the app",
    "install_age": "Whole days from install to event; 0 is the first 24 hours",
    "user_pseudo_id": "Id of the app instance, lower case",
    "user_id": "Account id set by the app, lower case",
    "app_id": "Bundle identifier or package name",
    "reverse_app_id": "app_id with its dotted parts in reverse order",
    "event_name": "Name of the event",
    "platform": "IOS or ANDROID, or what the platform expression yields",
    "appstore": "Where the app was installed from",
    "app_version": "Version of the app",
    **_inside("app_version", _VERSION),
    "platform_version": "Version of the operating system, parsed without its name",
    **_inside("platform_version", _VERSION),
    "user_properties": "User properties as typed fields",
    "event_parameters": "Event parameters as typed fields",
    "user_properties_raw": "User properties as exported",
    "event_parameters_raw": "Event parameters as exported",
    "geo": "Place of the device",
    "geo.city": "City as exported",
    "geo.country_firebase_value": "Country name as exported, no ISO name",
    "geo.iso_country_name": "ISO 3166 country name",
    "geo.iso_country_alpha_2": "ISO 3166 two-letter code, lower case",
    "geo.continent": "Continent as exported",
    "geo.subcontinent": "Part of the continent as exported",
    "geo.region": "Region as exported",
    "geo.metro": "Metropolitan area as exported",
    "device_hardware": "The device",
    "device_hardware.type": "Device category, lower case",
    "device_hardware.manufacturer": "Brand, lower case",
    "device_hardware.model_name": "Model name as exported",
    "device_hardware.marketing_name": "Marketing name, on Android only and not always",
    "device_hardware.os_model": "Model as the operating system names it, lower case",
    "device_language": "Language of the device",
    "device_language.firebase_value": "Language tag as exported",
    "device_language.iso_language_alpha_2": "ISO 639-1 code of the tag's first part",
    "device_language.iso_country_alpha_2": "ISO 3166 code of the tag's last part",
    "device_time_zone_offset": "Offset from UTC such as +02:00",
    "traffic_source": "What led to the install",
    "users_ltv": "Lifetime value of the user",
    "other_ids": "Ids rarely needed",
    "other_ids.firebase_app_id": "Id of the app in the export, lower case",
    "other_ids.stream_id": "Id of the data stream, lower case",
    "other_ids.advertising_id": "Advertising id, lower case, NULL if empty",
    "event_dates": "Day of event_ts at each whole-hour offset from UTC",
    "install_dates": "Day of install_ts at each whole-hour offset from UTC",
    "duplicates_cnt": "How many copies of the event the export held",
}
CRASH_EVENTS_RAW = {
    "event_ts": "When the crash happened",
    "event_date": "UTC day of event_ts",
    "received_ts": "When the report arrived",
    "crashlytics_user_pseudo_id": "Id of the installation",
    "firebase_analytics_user_pseudo_id": "Id in the analytics feed, from a custom key",
    "user_id": "Account id of the report, or from a custom key",
    "app_id": "Bundle identifier or package name",
    "reverse_app_id": "app_id with its dotted parts in reverse order",
    "event_id": "Id of the report",
    "platform": "IOS, ANDROID or UNKNOWN, from the shard's name",
    "issue": "The issue the report belongs to",
    "error_type": "FATAL, NON_FATAL or ANR",
    "process_state": "BACKGROUND, FOREGROUND or UNKNOWN_PROCESS_STATE",
    "orientation": "Orientation of app and device",
    "app_version": "Version of the app",
    "app_version.build_no": "Build number as exported",
    **_inside("app_version", _VERSION),
    "platform_version": "Version of the operating system",
    "platform_version.name": "Operating system as exported",
    **_inside("platform_version", _VERSION),
    "jailbroken_state": "MODIFIED or UNMODIFIED",
    "device_hardware": "The device",
    "device_hardware.type": "Device type, lower case",
    "device_hardware.manufacturer": "Maker, lower case",
    "device_hardware.os_model": "Model, lower case",
    "device_hardware.architecture": "Processor architecture as exported",
    "custom_keys": "Custom keys as typed fields",
    "custom_keys_raw": "Custom keys as exported",
    "memory": "Memory used and free, in bytes",
    "storage": "Storage used and free, in bytes",
    "user": "Name and mail address, if the app sets them",
    "crashlytics_sdk_version_string": "Version of the reporting library",
    "logs": "Log messages of the reporting library",
    "breadcrumbs": "Analytics events before the crash",
    "blame_frame": "Frame named as the cause",
    "android_exceptions": "Android exceptions, the first one thrown comes last",
    "ios_non_fatal": "Non-fatal errors of Apple apps",
    "threads": "Threads at the time of the crash",
    "unity_metadata": "Game engine and graphics details",
    "duplicates_cnt": "How many copies of the report the export held",
}


def _commented(data_type: T.DataType, comments: Mapping[str, str], path: str) -> T.DataType:
    if not isinstance(data_type, T.StructType):
        return data_type
    fields = []
    for field in data_type.fields:
        name = f"{path}{field.name}"
        metadata = dict(field.metadata or {})
        if name in comments:
            metadata["comment"] = comments[name]
        fields.append(T.StructField(field.name,
                                    _commented(field.dataType, comments, f"{name}."),
                                    field.nullable, metadata))
    return T.StructType(fields)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach descriptions to columns and struct fields (``struct.field``).

    They are part of the schema, so files written from the result keep them.
    """
    return df.to(_commented(df.schema, comments, ""))


def comment_table(spark: SparkSession, table: str, description: str,
                  comments: Mapping[str, str]) -> None:
    """Set the descriptions of an existing catalog table without rewriting it."""
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    spark.sql(f"COMMENT ON TABLE {table} IS {quoted(description)}")
    for name in spark.table(table).columns:
        if name in comments:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{name}` "
                      f"COMMENT {quoted(comments[name])}")
