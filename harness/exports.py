"""The two export feeds, derived from the ``events`` table.

The flat form is SQL that Spark and DuckDB both run, so that a query and its
counterpart start from the same rows. ``{events}`` is the input table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pulsegrain.functions.sqltext import expressions, struct
from pulsegrain.operators.lookups import Lookups
from pulsegrain.session import tune

ANALYTICS_FLAT = """
WITH base AS (
  SELECT event_id, ts, user_id, event_type, value, props, 0 AS copy_no FROM {events}
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value, props, 1 AS copy_no FROM {events}
  WHERE event_id % 50 = 0
), firsts AS (
  SELECT user_id AS first_user, min(ts) AS first_ts FROM {events} GROUP BY user_id
)
SELECT b.event_id, b.copy_no, b.ts AS event_ts,
  CASE WHEN b.user_id % 17 = 3 THEN NULL
       WHEN b.user_id % 17 = 5 THEN f.first_ts + INTERVAL 30 HOUR
       ELSE f.first_ts END AS install_ts,
  CASE WHEN b.event_id % 4 = 0 THEN NULL ELSE b.ts - INTERVAL 10 MINUTE END AS previous_ts,
  CASE WHEN b.user_id % 29 = 7 THEN NULL ELSE concat('U', CAST(b.user_id AS string)) END
    AS user_pseudo_id,
  CASE WHEN b.event_id % 3 = 0 THEN concat('Acct', CAST(b.user_id AS string)) ELSE NULL END
    AS user_id,
  b.event_id AS event_bundle_sequence_id,
  CASE WHEN b.event_type = 'signup' THEN 'first_open'
       WHEN b.event_type = 'view' THEN 'ui_view_shown'
       WHEN b.event_type = 'click' THEN 'ui_button_tapped'
       WHEN b.event_type = 'error' AND b.event_id % 10 = 0 THEN 'ob_error_client'
       WHEN b.event_type = 'error' AND b.event_id % 10 = 1 THEN 'errorXnet'
       WHEN b.event_type = 'error' AND b.event_id % 10 = 2 THEN 'error'
       WHEN b.event_type = 'error' THEN 'error_server'
       WHEN b.event_id % 7 = 0 THEN 'ob_first_open'
       WHEN b.event_id % 7 = 1 THEN 'attributed_first_open'
       ELSE 'user_engagement' END AS event_name,
  CASE WHEN b.user_id % 2 = 0 THEN 'IOS' ELSE 'ANDROID' END AS platform,
  concat('com.example.app', CAST(b.user_id % 3 AS string)) AS app_id,
  CASE WHEN b.event_id % 37 = 0 THEN 'beta'
       WHEN b.event_id % 5 = 0 THEN CAST(b.user_id % 4 AS string)
       WHEN b.event_id % 5 = 1 THEN concat(CAST(b.user_id % 4 AS string), '.',
                                           CAST(b.event_id % 12 AS string))
       ELSE concat(CAST(b.user_id % 4 AS string), '.', CAST(b.event_id % 12 AS string), '.',
                   CAST(b.event_id % 5 AS string)) END AS app_version,
  CASE WHEN b.user_id % 3 = 0 THEN 'manual_install'
       WHEN b.user_id % 2 = 0 THEN 'iTunes' ELSE NULL END AS install_source,
  CASE WHEN b.user_id % 2 = 0 THEN 'iOS' ELSE 'Android' END AS os_name,
  CASE WHEN b.user_id % 2 = 0 THEN concat('iOS ', CAST(15 + b.user_id % 3 AS string), '.1')
       ELSE concat('Android ', CAST(11 + b.user_id % 4 AS string)) END AS os_version,
  CASE b.user_id % 6 WHEN 0 THEN 'Germany' WHEN 1 THEN 'Sweden' WHEN 2 THEN 'Namibia'
       WHEN 3 THEN 'Nowhere' WHEN 4 THEN NULL ELSE 'france' END AS country,
  CASE b.user_id % 6 WHEN 0 THEN 'de-DE' WHEN 1 THEN 'sv' WHEN 2 THEN 'en-na'
       WHEN 3 THEN 'zh-hans-cn' WHEN 4 THEN NULL ELSE 'xx' END AS language,
  CASE b.user_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 7200 WHEN 2 THEN -19800 WHEN 3 THEN 45900
       ELSE NULL END AS tz_offset_s,
  concat('City', CAST(b.event_id % 40 AS string)) AS city,
  CASE WHEN b.user_id % 2 = 0 THEN 'Phone' ELSE 'Tablet' END AS device_type,
  CASE WHEN b.user_id % 2 = 0 THEN 'Apple' ELSE 'Samsung' END AS device_brand,
  CASE WHEN b.user_id % 11 = 4 THEN NULL ELSE concat('SM-A', CAST(b.user_id % 3 AS string)) END
    AS device_os_model,
  CASE b.user_id % 3 WHEN 0 THEN '' WHEN 1 THEN concat('AD-', CAST(b.user_id AS string))
       ELSE NULL END AS advertising_id,
  CASE WHEN b.user_id % 4 = 1 THEN 'organic' ELSE NULL END AS traffic_medium,
  CASE WHEN b.user_id % 2 = 0 THEN 'Dark' ELSE NULL END AS dark_mode,
  CASE WHEN b.event_type IN ('view', 'click')
       THEN concat(' View', CAST(b.event_id % 7 AS string), ' ') ELSE NULL END AS view_name,
  CASE WHEN b.event_type IN ('view', 'click') AND b.event_id % 3 < 2
       THEN concat('Type', CAST(b.event_id % 3 AS string)) ELSE NULL END AS view_type,
  CASE WHEN b.event_type = 'error' THEN 400 + b.event_id % 5 ELSE NULL END AS status_code,
  CAST(regexp_extract(b.props, '([0-9]+)', 1) AS bigint) AS quantity,
  b.value AS price,
  concat(CASE WHEN b.copy_no = 1 THEN 'intraday_' ELSE '' END,
         replace(CAST(CAST(b.ts AS date) AS string), '-', '')) AS table_suffix
FROM base b JOIN firsts f ON b.user_id = f.first_user
"""

CRASH_FLAT = """
WITH base AS (
  SELECT event_id, ts, user_id, value, 0 AS copy_no FROM {events} WHERE event_type = 'error'
  UNION ALL
  SELECT event_id, ts, user_id, value, 1 AS copy_no FROM {events}
  WHERE event_type = 'error' AND event_id % 20 = 0
)
SELECT event_id AS source_id, CAST(event_id AS string) AS event_id, copy_no, ts AS event_ts,
  CASE WHEN copy_no = 0 THEN ts + INTERVAL 5 MINUTE ELSE ts + INTERVAL 1 MINUTE END
    AS received_ts,
  concat('c', CAST(user_id AS string)) AS installation_uuid,
  CAST(event_id % 3 AS string) AS variant_id,
  CASE user_id % 3 WHEN 0 THEN 'com_example_IOS' WHEN 1 THEN 'com_example_ANDROID_REALTIME'
       ELSE 'com_example' END AS table_suffix,
  concat('com.example.app', CAST(user_id % 3 AS string)) AS app_id,
  CASE event_id % 3 WHEN 0 THEN 'FATAL' WHEN 1 THEN 'NON_FATAL' ELSE 'ANR' END AS error_type,
  CASE event_id % 2 WHEN 0 THEN 'FOREGROUND' ELSE 'BACKGROUND' END AS process_state,
  concat(CAST(user_id % 4 AS string), '.', CAST(event_id % 12 AS string)) AS app_version,
  CASE WHEN user_id % 2 = 0 THEN concat(CAST(15 + user_id % 3 AS string), '.1')
       ELSE CAST(11 + user_id % 4 AS string) END AS os_version,
  CASE WHEN user_id % 2 = 0 THEN 'phone' ELSE 'tablet' END AS device_type,
  CASE WHEN user_id % 2 = 0 THEN 'Apple' ELSE 'Samsung' END AS device_brand,
  CASE WHEN user_id % 11 = 4 THEN NULL ELSE concat('SM-A', CAST(user_id % 3 AS string)) END
    AS device_os_model,
  CASE WHEN event_id % 4 = 0 THEN concat('Acct', CAST(user_id AS string)) ELSE NULL END
    AS report_user_id,
  CASE WHEN event_id % 5 < 3 THEN concat('App', CAST(user_id AS string)) ELSE NULL END
    AS key_user_id,
  CASE WHEN user_id % 2 = 1 THEN concat('u', CAST(user_id AS string)) ELSE NULL END
    AS key_pseudo_id,
  CASE event_id % 3 WHEN 0 THEN 'duringCall' WHEN 1 THEN 'idle' ELSE NULL END AS call_state,
  concat('2022.3.', CAST(event_id % 4 AS string)) AS unity_version,
  CASE WHEN user_id % 3 = 0 THEN NULL ELSE 2 + event_id % 4 END AS processor_count,
  CASE WHEN user_id % 3 = 0 THEN NULL ELSE 1000 + event_id % 9 END AS processor_frequency_mhz
FROM base
"""

# firebase_name, name, alpha_2, alpha_3, numeric
COUNTRIES = [
    ("China", "China", "cn", "chn", 156),
    ("El Salvador", "El Salvador", "sv", "slv", 222),
    ("France", "France", "fr", "fra", 250),
    ("Germany", "Germany", "de", "deu", 276),
    ("Namibia", "Namibia", "na", "nam", 516),
    (None, "Norway", "no", "nor", 578),
    ("Sweden", "Sweden", "se", "swe", 752),
    (None, "Ukraine", "ua", "ukr", 804),
    ("United States", "United States of America (the)", "us", "usa", 840),
]
# name, alpha_2, alpha_3, alpha_3_en, alpha_3_variety
LANGUAGES = [
    ("Chinese", "zh", "zho", "chi", "zho"),
    ("English", "en", "eng", "eng", "eng"),
    ("French", "fr", "fra", "fre", "fra"),
    ("German", "de", "deu", "ger", "deu"),
    ("Nauruan", "na", "nau", "nau", "nau"),
    ("Norwegian", "no", "nor", "nor", "nor"),
    ("Swedish", "sv", "swe", "swe", "swe"),
]


def lookups(spark: SparkSession) -> Lookups:
    # Fixed lists above, so there is nothing to check.
    def table(rows, columns):
        return spark.createDataFrame(pa.Table.from_pylist(
            [dict(zip(columns, row)) for row in rows]))

    return Lookups(table(COUNTRIES, ("firebase_name", "name", "alpha_2", "alpha_3", "numeric")),
                   table(LANGUAGES, ("name", "alpha_2", "alpha_3")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The event times carry no zone and are read as UTC.
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def analytics_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ANALYTICS_FLAT, events=events(spark, sf_dir))


def crash_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CRASH_FLAT, events=events(spark, sf_dir))


def _entry(key: str, kind: str, column: str) -> str:
    """A list of a key/value entry, without it if its value is NULL."""
    kinds = {"string_value": "string", "int_value": "bigint", "double_value": "double"}
    value = struct({f: f"CAST({column if f == kind else 'NULL'} AS {t})"
                    for f, t in kinds.items()})
    return _if_given(column, struct({"key": repr(key), "value": value}))


def _if_given(column: str, entry: str) -> str:
    return f"slice(array({entry}), 1, int({column} IS NOT NULL))"


def _entries(*entries: str) -> str:
    # Unlike array_compact, these stay inside generated code.
    return f"concat({', '.join(entries)})"


def _crash_key(key: str, column: str) -> str:
    return _if_given(column, struct({"key": repr(key), "value": column}))


TEXT, LONG = "CAST(NULL AS string)", "CAST(NULL AS bigint)"
ANALYTICS_NESTED = {
    "event_timestamp": "unix_micros(timestamp(event_ts))",
    "user_first_touch_timestamp": "unix_micros(timestamp(install_ts))",
    "event_previous_timestamp": "unix_micros(timestamp(previous_ts))",
    "event_bundle_sequence_id": "event_bundle_sequence_id",
    "event_name": "event_name",
    "platform": "platform",
    "user_pseudo_id": "user_pseudo_id",
    "user_id": "user_id",
    "stream_id": "upper(concat('stream-', platform))",
    "app_info": struct({"id": "app_id", "version": "app_version",
                        "install_source": "install_source",
                        "firebase_app_id": "concat('1:', upper(app_id))"}),
    "device": struct({
        "category": "device_type", "mobile_brand_name": "device_brand",
        "mobile_model_name": "device_os_model", "mobile_marketing_name": TEXT,
        "mobile_os_hardware_model": "device_os_model", "operating_system": "os_name",
        "operating_system_version": "os_version", "language": "language",
        "advertising_id": "advertising_id", "time_zone_offset_seconds": "bigint(tz_offset_s)"}),
    "geo": struct({"city": "city", "country": "country", "continent": "'Europe'",
                   "sub_continent": TEXT, "region": TEXT, "metro": TEXT}),
    "traffic_source": struct({"name": TEXT, "medium": "traffic_medium", "source": TEXT}),
    "user_ltv": struct({"revenue": "price", "currency": "'EUR'"}),
    "event_params": _entries(_entry("view_name", "string_value", "view_name"),
                             _entry("view_type", "string_value", "view_type"),
                             _entry("status_code", "int_value", "status_code"),
                             _entry("quantity", "int_value", "quantity"),
                             _entry("price", "double_value", "price")),
    "user_properties": _entries(_entry("ob_ui_dark_mode", "string_value", "dark_mode")),
    "table_suffix": "table_suffix",
}


def _list_of(when: str, fields: dict[str, str], types: str) -> str:
    """A list of one record, or an empty one."""
    return f"if({when}, array({struct(fields)}), CAST(array() AS array<struct<{types}>>))"


CRASH_NESTED = {
    "event_timestamp": "timestamp(event_ts)",
    "received_timestamp": "timestamp(received_ts)",
    "installation_uuid": "installation_uuid",
    "event_id": "event_id",
    "variant_id": "variant_id",
    "bundle_identifier": "app_id",
    "issue_id": "concat('issue', variant_id)",
    "issue_title": TEXT,
    "issue_subtitle": TEXT,
    "error_type": "error_type",
    "process_state": "process_state",
    "app_orientation": "'PORTRAIT'",
    "device_orientation": TEXT,
    "crashlytics_sdk_version": "'18.2'",
    "application": struct({"display_version": "app_version", "build_version": "variant_id"}),
    "operating_system": struct({"display_version": "os_version", "name": TEXT,
                                "modification_state": "'UNMODIFIED'",
                                "device_type": "device_type"}),
    "device": struct({"manufacturer": "device_brand", "model": "device_os_model",
                      "architecture": "'arm64'"}),
    "memory": struct({"used": "source_id", "free": "7L"}),
    "storage": struct({"used": "source_id", "free": "9L"}),
    "user": struct({"id": "report_user_id", "name": TEXT, "email": TEXT}),
    "custom_keys": _entries(_crash_key("fb_user_pseudo_id", "key_pseudo_id"),
                            _crash_key("app_user_id", "key_user_id"),
                            _crash_key("call_state", "call_state")),
    "logs": _list_of("source_id % 2 = 0", {"timestamp": "timestamp(event_ts)", "message": "concat('log ', event_id)"},
                     "timestamp:timestamp,message:string"),
    "breadcrumbs": _list_of("source_id % 3 = 0", {
        "timestamp": "timestamp(received_ts)", "name": "concat('crumb', variant_id)",
        "params": f"array({struct({'key': repr('id'), 'value': 'event_id'})})"},
        "timestamp:timestamp,name:string,params:array<struct<key:string,value:string>>"),
    "blame_frame": struct({"line": "source_id % 100", "file": "concat('file', variant_id)", "symbol": TEXT,
                           "library": "'app'", "owner": "'DEVELOPER'", "blamed": "source_id % 2 = 1"}),
    "exceptions": _list_of("error_type = 'NON_FATAL'", {
        "type": "'Broken'", "exception_message": "concat('broke ', event_id)", "nested": "false", "title": TEXT,
        "subtitle": TEXT, "blamed": "true"},
        "type:string,exception_message:string,nested:boolean,title:string,subtitle:string,blamed:boolean"),
    "errors": _list_of("error_type = 'ANR'", {
        "queue": "'main'", "code": "source_id % 7", "title": "'slow'", "subtitle": TEXT, "blamed": "false"},
        "queue:string,code:bigint,title:string,subtitle:string,blamed:boolean"),
    "threads": _list_of("error_type = 'FATAL'", {
        "crashed": "true", "thread_name": "concat('thread', variant_id)", "queue_name": TEXT, "title": TEXT,
        "subtitle": TEXT, "blamed": "true"},
        "crashed:boolean,thread_name:string,queue_name:string,title:string,subtitle:string,blamed:boolean"),
    "unity_metadata": struct({c: c for c in ("unity_version", "processor_count",
                                             "processor_frequency_mhz")}),
    "table_suffix": "table_suffix",
}


def analytics_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested analytics feed, with the shard each row came from."""
    return analytics_flat(spark, sf_dir).selectExpr(*expressions(ANALYTICS_NESTED))


def crash_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested crash feed, with the shard each row came from."""
    return crash_flat(spark, sf_dir).selectExpr(*expressions(CRASH_NESTED))
