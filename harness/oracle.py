"""DuckDB SQL for the registered queries, written independently of the engine.

Joins, windows and groupings follow the definitions literally (for example
three full outer joins for the health table), so that the engine's own
formulations are checked against them.
"""

from __future__ import annotations

from harness.exports import ANALYTICS_FLAT, COUNTRIES, CRASH_FLAT, LANGUAGES
from harness.queries import BUILT, NAMES, OVER, PROFILE_DAY
from harness.settings import FIRST_WEEK, TRAILING
from pulsegrain import fixed_values as fv
from pulsegrain.sources.comments import EVENTS_RAW

EXPORT = ANALYTICS_FLAT.replace("{events}", "events")
CRASHES = CRASH_FLAT.replace("{events}", "events")


def values(rows) -> str:
    def literal(v) -> str:
        return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


SEEDS = f"""
country AS (SELECT * FROM (VALUES {values(COUNTRIES)})
  AS t(firebase_name, name, alpha_2, alpha_3, num)),
language AS (SELECT * FROM (VALUES {values(LANGUAGES)})
  AS t(name, alpha_2, alpha_3, alpha_3_en, alpha_3_variety))"""

GEO_JOINS = """
LEFT JOIN country g ON lower(x.country) = lower(g.firebase_name)
LEFT JOIN language l ON lower(split_part(x.language, '-', 1)) = l.alpha_2
LEFT JOIN country r ON lower(list_reverse(str_split(x.language, '-'))[1]) = r.alpha_2"""


# Expressions.

def clean(v: str) -> str:
    return rf"nullif(regexp_extract({v}, '^(\d+(?:\.\d+){{0,2}})', 1), '')"


def part(v: str, n: int) -> str:
    return f"TRY_CAST(str_split({clean(v)}, '.')[{n}] AS BIGINT)"


def major_minor(v: str) -> str:
    return (f"TRY_CAST(CAST({part(v, 1)} AS VARCHAR) || '.' || "
            f"CAST(coalesce({part(v, 2)}, 0) AS VARCHAR) AS DOUBLE)")


def normalized(v: str) -> str:
    digits = " || ".join(f"printf('%06d', coalesce({part(v, n)}, 0))" for n in (1, 2, 3))
    return f"CASE WHEN {clean(v)} IS NOT NULL THEN TRY_CAST({digits} AS BIGINT) END"


def join_value(v: str) -> str:
    return f"coalesce(CAST({normalized(v)} AS VARCHAR), {v})"


VERSION = ("firebase_value", "major", "minor", "bugfix", "major_minor", "major_minor_bugfix",
           "normalized", "join_value")


def version_columns(prefix: str, original: str, v: str, extra: str = "") -> str:
    return f"""{original} AS {prefix}_firebase_value, {extra}
  {part(v, 1)} AS {prefix}_major, {part(v, 2)} AS {prefix}_minor, {part(v, 3)} AS {prefix}_bugfix,
  {major_minor(v)} AS {prefix}_major_minor, {clean(v)} AS {prefix}_major_minor_bugfix,
  {normalized(v)} AS {prefix}_normalized, {join_value(v)} AS {prefix}_join_value"""


OS_BARE = "replace(os_version, os_name || ' ', '')"


def record_columns(prefix: str, j: str) -> str:
    major = f"TRY_CAST(substring({j}, 1, length({j}) - 12) AS BIGINT)"
    minor = f"TRY_CAST(substring({j}, -12, 6) AS BIGINT)"
    bugfix = f"TRY_CAST(substring({j}, -6, 6) AS BIGINT)"
    fields = {
        "major": major, "minor": minor, "bugfix": bugfix,
        "major_minor": f"TRY_CAST({major} || '.' || {minor} AS DOUBLE)",
        "major_minor_bugfix": f"{major} || '.' || {minor} || '.' || {bugfix}",
        "normalized": f"TRY_CAST({j} AS BIGINT)",
    }
    usable = f"TRY_CAST({j} AS BIGINT) IS NOT NULL AND length({j}) >= 13"
    return ", ".join(f"CASE WHEN {usable} THEN {e} END AS {prefix}_{n}"
                     for n, e in fields.items())


AGE = "CAST(floor(date_sub('hour', install_ts, event_ts) / 24.0) AS BIGINT)"
WALL_AGE = "CAST(floor(date_diff('minute', install_ts, event_ts) / 1440.0) AS BIGINT)"
OFFSETS = [n for n in range(-12, 13) if n != 0]


def offset(n: int) -> str:
    return f"minus_{-n}" if n < 0 else f"plus_{n}"


def age_group(age: str) -> str:
    return (f"CASE WHEN {age} = 0 THEN 'Age 0' WHEN {age} <= 6 THEN 'Age 1-6' "
            f"WHEN {age} <= 30 THEN 'Age 7-30' ELSE 'Age 31+' END")


def zone_dates(prefix: str, ts: str) -> str:
    return ", ".join(f"CAST({ts} + INTERVAL ({n}) HOUR AS DATE) AS {prefix}_{offset(n)}"
                     for n in OFFSETS)


OFFSET_TEXT = ("CASE WHEN tz_offset_s >= 0 THEN '+' WHEN tz_offset_s < 0 THEN '-' END || "
               "strftime(TIMESTAMP '1970-01-01' + to_seconds(abs(tz_offset_s)), '%H:%M')")


def reverse_id(v: str) -> str:
    return f"array_to_string(list_reverse(str_split({v}, '.')), '.')"


UI = "event_name IN ('ob_ui_view_shown', 'ob_ui_button_tapped', 'ui_view_shown', 'ui_button_tapped')"
COPY_KEYS = "user_pseudo_id, event_bundle_sequence_id, event_name, event_ts, previous_ts"
CRASH_KEYS = "installation_uuid, event_id, variant_id"

EVENT_PARAMETERS = f"""
  CASE WHEN {UI} THEN lower(trim(view_name)) END AS event_parameters_view_name_string,
  lower(trim(view_type)) AS event_parameters_view_type_string,
  CAST(NULL AS VARCHAR) AS event_parameters_parent_view_name_string,
  CAST(NULL AS VARCHAR) AS event_parameters_parent_view_type_string,
  CAST(NULL AS VARCHAR) AS event_parameters_button_name_string,
  CAST(NULL AS VARCHAR) AS event_parameters_button_extra_string,
  CAST(NULL AS VARCHAR) AS event_parameters_domain_string,
  CAST(NULL AS VARCHAR) AS event_parameters_path_string,
  CAST(status_code AS BIGINT) AS event_parameters_status_code_int,
  CAST(NULL AS VARCHAR) AS event_parameters_extra_string,
  quantity AS event_parameters_quantity_int,
  price AS event_parameters_price_double"""
USER_PROPERTIES = """
  dark_mode AS user_properties_ob_ui_dark_mode_string,
  CAST(NULL AS VARCHAR) AS user_properties_ob_ui_font_size_string"""



def entries(*pairs: tuple[str, str, str]) -> str:
    """Key/value entries of those columns that have a value, as JSON text."""
    kinds = {"string_value": "VARCHAR", "int_value": "BIGINT", "double_value": "DOUBLE"}
    made = ", ".join(
        f"CASE WHEN {column} IS NOT NULL THEN {{'key': '{key}', 'value': {{"
        + ", ".join(f"'{k}': CAST({column if k == kind else 'NULL'} AS {t})" for k, t in kinds.items()) + "}} END"
        for key, kind, column in pairs)
    return f"CAST(to_json(list_filter([{made}], lambda x: x IS NOT NULL)) AS VARCHAR)"


EVENT_ENTRIES = entries(("view_name", "string_value", "view_name"), ("view_type", "string_value", "view_type"),
                        ("status_code", "int_value", "status_code"), ("quantity", "int_value", "quantity"),
                        ("price", "double_value", "price"))
USER_ENTRIES = entries(("ob_ui_dark_mode", "string_value", "dark_mode"))

RAW = f"""
export AS ({EXPORT}), {SEEDS},
survivor AS (
  SELECT *, count(*) OVER (PARTITION BY {COPY_KEYS}) AS duplicates_cnt FROM export
  QUALIFY row_number() OVER (PARTITION BY {COPY_KEYS} ORDER BY table_suffix) = 1
),
raw AS (
  SELECT event_ts, CAST(event_ts AS DATE) AS event_date, install_ts, {AGE} AS install_age,
  lower(user_pseudo_id) AS user_pseudo_id, lower(user_id) AS user_id,
  app_id, {reverse_id('app_id')} AS reverse_app_id, event_name, platform,
  install_source AS appstore,
  {version_columns('app_version', 'app_version', 'app_version')},
  {version_columns('platform_version', 'os_version', OS_BARE)},
  {USER_PROPERTIES}, {EVENT_PARAMETERS},
  {USER_ENTRIES} AS user_properties_raw, {EVENT_ENTRIES} AS event_parameters_raw,
  city AS geo_city, x.country AS geo_country_firebase_value, g.name AS geo_iso_country_name,
  g.alpha_2 AS geo_iso_country_alpha_2, 'Europe' AS geo_continent,
  CAST(NULL AS VARCHAR) AS geo_subcontinent, CAST(NULL AS VARCHAR) AS geo_region,
  CAST(NULL AS VARCHAR) AS geo_metro,
  lower(device_type) AS device_hardware_type, lower(device_brand) AS device_hardware_manufacturer,
  device_os_model AS device_hardware_model_name,
  CAST(NULL AS VARCHAR) AS device_hardware_marketing_name,
  lower(device_os_model) AS device_hardware_os_model,
  x.language AS device_language_firebase_value,
  l.alpha_2 AS device_language_iso_language_alpha_2,
  r.alpha_2 AS device_language_iso_country_alpha_2,
  {OFFSET_TEXT} AS device_time_zone_offset,
  CAST(NULL AS VARCHAR) AS traffic_source_name, traffic_medium AS traffic_source_medium,
  CAST(NULL AS VARCHAR) AS traffic_source_source,
  price AS users_ltv_revenue, 'EUR' AS users_ltv_currency,
  lower('1:' || upper(app_id)) AS other_ids_firebase_app_id,
  lower('stream-' || platform) AS other_ids_stream_id,
  lower(nullif(advertising_id, '')) AS other_ids_advertising_id,
  {zone_dates('event_dates', 'event_ts')},
  {zone_dates('install_dates', 'install_ts')},
  duplicates_cnt
  FROM survivor x {GEO_JOINS}
)"""

PARAMETERS = [f"event_parameters_{n}" for n in (
    "view_name_string", "view_type_string", "parent_view_name_string", "parent_view_type_string",
    "button_name_string", "button_extra_string", "domain_string", "path_string",
    "status_code_int", "extra_string")]
DIMS = [
    "app_id", "reverse_app_id", "event_name", "platform", "appstore",
    *[f"app_version_{f}" for f in VERSION], *[f"platform_version_{f}" for f in VERSION],
    "user_properties_ob_ui_dark_mode_string", "user_properties_ob_ui_font_size_string",
    *PARAMETERS,
    "geo_country_firebase_value", "geo_iso_country_name", "geo_iso_country_alpha_2",
    "geo_continent", "geo_subcontinent",
    *[f"device_hardware_{f}" for f in ("type", "manufacturer", "model_name", "marketing_name",
                                       "os_model")],
    *[f"device_language_{f}" for f in ("firebase_value", "iso_language_alpha_2",
                                       "iso_country_alpha_2")],
    "device_time_zone_offset",
    *[f"traffic_source_{f}" for f in ("name", "medium", "source")],
]
FORCED = ("event_parameters_view_type_string", "event_parameters_parent_view_type_string")
ZONE_COLUMNS = [f"{p}_{offset(n)}" for p in ("event_dates", "install_dates") for n in OFFSETS]
DATE_COLUMNS = ["event_date", *ZONE_COLUMNS]
RAW_OUT = "* REPLACE (epoch_us(event_ts) AS event_ts, epoch_us(install_ts) AS install_ts, " + \
    ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in DATE_COLUMNS) + ")"


def dims(forced: bool = False, table: str = "", prefix: str = "") -> str:
    return ", ".join(
        (f"'ob-forced-null' AS {prefix}{d}" if forced and d in FORCED
         else f"{table}{d} AS {prefix}{d}") for d in DIMS)


METRICS = """CAST(sum(event_parameters_quantity_int) AS BIGINT) AS cm_quantity_int_sum,
  max(event_parameters_price_double) AS cm_price_double_max,
  avg(event_parameters_quantity_int) AS cm_quantity_int_avg,
  min(event_parameters_quantity_int) AS least_quantity"""


def rollup(forced: bool) -> str:
    return f"""SELECT event_date, {age_group('install_age')} AS install_age_group, {dims(forced)},
  count(*) AS cnt, count(DISTINCT user_pseudo_id) AS users, {METRICS}
  FROM raw {'WHERE ' + UI if forced else ''} GROUP BY ALL"""


ROLLUPS = f"{RAW}, events_rollup AS ({rollup(False)}), forced AS ({rollup(True)})"
TEXT_DAY = "CAST(event_date AS VARCHAR) AS event_date"
DAY_OUT = f"* REPLACE ({TEXT_DAY})"

# Columns of the event table that are part of a struct come whole from one row.
SCALARS = ("event_ts", "event_date", "install_ts", "install_age", "user_pseudo_id", "app_id",
           "reverse_app_id", "event_name", "platform", "appstore", "device_time_zone_offset")
STRUCT_FIELDS = [
    *[f"app_version_{f}" for f in VERSION], *[f"platform_version_{f}" for f in VERSION],
    "user_properties_ob_ui_dark_mode_string", "user_properties_ob_ui_font_size_string",
    *PARAMETERS, "event_parameters_quantity_int", "event_parameters_price_double",
    "user_properties_raw", "event_parameters_raw",
    *[f"geo_{f}" for f in ("city", "country_firebase_value", "iso_country_name",
                           "iso_country_alpha_2", "continent", "subcontinent", "region",
                           "metro")],
    *[d for d in DIMS if d.startswith(("device_hardware_", "device_language_",
                                       "traffic_source_"))],
    "users_ltv_revenue", "users_ltv_currency", "other_ids_firebase_app_id",
    "other_ids_stream_id", "other_ids_advertising_id", *ZONE_COLUMNS,
]


def installs(start: str, end: str, lookback: int, custom: str = "attributed_first_open") -> str:
    """The chain of outer joins, each against the any-event row's user."""
    first = ("QUALIFY row_number() OVER (PARTITION BY user_pseudo_id ORDER BY event_ts) = 1")
    scope = f"event_date BETWEEN DATE '{start}' - {lookback} AND DATE '{end}'"
    near = f"{scope} AND event_ts BETWEEN install_ts AND install_ts + INTERVAL 24 HOUR"

    def kind(name: str) -> str:
        return f"SELECT * FROM raw WHERE event_name = '{name}' AND {near} {first}"

    scalars = ", ".join(f"coalesce(c.{s}, o.{s}, f.{s}, a.{s}) AS {s}" for s in SCALARS)
    fields = ", ".join(
        f"CASE WHEN c.event_ts IS NOT NULL THEN c.{s} WHEN o.event_ts IS NOT NULL THEN o.{s} "
        f"WHEN f.event_ts IS NOT NULL THEN f.{s} ELSE a.{s} END AS {s}" for s in STRUCT_FIELDS)
    return f"""
c AS ({kind(custom)}), o AS ({kind('ob_first_open')}),
f AS ({kind('first_open')}), a AS (SELECT * FROM raw WHERE {near} {first}),
known AS (SELECT user_pseudo_id, user_id FROM raw WHERE user_id IS NOT NULL AND {scope} {first}),
picked AS (
  SELECT {scalars}, known.user_id AS user_id, {fields}
  FROM a FULL JOIN f ON a.user_pseudo_id = f.user_pseudo_id
  FULL JOIN o ON a.user_pseudo_id = o.user_pseudo_id
  FULL JOIN c ON a.user_pseudo_id = c.user_pseudo_id
  LEFT JOIN known ON coalesce(a.user_pseudo_id, f.user_pseudo_id, o.user_pseudo_id,
    c.user_pseudo_id) = known.user_pseudo_id
),
installs_raw AS (
  SELECT * FROM picked WHERE event_date BETWEEN DATE '{start}' AND DATE '{end}' {first}
)"""


INSTALLS = f"{RAW}, {installs('2023-12-01', '2024-02-06', 0)}"
INSTALLS_ROLLUP = f"""SELECT event_date, CAST(install_ts AS DATE) AS install_date, install_age,
  {dims()}, count(*) AS cnt, count(DISTINCT user_pseudo_id) AS users
  FROM installs_raw GROUP BY ALL"""


def cohort(forced: bool) -> str:
    return f"""SELECT e.event_date AS event_date, {dims(forced, 'e.')},
  e.install_age AS install_age, CAST(i.install_ts AS DATE) AS install_date,
  {dims(forced, 'i.', 'install_')},
  count(*) AS cnt, count(DISTINCT e.user_pseudo_id) AS users,
  {METRICS.replace('(event_parameters', '(e.event_parameters')}
  FROM raw e LEFT JOIN installs_raw i ON e.user_pseudo_id = i.user_pseudo_id
  WHERE i.event_date >= DATE '2020-01-01' {'AND e.' + UI if forced else ''} GROUP BY ALL"""


COHORT_OUT = (f"* REPLACE ({TEXT_DAY}, CAST(install_date AS VARCHAR) AS install_date)")

UNITY = ", ".join(
    (f"CAST({name} AS {'VARCHAR' if kind == 'string' else kind.upper()})"
     if name in ("unity_version", "processor_count", "processor_frequency_mhz")
     else f"CAST(NULL AS {'VARCHAR' if kind == 'string' else kind.upper()})")
    + f" AS {{p}}_{name}" for name, kind, _ in fv.UNITY_METADATA)
NO_TEXT = "CAST(NULL AS VARCHAR)"
CRASH_PLATFORM = ("CASE WHEN table_suffix LIKE '%ANDROID%' THEN 'ANDROID' "
                  "WHEN table_suffix LIKE '%IOS%' THEN 'IOS' ELSE 'UNKNOWN' END")
def one_record(when: str, record: str) -> str:
    return f"CASE WHEN {when} THEN CAST(to_json([{record}]) AS VARCHAR) ELSE '[]' END"


CRASH_ENTRIES = "CAST(to_json(list_filter([" + ", ".join(
    f"CASE WHEN {column} IS NOT NULL THEN {{'key': '{key}', 'value': {column}}} END" for key, column in (
        ("fb_user_pseudo_id", "key_pseudo_id"), ("app_user_id", "key_user_id"), ("call_state", "call_state"))) \
    + "], lambda x: x IS NOT NULL)) AS VARCHAR)"
CRASH_LISTS = {
    "logs": one_record("source_id % 2 = 0", "{'timestamp': epoch_us(event_ts), 'message': 'log ' || event_id}"),
    "breadcrumbs": one_record("source_id % 3 = 0", "{'timestamp': epoch_us(received_ts), 'name': 'crumb' || variant_id, "
                              "'params': [{'key': 'id', 'value': event_id}]}"),
    "exceptions": one_record("error_type = 'NON_FATAL'", "{'type': 'Broken', 'exception_message': 'broke ' || event_id, "
                             "'nested': false, 'title': NULL, 'subtitle': NULL, 'blamed': true}"),
    "errors": one_record("error_type = 'ANR'", "{'queue': 'main', 'code': source_id % 7, 'title': 'slow', "
                         "'subtitle': NULL, 'blamed': false}"),
    "threads": one_record("error_type = 'FATAL'", "{'crashed': true, 'thread_name': 'thread' || variant_id, "
                          "'queue_name': NULL, 'title': NULL, 'subtitle': NULL, 'blamed': true}"),
}
BLAME = f"""source_id % 100 AS blame_frame_line, 'file' || variant_id AS blame_frame_file,
  {NO_TEXT} AS blame_frame_symbol, 'app' AS blame_frame_library, 'DEVELOPER' AS blame_frame_owner,
  source_id % 2 = 1 AS blame_frame_blamed"""
CRASH_RAW = f"""
crash_export AS ({CRASHES}),
crash_survivor AS (
  SELECT *, count(*) OVER (PARTITION BY {CRASH_KEYS}) AS duplicates_cnt FROM crash_export
  QUALIFY row_number() OVER (PARTITION BY {CRASH_KEYS} ORDER BY received_ts) = 1
),
crash_raw AS (
  SELECT event_ts, CAST(event_ts AS DATE) AS event_date, received_ts,
  installation_uuid AS crashlytics_user_pseudo_id,
  key_pseudo_id AS firebase_analytics_user_pseudo_id,
  coalesce(report_user_id, key_user_id) AS user_id, app_id,
  {reverse_id('app_id')} AS reverse_app_id, event_id, {CRASH_PLATFORM} AS platform,
  'issue' || variant_id AS issue_id, {NO_TEXT} AS issue_title, {NO_TEXT} AS issue_subtitle,
  variant_id AS issue_variant_id, error_type, process_state,
  'PORTRAIT' AS orientation_app, {NO_TEXT} AS orientation_device,
  {version_columns('app_version', 'app_version', 'app_version',
                   'variant_id AS app_version_build_no,')},
  {version_columns('platform_version', 'os_version', 'os_version',
                   f'{NO_TEXT} AS platform_version_name,')},
  'UNMODIFIED' AS jailbroken_state, lower(device_type) AS device_hardware_type,
  lower(device_brand) AS device_hardware_manufacturer,
  lower(device_os_model) AS device_hardware_os_model, 'arm64' AS device_hardware_architecture,
  call_state AS custom_keys_call_state_string,
  source_id AS memory_used_bytes, CAST(7 AS BIGINT) AS memory_free_bytes,
  source_id AS storage_used_bytes, CAST(9 AS BIGINT) AS storage_free_bytes,
  {NO_TEXT} AS user_name, {NO_TEXT} AS user_email, '18.2' AS crashlytics_sdk_version_string,
  {UNITY.format(p='unity_metadata')}, {CRASH_ENTRIES} AS custom_keys_raw, {BLAME},
  {CRASH_LISTS['logs']} AS logs, {CRASH_LISTS['breadcrumbs']} AS breadcrumbs,
  {CRASH_LISTS['exceptions']} AS android_exceptions, {CRASH_LISTS['errors']} AS ios_non_fatal,
  {CRASH_LISTS['threads']} AS threads, duplicates_cnt
  FROM crash_survivor
)"""
CRASH_DIMS = [
    "app_id", "reverse_app_id", "issue_id", "issue_title", "issue_subtitle", "issue_variant_id",
    "platform", "error_type", "process_state", "orientation_app", "orientation_device",
    "app_version_build_no", *[f"app_version_{f}" for f in VERSION],
    "platform_version_name", *[f"platform_version_{f}" for f in VERSION],
    "jailbroken_state",
    *[f"device_hardware_{f}" for f in ("type", "manufacturer", "os_model", "architecture")],
    "custom_keys_call_state_string",
]
CRASH_ROLLUP = f"""SELECT event_date, {', '.join(CRASH_DIMS)}, count(*) AS cnt,
  count(DISTINCT crashlytics_user_pseudo_id) AS users FROM crash_raw GROUP BY ALL"""

HEALTH_KEYS = ("event_date", "platform", "app_id", "reverse_app_id", "app_version_join_value",
               "platform_version_join_value", "device_hardware_type",
               "device_hardware_manufacturer", "device_hardware_os_model")
KEYS = ", ".join(HEALTH_KEYS)


def conditional(measures: dict[str, str], minis=("cnt", "users")) -> str:
    return ", ".join(
        f"CAST(sum(CASE WHEN {condition} THEN {mini} ELSE 0 END) AS BIGINT) AS {name}_{mini}"
        for name, condition in measures.items() for mini in minis)


USAGE = {name: f"event_name = '{name}'" for name in (
    "user_engagement", "ob_app_foreground", "ob_app_background", "app_update", "ob_app_update")}
USAGE |= {"errors": "event_name LIKE 'error_%'", "ob_errors": "event_name LIKE 'ob_error_%'"}
FATAL = "error_type = 'FATAL'"
CRASH = {
    "crashlytics_all_errors": "TRUE",
    "fatal_crashes": FATAL,
    "fatal_foreground_crashes": f"{FATAL} AND process_state = 'FOREGROUND'",
    "fatal_background_crashes": f"{FATAL} AND process_state = 'BACKGROUND'",
}
VIEW_ZERO = {"view_zero": "event_name = 'ui_view_shown' AND "
                          "event_parameters_view_name_string = 'view0'"}
IN_CALLS = {"crashes_in_calls": f"{FATAL} AND custom_keys_call_state_string = 'duringCall'"}
ENGAGED = {"engaged_quantity": "event_name = 'user_engagement'"}
USAGE_SUMS = f"{conditional(USAGE)}, {conditional(ENGAGED, ('cm_quantity_int_sum',))}"
USAGE_ROWS = ("event_name IN ('user_engagement', 'ob_app_foreground', 'ob_app_background', "
              "'app_update', 'ob_app_update') OR event_name LIKE 'error_%' "
              "OR event_name LIKE 'ob_error_%'")
MEASURES = [f"{n}_{m}" for n in (*USAGE, *CRASH, *VIEW_ZERO) for m in ("cnt", "users")]
MEASURES += ["engaged_quantity_cm_quantity_int_sum", "crashes_in_calls_cnt"]


def same_keys(table: str) -> str:
    return " AND ".join(f"an.{k} = {table}.{k}" for k in HEALTH_KEYS)


HEALTH_INPUTS = f"""{INSTALLS}, {CRASH_RAW},
events_rollup AS ({rollup(False)}), forced AS ({rollup(True)}),
installs_rollup AS ({INSTALLS_ROLLUP}), crash_rollup AS ({CRASH_ROLLUP}),
an AS (SELECT {KEYS}, {USAGE_SUMS} FROM events_rollup WHERE {USAGE_ROWS} GROUP BY ALL),
fo AS (SELECT {KEYS}, {conditional(VIEW_ZERO)} FROM forced WHERE event_name = 'ui_view_shown'
  GROUP BY ALL),
ins AS (SELECT {KEYS}, CAST(sum(users) AS BIGINT) AS installs FROM installs_rollup GROUP BY ALL),
cr AS (SELECT {KEYS}, {conditional(CRASH)}, {conditional(IN_CALLS, ('cnt',))} FROM crash_rollup
  GROUP BY ALL)"""
HEALTH = f"""{HEALTH_INPUTS},
joined AS (
  SELECT {', '.join(f'coalesce(an.{k}, fo.{k}, ins.{k}, cr.{k}) AS {k}' for k in HEALTH_KEYS)},
  installs, {', '.join(MEASURES)}
  FROM an FULL JOIN fo ON {same_keys('fo')} FULL JOIN ins ON {same_keys('ins')}
  FULL JOIN cr ON {same_keys('cr')}
)"""
# With merged keys: stack the inputs and group, NULL parts being equal.
HEALTH_MERGED = f"""{HEALTH_INPUTS},
joined AS (
  SELECT {KEYS}, {', '.join(f'CAST(max({m}) AS BIGINT) AS {m}' for m in ('installs', *MEASURES))}
  FROM (SELECT * FROM an UNION ALL BY NAME SELECT * FROM fo UNION ALL BY NAME
        SELECT * FROM ins UNION ALL BY NAME SELECT * FROM cr) GROUP BY ALL
)"""
HEALTH_OUT = f"""SELECT {TEXT_DAY}, platform, app_id, reverse_app_id,
  {record_columns('app_version', 'app_version_join_value')},
  {record_columns('platform_version', 'platform_version_join_value')},
  device_hardware_type, device_hardware_manufacturer, device_hardware_os_model,
  installs, {', '.join(MEASURES)} FROM joined"""

PROFILED = ["event_dates_minus_12", "event_dates_plus_12", "install_dates_minus_12",
            "install_dates_plus_12", *[d for d in DIMS if d != "reverse_app_id"]]


EXPORT_ROW = f"""epoch_us(event_ts) AS event_timestamp, epoch_us(install_ts) AS user_first_touch_timestamp,
  epoch_us(previous_ts) AS event_previous_timestamp, event_bundle_sequence_id, event_name, platform, user_pseudo_id,
  user_id, upper('stream-' || platform) AS stream_id, app_id AS app_info_id, app_version AS app_info_version,
  install_source AS app_info_install_source, '1:' || upper(app_id) AS app_info_firebase_app_id,
  device_type AS device_category, device_brand AS device_mobile_brand_name,
  device_os_model AS device_mobile_model_name, {NO_TEXT} AS device_mobile_marketing_name,
  device_os_model AS device_mobile_os_hardware_model, os_name AS device_operating_system,
  os_version AS device_operating_system_version, language AS device_language, advertising_id AS device_advertising_id,
  CAST(tz_offset_s AS BIGINT) AS device_time_zone_offset_seconds, city AS geo_city, country AS geo_country,
  'Europe' AS geo_continent, {NO_TEXT} AS geo_sub_continent, {NO_TEXT} AS geo_region, {NO_TEXT} AS geo_metro,
  {NO_TEXT} AS traffic_source_name, traffic_medium AS traffic_source_medium, {NO_TEXT} AS traffic_source_source,
  price AS user_ltv_revenue, 'EUR' AS user_ltv_currency, {EVENT_ENTRIES} AS event_params,
  {USER_ENTRIES} AS user_properties, table_suffix"""


def crash_export_row(unity: str) -> str:
    return f"""epoch_us(event_ts) AS event_timestamp, epoch_us(received_ts) AS received_timestamp, installation_uuid,
  event_id, variant_id, app_id AS bundle_identifier, 'issue' || variant_id AS issue_id, {NO_TEXT} AS issue_title,
  {NO_TEXT} AS issue_subtitle, error_type, process_state, 'PORTRAIT' AS app_orientation,
  {NO_TEXT} AS device_orientation, '18.2' AS crashlytics_sdk_version, app_version AS application_display_version,
  variant_id AS application_build_version, os_version AS operating_system_display_version,
  {NO_TEXT} AS operating_system_name, 'UNMODIFIED' AS operating_system_modification_state,
  device_type AS operating_system_device_type, device_brand AS device_manufacturer,
  device_os_model AS device_model, 'arm64' AS device_architecture, source_id AS memory_used,
  CAST(7 AS BIGINT) AS memory_free, source_id AS storage_used, CAST(9 AS BIGINT) AS storage_free,
  report_user_id AS user_id, {NO_TEXT} AS user_name, {NO_TEXT} AS user_email, {CRASH_ENTRIES} AS custom_keys,
  {BLAME}, {', '.join(f'{value} AS {column}' for column, value in CRASH_LISTS.items())}, {unity}, table_suffix"""


UNITY_GIVEN = ("unity_version", "processor_count", "processor_frequency_mhz")
UNITY_READ = ", ".join(
    f"CAST({column if column in UNITY_GIVEN else 'NULL'} AS {'VARCHAR' if kind == 'string' else kind.upper()}) "
    f"AS unity_metadata_{column}" for column, kind, filled in fv.UNITY_METADATA if filled)


def built() -> str:
    """Rows and two measures by day of every table of a build."""
    sources = {
        "events_raw": "raw", "crash_events_raw": "crash_raw", "events": "events_rollup", "events_forced_nulls": "forced",
        "crash_events": "crash_rollup", "installs": "installs_rollup", "events_wid": "wid",
        "events_wid_forced_nulls": "wid_forced", "installs_raw": "installs_raw", "app_health": "joined",
        "errors": "(SELECT * FROM events_rollup WHERE event_name LIKE 'error_%' OR event_name LIKE 'ob_error_%')",
        "ui": f"(SELECT * FROM events_rollup WHERE {UI} UNION ALL SELECT * FROM forced WHERE {UI})",
        "ui_wid": f"(SELECT * FROM wid WHERE {UI} UNION ALL SELECT * FROM wid_forced WHERE {UI})",
        "events_count": "(SELECT event_date, platform, user_id, count(*) AS user_engagement FROM raw "
                        "WHERE event_name = 'user_engagement' GROUP BY ALL)",
    }
    return f"""WITH {HEALTH}, wid AS ({cohort(False)}), wid_forced AS ({cohort(True)}) """ + " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {TEXT_DAY}, count(*) AS n_rows, CAST({first} AS BIGINT) AS first_measure, "
        f"CAST({second} AS BIGINT) AS second_measure FROM {sources[table]} AS t GROUP BY t.event_date"
        for table, (first, second) in BUILT.items())


def with_export(select: str, more: str = "") -> str:
    return f"WITH export AS ({EXPORT}){more} {select}"


def trailing_counts(kept: str) -> str:
    start, end = TRAILING.analytics(extend=2).start, TRAILING.analytics().end
    settled = f"DATE '{TRAILING.run_date}' - 5"
    days = f"event_date BETWEEN DATE '{start}' AND DATE '{end}' AND event_date <= {settled}"
    return f"""{RAW},
kept AS (SELECT event_date, {kept} AS kept_cnt FROM raw WHERE {days} GROUP BY 1),
source AS (SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS source_cnt FROM export
  WHERE CAST(event_ts AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'
  AND CAST(event_ts AS DATE) <= {settled} GROUP BY 1),
counts AS (SELECT kept.event_date AS event_date, kept_cnt, source_cnt
  FROM kept LEFT JOIN source ON kept.event_date = source.event_date)"""


def shard_window() -> str:
    window = TRAILING.shards()
    return (f"replace(table_suffix, 'intraday_', '') BETWEEN '{window.start:%Y%m%d}' "
            f"AND '{window.end:%Y%m%d}'")


# Columns of the event table that are no record and no list.
FLAT = (*SCALARS, "user_id", "duplicates_cnt")


def oracle() -> dict[str, str]:
    window, week, crash = TRAILING.analytics(), FIRST_WEEK.analytics(), TRAILING.crash()
    exact = ", ".join(f"'{n}'" for n in NAMES if not n.lower().startswith("like "))
    likes = " OR ".join(f"event_name {n}" for n in NAMES if n.lower().startswith("like "))
    rows = "SELECT event_id, copy_no,"
    seq = "SELECT event_bundle_sequence_id, table_suffix,"
    return {
        "version_parts": with_export(
            f"{rows} {version_columns('app', 'app_version', 'app_version')}, "
            f"{version_columns('os', 'os_version', OS_BARE)} FROM export"),
        "version_record": with_export(
            f"{rows} join_value, {record_columns('version', 'join_value')} FROM (SELECT *, "
            f"{join_value('app_version')} AS join_value FROM export)"),
        "install_age": with_export(
            f"{seq} epoch_us(event_ts) AS event_ts, epoch_us(install_ts) AS install_ts, "
            f"{AGE} AS install_age FROM export"),
        "age_groups": with_export(
            f"SELECT {age_group('age')} AS install_age_group, count(*) AS cnt, "
            f"min(age) AS youngest, max(age) AS oldest FROM (SELECT {AGE} AS age FROM export) "
            "GROUP BY 1"),
        "wall_clock_age": with_export(
            f"{seq} {WALL_AGE} AS age, "
            + ", ".join(f"{WALL_AGE} AS ages_{offset(n)}" for n in OFFSETS) + " FROM export"),
        "tz_dates": with_export(f"{seq} " + ", ".join(
            f"CAST(CAST(event_ts + INTERVAL ({n}) HOUR AS DATE) AS VARCHAR) AS on_{offset(n)}"
            for n in OFFSETS) + " FROM export"),
        "tz_offset": with_export(
            f"{rows} tz_offset_s, {OFFSET_TEXT} AS device_time_zone_offset FROM export"),
        "reverse_id": with_export(
            f"{rows} app_id, {reverse_id('app_id')} AS reverse_app_id FROM export"),
        "null_if_empty": with_export(
            f"{rows} lower(CASE WHEN length(advertising_id) > 0 THEN advertising_id END) "
            "AS advertising_id FROM export"),
        "crash_shard_scan":
            f"WITH crash_export AS ({CRASHES}) SELECT {crash_export_row(UNITY_READ)} FROM crash_export",
        "crash_trailing_window":
            f"WITH crash_export AS ({CRASHES}), kept AS (SELECT * FROM crash_export "
            f"WHERE event_ts BETWEEN DATE '{crash.start}' AND DATE '{crash.end}' "
            f"QUALIFY row_number() OVER (PARTITION BY {CRASH_KEYS} ORDER BY received_ts) = 1) "
            "SELECT CAST(CAST(event_ts AS DATE) AS VARCHAR) AS event_date, "
            f"{CRASH_PLATFORM} AS platform, count(*) AS cnt FROM kept GROUP BY 1, 2",
        "seed_scan": f"WITH export AS ({EXPORT}), {SEEDS} SELECT event_id, copy_no, "
            "g.name AS iso_country_name, l.alpha_2 AS iso_language_alpha_2, "
            f"r.alpha_2 AS iso_language_country_alpha_2 FROM export x {GEO_JOINS}",
        "platform_expression": f"WITH {RAW} SELECT CASE WHEN app_version LIKE '1%' THEN 'one' "
            "ELSE lower(platform) END AS platform, count(*) AS cnt FROM survivor GROUP BY 1",
        "whole_build": built(),
        "platform_from_suffix":
            f"WITH crash_export AS ({CRASHES}) SELECT event_id, copy_no, table_suffix, "
            f"{CRASH_PLATFORM} AS platform FROM crash_export",
        "name_list_filter": with_export(
            f"SELECT event_name, count(*) FILTER (WHERE event_name IN ({exact}) OR {likes}) "
            "AS listed, count(*) AS all_rows FROM export GROUP BY 1"),
        "kv_extract": with_export(
            f"{seq} event_name, {EVENT_PARAMETERS}, {USER_PROPERTIES} FROM export"),
        "kv_extract_crash":
            f"WITH crash_export AS ({CRASHES}) SELECT event_id, epoch_us(received_ts) "
            "AS received_timestamp, report_user_id AS id, key_pseudo_id AS pseudo_id, "
            "coalesce(report_user_id, key_user_id) AS user_id, "
            "call_state AS custom_keys_call_state_string, "
            "'noCustomKeysDefined' AS no_keys_empty FROM crash_export",
        "struct_pack_unpack": f"""WITH {RAW} SELECT epoch_us(event_ts) AS event_ts,
            app_id, {', '.join(f'app_version_{f}' for f in VERSION)},
            geo_country_firebase_value, geo_iso_country_name, geo_iso_country_alpha_2,
            geo_continent, geo_subcontinent, 'ob-forced-null' AS device_hardware_type,
            device_hardware_manufacturer, device_hardware_model_name,
            device_hardware_marketing_name, device_hardware_os_model FROM raw""",
        "schema_align":
            f"WITH crash_export AS ({CRASHES}) SELECT event_id, epoch_us(received_ts) "
            f"AS received_timestamp, {UNITY.format(p='unity')} FROM crash_export",
        "geo_lookup": with_export(
            "SELECT event_id, copy_no, country, g.name AS iso_country_name, "
            "g.alpha_2 AS iso_country_alpha_2 FROM export x LEFT JOIN country g "
            "ON lower(x.country) = lower(g.firebase_name)".replace(" country,", " x.country,"),
            f", {SEEDS}"),
        "language_lookup": with_export(
            "SELECT event_id, copy_no, x.language AS language, "
            "l.alpha_2 AS iso_language_alpha_2, r.alpha_2 AS iso_language_country_alpha_2 "
            f"FROM export x {GEO_JOINS}", f", {SEEDS}"),
        "dedup_events": with_export(
            f"""SELECT {EXPORT_ROW}, count(*) OVER (PARTITION BY {COPY_KEYS}) AS duplicates_cnt FROM export
            QUALIFY row_number() OVER (PARTITION BY {COPY_KEYS} ORDER BY table_suffix) = 1"""),
        "dedup_crashes": f"""WITH crash_export AS ({CRASHES}) SELECT
            {crash_export_row(', '.join(f'{c} AS unity_metadata_{c}' for c in UNITY_GIVEN))},
            count(*) OVER (PARTITION BY {CRASH_KEYS}) AS duplicates_cnt FROM crash_export
            QUALIFY row_number() OVER (PARTITION BY {CRASH_KEYS} ORDER BY received_ts) = 1""",
        "window_filter": with_export(
            f"""{seq} CAST(CAST(event_ts AS DATE) AS VARCHAR) AS event_date,
            event_ts BETWEEN TIMESTAMP '{window.start}' AND TIMESTAMP '{window.end}'
            AS in_instants FROM export
            WHERE CAST(event_ts AS DATE) BETWEEN DATE '{window.start}' AND DATE '{window.end}'"""),
        "shard_filter": with_export(
            f"SELECT table_suffix, count(*) AS cnt FROM export WHERE {shard_window()} GROUP BY 1"),
        "shard_scan": with_export(
            "SELECT table_suffix, count(*) AS cnt, count(DISTINCT user_pseudo_id) AS users, "
            f"epoch_us(min(event_ts)) AS first_event FROM export WHERE {shard_window()} "
            "GROUP BY 1"),
        "incremental_overwrite": f"""WITH {RAW} SELECT CAST(event_date AS VARCHAR) AS event_date,
            platform, count(*) AS cnt, CASE WHEN event_date BETWEEN DATE '{window.start}'
            AND DATE '{window.end}' THEN 'second' ELSE 'first' END AS written_by
            FROM raw GROUP BY raw.event_date, platform""",
        "atomic_refresh": f"""WITH {RAW} SELECT CAST(event_date AS VARCHAR) AS event_date,
            platform, count(*) AS cnt, CASE WHEN event_date BETWEEN DATE '{window.start}'
            AND DATE '{window.end}' THEN 'second' ELSE 'first' END AS written_by
            FROM raw GROUP BY raw.event_date, platform""",
        "clustered_write": f"""WITH {RAW} SELECT CAST(event_date AS VARCHAR) AS event_date,
            count(*) AS cnt, 0 AS overlapping, min(event_name) AS first_name,
            max(event_name) AS last_name FROM raw GROUP BY raw.event_date""",
        "events_raw": f"WITH {RAW} SELECT {RAW_OUT} FROM raw",
        "events_rollup": f"WITH {ROLLUPS} SELECT {DAY_OUT} FROM events_rollup",
        "metric_rollup": f"""WITH {RAW}, g AS ({rollup(False)})
            SELECT CAST(event_date AS VARCHAR) AS event_date, event_name, platform,
            CAST(sum(cm_quantity_int_sum) AS BIGINT) AS quantity,
            min(least_quantity) AS least_quantity, max(cm_price_double_max) AS best_price,
            max(cm_quantity_int_avg) AS largest_average FROM g
            GROUP BY g.event_date, event_name, platform""",
        "forced_null_rollup": f"WITH {ROLLUPS} SELECT {DAY_OUT} FROM forced",
        "ui_union": f"WITH {ROLLUPS} SELECT {DAY_OUT} FROM (SELECT * FROM events_rollup WHERE {UI} "
                    f"UNION ALL SELECT * FROM forced WHERE {UI})",
        "error_events": f"WITH {ROLLUPS} SELECT {DAY_OUT} FROM events_rollup WHERE "
                        "event_name LIKE 'error_%' OR event_name LIKE 'ob_error_%'",
        "events_count": f"""WITH {RAW} SELECT CAST(event_date AS VARCHAR) AS event_date, platform,
            user_id, count(*) AS user_engagement FROM raw WHERE event_name = 'user_engagement'
            GROUP BY raw.event_date, platform, user_id""",
        "install_first_open": f"WITH {INSTALLS} SELECT {RAW_OUT} FROM installs_raw",
        "install_trailing_window":
            f"WITH {RAW}, {installs(str(week.start), str(week.end), 2)} "
            f"SELECT {RAW_OUT} FROM installs_raw",
        "install_user_id":
            f"WITH {INSTALLS} SELECT user_pseudo_id, user_id, event_name FROM installs_raw",
        "null_user_filter": f"""WITH {RAW} SELECT user_id, count(*) AS cnt,
            epoch_us(min(event_ts)) AS first_ts FROM raw WHERE user_id IS NOT NULL
            GROUP BY user_id""",
        "installs_rollup":
            f"WITH {INSTALLS}, g AS ({INSTALLS_ROLLUP}) SELECT {COHORT_OUT} FROM g",
        "cohort_rollup": f"WITH {INSTALLS}, g AS ({cohort(False)}) SELECT {COHORT_OUT} FROM g",
        "cohort_forced_null": f"WITH {INSTALLS}, g AS ({cohort(True)}) SELECT {COHORT_OUT} FROM g",
        "ui_union_cohort": f"""WITH {INSTALLS}, g AS ({cohort(False)}), h AS ({cohort(True)})
            SELECT {COHORT_OUT} FROM (SELECT * FROM g WHERE {UI} UNION ALL
            SELECT * FROM h WHERE {UI})""",
        "crash_events_raw": f"""WITH {CRASH_RAW} SELECT * REPLACE (epoch_us(event_ts) AS event_ts,
            epoch_us(received_ts) AS received_ts, {TEXT_DAY}) FROM crash_raw""",
        "crash_rollup": f"WITH {CRASH_RAW}, g AS ({CRASH_ROLLUP}) SELECT {DAY_OUT} FROM g",
        "health_measures": f"""WITH {ROLLUPS} SELECT {DAY_OUT} FROM (SELECT {KEYS}, {USAGE_SUMS}
            FROM events_rollup GROUP BY ALL)""",
        "health_join": f"WITH {HEALTH} SELECT {DAY_OUT} FROM joined",
        "app_health_table": f"WITH {HEALTH} {HEALTH_OUT}",
        "app_health_merged_keys": f"WITH {HEALTH_MERGED} {HEALTH_OUT}",
        "install_without_custom_event":
            f"WITH {RAW}, {installs('2023-12-01', '2024-02-06', 0, custom='')} SELECT {RAW_OUT} FROM installs_raw",
        "health_without_forced_measures":
            "WITH " + HEALTH.replace("FROM forced WHERE event_name = 'ui_view_shown'", "FROM forced WHERE false")
            + f" SELECT * EXCLUDE (view_zero_cnt, view_zero_users) REPLACE ({TEXT_DAY}) FROM joined",
        "day_filter_required": f"""WITH {RAW} SELECT CAST(event_date AS VARCHAR) AS event_date, count(*) AS cnt,
            true AS refused FROM raw WHERE event_date BETWEEN DATE '{week.start}' AND DATE '{week.end}'
            GROUP BY raw.event_date""",
        "commented_columns": f"WITH {RAW} " + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c if c in FLAT else '*'}) AS n_values, "
            f"'{text.replace(chr(39), chr(39) * 2)}' AS description FROM raw"
            for c, text in EVENTS_RAW.items() if "." not in c),
        "version_kinds": with_export(
            f"{rows} {part('app_version', 1)} AS as_major, {part('app_version', 2)} AS as_minor, "
            f"{part('app_version', 3)} AS as_bugfix, {major_minor('app_version')} AS as_major_minor, "
            f"{clean('app_version')} AS as_major_minor_bugfix, {normalized('app_version')} AS as_normalized, "
            "true AS refused FROM export"),
        "mandatory_settings": f"WITH {RAW} SELECT platform, count(*) AS cnt, 4 AS refused FROM raw GROUP BY 1",
        "dimension_cardinality": f"WITH {RAW} " + " UNION ALL ".join(
            f"SELECT '{d}' AS dim_name, count(DISTINCT {d}) AS dist_cnt FROM raw "
            f"WHERE event_date = DATE '{PROFILE_DAY}'" for d in PROFILED),
        "dimensions_over_limit": f"WITH {RAW}, "
            f"week AS (SELECT * FROM raw WHERE event_date BETWEEN DATE '{week.start}' AND DATE '{week.end}') "
            + " UNION ALL ".join(f"SELECT '{d}' AS dim_name, count(DISTINCT {d}) > {limit} AS over, {limit} AS value_limit "
                                 "FROM week" for d in PROFILED for limit in OVER),
        "health_key_matches": f"WITH {HEALTH_INPUTS} " + " UNION ALL ".join(
            f"SELECT '{source}' AS source, CAST(x.event_date AS VARCHAR) AS event_date, count(*) AS n_keys, "
            f"count(*) FILTER (WHERE {' OR '.join(f'x.{k} IS NULL' for k in HEALTH_KEYS)}) AS n_incomplete, "
            f"count(*) FILTER (WHERE {' AND '.join(f'x.{k} IS NOT NULL' for k in HEALTH_KEYS)} AND an.platform IS NULL) "
            f"AS n_unmatched FROM {table} x LEFT JOIN an ON {' AND '.join(f'an.{k} = x.{k}' for k in HEALTH_KEYS)} "
            "GROUP BY x.event_date" for source, table in (
                ("analytics", "an"), ("analytics_forced_nulls", "fo"), ("installs", "ins"), ("crashlytics", "cr"))),
        "raw_day_counts":
            f"WITH {trailing_counts('CAST(sum(duplicates_cnt) AS BIGINT)')} "
            f"SELECT {DAY_OUT} FROM counts",
        "raw_reconciliation": f"WITH {trailing_counts('count(*)')} "
                              f"SELECT {DAY_OUT} FROM counts WHERE kept_cnt <> source_cnt",
        "install_uniqueness": f"""WITH {INSTALLS},
            twice AS (SELECT * FROM installs_raw UNION ALL SELECT * FROM installs_raw),
            counts AS (SELECT count(DISTINCT user_pseudo_id) AS dist_cnt, count(*) AS cnt
            FROM twice WHERE event_date BETWEEN DATE '{week.start}' - 2 AND DATE '{week.end}'
            AND event_date >= DATE '2023-12-01' AND user_pseudo_id IS NOT NULL)
            SELECT * FROM counts WHERE dist_cnt < cnt""",
    }
