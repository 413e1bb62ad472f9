"""Names, lists and limits that results depend on.

Everything here is data, not logic. Changing an entry changes the output.
"""

# Marks a dimension that was collapsed on purpose, as opposed to a real NULL.
SENTINEL = "ob-forced-null"

# Events that describe the user interface.
UI_EVENTS = (
    "ob_ui_view_shown",
    "ob_ui_button_tapped",
    "ui_view_shown",
    "ui_button_tapped",
)

# LIKE patterns of error events; "_" is a one-character wildcard on purpose.
ERROR_PATTERNS = ("error_%", "ob_error_%")

ENGAGEMENT_EVENT = "user_engagement"

# Events that can stand for an install, after the configured one.
SDK_INSTALL_EVENT = "ob_first_open"
DEFAULT_INSTALL_EVENT = "first_open"

# Dimensions kept by every analytics rollup.
EVENT_DIMENSIONS = (
    "app_id",
    "reverse_app_id",
    "event_name",
    "platform",
    "appstore",
    "app_version",
    "platform_version",
    "user_properties",
    "event_parameters",
    "geo",
    "device_hardware",
    "device_language",
    "device_time_zone_offset",
    "traffic_source",
)

# Dimensions kept by the crash rollup.
CRASH_DIMENSIONS = (
    "app_id",
    "reverse_app_id",
    "issue",
    "platform",
    "error_type",
    "process_state",
    "orientation",
    "app_version",
    "platform_version",
    "jailbroken_state",
    "device_hardware",
    "custom_keys",
)

# Struct fields left out of rollups unless configured otherwise.
DEFAULT_EXCLUDED_DIMENSIONS = ("geo.city", "geo.metro", "geo.region")

# Grain of the health table: name in the health table, path in the rollups.
HEALTH_DIMENSIONS = {
    "event_date": "event_date",
    "platform": "platform",
    "app_id": "app_id",
    "reverse_app_id": "reverse_app_id",
    "app_version_join_value": "app_version.join_value",
    "platform_version_join_value": "platform_version.join_value",
    "device_hardware_type": "device_hardware.type",
    "device_hardware_manufacturer": "device_hardware.manufacturer",
    "device_hardware_os_model": "device_hardware.os_model",
}

# Rows that agree on these source columns are copies of one another.
EVENT_COPY_KEYS = (
    "user_pseudo_id",
    "event_bundle_sequence_id",
    "event_name",
    "event_timestamp",
    "event_previous_timestamp",
)
CRASH_COPY_KEYS = ("installation_uuid", "event_id", "variant_id")

# Crash keys that carry user ids.
CRASH_ANALYTICS_USER_KEY = "fb_user_pseudo_id"
CRASH_APP_USER_KEY = "app_user_id"
NO_CUSTOM_KEYS = "noCustomKeysDefined"

# Parameters extracted for every app.
BUILTIN_USER_PROPERTIES = (
    {"key_name": "ob_ui_dark_mode", "data_type": "string", "rollup_type": "dimension"},
    {"key_name": "ob_ui_font_size", "data_type": "string", "rollup_type": "dimension"},
)
# Text of the interface loses white space of any kind at both ends.
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
UI_TEXT = f"LOWER(TRIM(BOTH '{WHITE_SPACE}' FROM ##))"
BUILTIN_EVENT_PARAMETERS = (
    {"key_name": "view_name", "data_type": "string", "rollup_type": "dimension",
     "event_name_filter": UI_EVENTS, "extract_transformation": UI_TEXT},
    {"key_name": "view_type", "data_type": "string", "rollup_type": "alsoForceNullDimension",
     "force_null_dimension_event_name_filter": UI_EVENTS, "extract_transformation": UI_TEXT},
    {"key_name": "parent_view_name", "data_type": "string", "rollup_type": "dimension",
     "event_name_filter": UI_EVENTS, "extract_transformation": UI_TEXT},
    {"key_name": "parent_view_type", "data_type": "string", "rollup_type": "alsoForceNullDimension",
     "force_null_dimension_event_name_filter": UI_EVENTS, "extract_transformation": UI_TEXT},
    {"key_name": "button_name", "data_type": "string", "rollup_type": "dimension",
     "event_name_filter": UI_EVENTS, "extract_transformation": UI_TEXT},
    {"key_name": "button_extra", "data_type": "string", "rollup_type": "dimension",
     "event_name_filter": UI_EVENTS, "extract_transformation": UI_TEXT},
    {"key_name": "domain", "data_type": "string", "rollup_type": "dimension"},
    {"key_name": "path", "data_type": "string", "rollup_type": "dimension"},
    {"key_name": "status_code", "data_type": "int", "rollup_type": "dimension"},
    {"key_name": "extra", "data_type": "string", "rollup_type": "dimension"},
)

# Measures of the health table that every app gets.
BUILTIN_MEASURES = (
    {"name": "user_engagement", "event_name": "user_engagement"},
    {"name": "ob_app_foreground", "event_name": "ob_app_foreground"},
    {"name": "ob_app_background", "event_name": "ob_app_background"},
    {"name": "app_update", "event_name": "app_update"},
    {"name": "ob_app_update", "event_name": "ob_app_update"},
    {"name": "errors", "event_name": "LIKE 'error_%'"},
    {"name": "ob_errors", "event_name": "LIKE 'ob_error_%'"},
    {"name": "crashlytics_all_errors", "model": "crashlytics"},
    {"name": "fatal_crashes", "model": "crashlytics",
     "additional_filter": "error_type = 'FATAL'"},
    {"name": "fatal_foreground_crashes", "model": "crashlytics",
     "additional_filter": "error_type = 'FATAL' AND process_state = 'FOREGROUND'"},
    {"name": "fatal_background_crashes", "model": "crashlytics",
     "additional_filter": "error_type = 'FATAL' AND process_state = 'BACKGROUND'"},
)

# Engine metadata of a crash. Fields marked False exist in one kind of shard
# only and are always NULL in the output.
UNITY_METADATA = (
    ("unity_version", "string", True),
    ("debug_build", "boolean", True),
    ("processor_type", "string", True),
    ("processor_count", "bigint", True),
    ("processor_frequency", "bigint", False),
    ("system_memory_size", "bigint", False),
    ("graphics_memory_size", "bigint", False),
    ("graphics_device_id", "bigint", True),
    ("graphics_device_vendor_id", "bigint", True),
    ("graphics_device_name", "string", True),
    ("graphics_device_vendor", "string", True),
    ("graphics_device_version", "string", True),
    ("graphics_device_type", "string", True),
    ("graphics_shader_level", "bigint", True),
    ("graphics_render_target_count", "bigint", True),
    ("graphics_copy_texture_support", "string", True),
    ("graphics_max_texture_size", "bigint", True),
    ("screen_size", "string", False),
    ("screen_dpi", "double", False),
    ("screen_refresh_rate", "bigint", False),
    ("processor_frequency_mhz", "bigint", True),
    ("system_memory_size_mb", "bigint", True),
    ("graphics_memory_size_mb", "bigint", True),
    ("screen_size_px", "string", True),
    ("screen_refresh_rate_hz", "bigint", True),
    ("screen_resolution_dpi", "string", True),
)

# Windows and dates.
FULL_REFRESH_START = "2018-01-01"
INCREMENTAL_DAYS = 5
INSTALL_LOOKBACK_DAYS = 2
SHARD_LOOKBACK_DAYS = 1
SETTLING_DAYS = 5
FIRST_COHORT_DATE = "2020-01-01"
FIRST_UNIQUE_INSTALL_DATE = "2024-08-22"

# Version text: up to three leading numeric parts, six digits per part.
VERSION_PATTERN = r"^(\d+(?:\.\d+){0,2})"
VERSION_PART_DIGITS = 6
VERSION_RECORD_MIN_LENGTH = 13

# Install age groups: upper bound in days and label; the last one is the rest.
AGE_GROUP_ZERO = "Age 0"
AGE_GROUPS = ((6, "Age 1-6"), (30, "Age 7-30"))
AGE_GROUP_REST = "Age 31+"

# Hours from UTC for which calendar dates are kept.
ZONE_OFFSETS = tuple(n for n in range(-12, 13) if n != 0)

# Layout of the written tables.
EVENT_CLUSTER_KEYS = ("event_name", "platform", "app_id")
INSTALL_CLUSTER_KEYS = ("platform", "app_id")
INTRADAY_PREFIX = "intraday_"
SHARD_DATE_FORMAT = "%Y%m%d"

# Setting names used by existing project files -> field here. Any "PREFIX:" in
# front of the name is ignored.
SETTING_NAMES = {
    "FIREBASE_PROJECT_ID": "project",
    "FIREBASE_ANALYTICS_DATASET_ID": "analytics_source",
    "FIREBASE_ANALYTICS_EVENTS_TABLE_NAME": "analytics_shards",
    "FIREBASE_CRASHLYTICS_DATASET_ID": "crash_source",
    "FIREBASE_CRASHLYTICS_EVENTS_TABLE_NAME": "crash_shards",
    "FIREBASE_ANALYTICS_CUSTOM_INSTALL_EVENT": "custom_install_event",
    "CUSTOM_PLATFORM_PREPROCESSOR": "platform_expr",
    "FIREBASE_ANALYTICS_DEFAULT_INCREMENTAL_DAYS": "analytics_incremental_days",
    "FIREBASE_CRASHLYTICS_DEFAULT_INCREMENTAL_DAYS": "crash_incremental_days",
    "FIREBASE_ANALYTICS_FULL_REFRESH_START_DATE": "analytics_start",
    "FIREBASE_ANALYTICS_FULL_REFRESH_END_DATE": "analytics_end",
    "FIREBASE_CRASHLYTICS_FULL_REFRESH_START_DATE": "crash_start",
    "FIREBASE_CRASHLYTICS_FULL_REFRESH_END_DATE": "crash_end",
    "OB_DIMENSION_TO_EXCLUDE_IN_ROLLUPS": "excluded_dimensions",
    "CUSTOM_USER_PROPERTIES": "custom_user_properties",
    "CUSTOM_EVENT_PARAMETERS": "custom_event_parameters",
    "CUSTOM_CRASHLYTICS_KEYS": "custom_crash_keys",
    "CUSTOM_APP_HEALTH_MEASURES": "custom_measures",
}
