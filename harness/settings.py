"""One project configuration for all registered queries."""

from __future__ import annotations

import datetime as dt

from pulsegrain import Run, Settings

SETTINGS = Settings(
    project="example",
    analytics_source="analytics",
    crash_source="crashes",
    crash_shards="com_example*",
    analytics_start="1990-01-01",
    crash_start="1990-01-01",
    custom_install_event="attributed_first_open",
    custom_event_parameters=(
        {"key_name": "quantity", "data_type": "int", "rollup_type": "metric"},
        {"key_name": "quantity", "data_type": "int", "rollup_type": "metricOnly",
         "metric_rollup_transformation": "AVG(##)", "struct_field_name": "quantity_int"},
        {"key_name": "quantity", "data_type": "int", "rollup_type": "metricOnly",
         "metric_rollup_transformation": "MIN(##)", "struct_field_name": "quantity_int",
         "rollup_struct_field_name": "least_quantity"},
        {"key_name": "price", "data_type": "double", "rollup_type": "metric",
         "metric_rollup_transformation": "MAX(##)"},
    ),
    custom_crash_keys=({"key_name": "call_state", "data_type": "string",
                        "rollup_type": "dimension"},),
    custom_measures=(
        {"name": "view_zero", "model": "analytics_forced_nulls", "event_name": "ui_view_shown",
         "additional_filter": "event_parameters.view_name_string = 'view0'"},
        {"name": "engaged_quantity", "event_name": "user_engagement",
         "mini_measures": ("cm_quantity_int_sum",)},
        {"name": "crashes_in_calls", "model": "crashlytics", "mini_measures": ("cnt",),
         "additional_filter": "error_type = 'FATAL' AND "
                              "custom_keys.call_state_string = 'duringCall'"},
    ),
)
# Far after any event, so that the whole history is inside the window.
RUN_DATE = dt.date(2100, 1, 1)
WHOLE = Run(SETTINGS, RUN_DATE, incremental=False)
# A run in the middle of the data: the last days only.
TRAILING = Run(SETTINGS, dt.date(2024, 1, 20), incremental=True)
# A run whose window starts on the second day, when most users install.
FIRST_WEEK = Run(SETTINGS, dt.date(2024, 1, 7), incremental=True)
