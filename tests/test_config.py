"""Settings, parameter and measure specifications, windows."""

from __future__ import annotations

import datetime as dt

import pytest

from pulsegrain import MeasureSpec, ParamSpec, Run, Settings
from pulsegrain.config import ANALYTICS_TYPES, CRASH_TYPES
from pulsegrain.windows import DateWindow

TODAY = dt.date(2024, 1, 20)


def test_param_defaults():
    spec = ParamSpec("quantity", "INT", "metric")
    assert spec.struct_field_name == "quantity_int"
    assert spec.metric_rollup_transformation == "SUM(##)"
    assert spec.rollup_struct_field_name == "cm_quantity_int_sum"
    assert spec.metric_sql("s") == "SUM(s.`quantity_int`)"
    assert spec.value_field(ANALYTICS_TYPES) == "int_value"
    assert ParamSpec("flag", "bool").spark_type(ANALYTICS_TYPES) == "boolean"
    assert ParamSpec("t", "string", output_data_type="TIMESTAMP").spark_type(
        ANALYTICS_TYPES) == "timestamp"


@pytest.mark.parametrize("spec", [
    {"key_name": "a", "data_type": "string", "rollup_type": "Dimension"},
    {"key_name": "a", "data_type": "string", "rollup_type": "alsoForceNullDimension"},
    {"key_name": "a", "data_type": "int", "rollup_type": "alsoForceNullDimension",
     "force_null_dimension_event_name_filter": ["x"]},
    {"key_name": "a", "data_type": "int", "rollup_type": "metricOnly"},
])
def test_bad_params(spec):
    with pytest.raises(ValueError):
        ParamSpec.of(spec)


def test_types_per_feed():
    with pytest.raises(ValueError):
        Settings(custom_event_parameters=[{"key_name": "a", "data_type": "float"}])
    with pytest.raises(ValueError):
        Settings(custom_crash_keys=[{"key_name": "a", "data_type": "int"}])
    with pytest.warns(UserWarning, match="raw field"):
        settings = Settings(custom_user_properties=[
            {"key_name": "a", "data_type": "int", "rollup_type": "metric"}])
    assert "user_properties.a_int" in settings.fields_left_out_of_rollups
    assert ParamSpec("a", "string").value_field(CRASH_TYPES) is None


def test_roles():
    settings = Settings(custom_event_parameters=[
        {"key_name": "q", "data_type": "int", "rollup_type": "metric"},
        {"key_name": "q", "data_type": "int", "rollup_type": "metricOnly",
         "metric_rollup_transformation": "MIN(##)"},
        {"key_name": "r", "data_type": "string"}])
    assert [m.rollup_struct_field_name for m in settings.metrics] == [
        "cm_q_int_sum", "cm_q_int_min"]
    assert len([p for p in settings.extracted_event_parameters if p.key_name == "q"]) == 1
    assert {"event_parameters.q_int", "event_parameters.r_string",
            "geo.city"} <= settings.fields_left_out_of_rollups
    assert settings.sentinel_fields == {"event_parameters.view_type_string",
                                        "event_parameters.parent_view_type_string"}
    assert settings.sentinel_events == ("ob_ui_view_shown", "ob_ui_button_tapped",
                                        "ui_view_shown", "ui_button_tapped")


def test_measures():
    with pytest.raises(ValueError):
        MeasureSpec("x", model="other")
    with pytest.raises(ValueError):
        MeasureSpec("two words")
    plain = MeasureSpec("m", event_name="e", additional_filter="a = 1")
    assert plain.columns() == {
        "m_cnt": "SUM(IF(event_name = 'e' AND a = 1, cnt, 0))",
        "m_users": "SUM(IF(event_name = 'e' AND a = 1, users, 0))"}
    like = MeasureSpec("m", event_name="LIKE 'e%'", additional_filter="a = 1")
    assert like.condition_sql == "event_name LIKE 'e%'" and like.ignores_filter
    assert len([c for m in Settings().measures for c in m.columns()]) == 22


def test_mandatory_settings():
    with pytest.raises(ValueError, match="analytics_source"):
        Settings().require_mandatory()
    with pytest.raises(ValueError, match="crash_start"):
        Settings(project="p", analytics_source="a",
                 analytics_start="2020-01-01").require_mandatory()
    Settings(project="p", analytics_source="a", analytics_start="2020-01-01",
             crash_start="2020-01-01").require_mandatory()


def test_settings_from_variables():
    settings = Settings.from_variables({
        "ANY:FIREBASE_ANALYTICS_DEFAULT_INCREMENTAL_DAYS": 9,
        "ANY:OB_DIMENSION_TO_EXCLUDE_IN_ROLLUPS": ["geo.city"],
        "ANY:CUSTOM_EVENT_PARAMETERS": [{"key_name": "a", "data_type": "string"}]})
    assert settings.analytics_incremental_days == 9
    assert settings.excluded_dimensions == ("geo.city",)
    assert settings.event_parameters[-1].key_name == "a"
    with pytest.raises(ValueError):
        Settings.from_variables({"ANY:NO_SUCH_THING": 1})


def test_windows():
    run = Run(Settings(), TODAY)
    assert run.analytics() == DateWindow(dt.date(2024, 1, 15), dt.date(2024, 1, 21))
    assert run.analytics(extend=2).start == dt.date(2024, 1, 13)
    assert run.shards().start == dt.date(2024, 1, 14) and run.shards().end == run.analytics().end
    assert run.crash(extend=1).start == dt.date(2024, 1, 14)
    fixed = Run(Settings(crash_incremental_days=9), TODAY)
    assert fixed.crash(extend=1).start == dt.date(2024, 1, 11)
    full = Run(Settings(analytics_end="2019-01-05"), TODAY, incremental=False)
    assert full.analytics(extend=2) == DateWindow(dt.date(2018, 1, 1), dt.date(2019, 1, 5))
    assert full.shards() == full.analytics()
    assert full.crash() == DateWindow(dt.date(2018, 1, 1), dt.date(2024, 1, 21))
    assert full.checking().analytics() == run.analytics()


def test_window_predicates(spark):
    window = DateWindow(dt.date(2024, 1, 15), dt.date(2024, 1, 16))
    rows = spark.sql("""SELECT * FROM VALUES
        ('before', TIMESTAMP '2024-01-14 23:59:59.999999'), ('first', TIMESTAMP '2024-01-15'),
        ('end', TIMESTAMP '2024-01-16'), ('last', TIMESTAMP '2024-01-16 23:59:59.999999'),
        ('after', TIMESTAMP '2024-01-17') AS t(n, ts)""")

    def names(condition):
        return {r.n for r in rows.where(condition).collect()}

    assert names(window.has_day_of_micros("unix_micros(ts)")) == {"first", "end", "last"}
    assert names(window.has_date("date(ts)")) == {"first", "end", "last"}
    assert names(window.has_instant("ts")) == {"first", "end"}
    shards = spark.sql("SELECT * FROM VALUES ('20240114'), ('20240115'), "
                       "('intraday_20240116'), ('20240117') AS t(s)")
    assert {r.s for r in shards.where(window.has_shard("s")).collect()} == {
        "20240115", "intraday_20240116"}
