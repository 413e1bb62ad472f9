"""Grouping by determining columns gives what grouping by all columns gives."""

from __future__ import annotations

import datetime as dt

import pytest

from harness.queries import WHOLE, crash_raw_of, events_raw_of
from pulsegrain import fixed_values as fv
from pulsegrain.functions.sqltext import expressions
from pulsegrain.operators.determinants import dimensions
from pulsegrain.operators.dims import dimension_columns
from pulsegrain.operators.rollup import aggregate, rollup
from pulsegrain.plans.installs import build_events_wid, build_installs_raw
from pulsegrain.plans.usage import build_events
from pulsegrain.sources.tables import read_days, write_days
from tests.conftest import SMALL



@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    write_days(events_raw_of(spark, SMALL, in_file_order=True), path, in_place=True)
    return read_days(spark, path, dt.date(2020, 1, 1), dt.date(2030, 1, 1))


def by_all_columns(df, wanted, ignored, sentinel, user):
    columns = dimension_columns(df.schema, wanted, ignored, sentinel)
    return aggregate(df.selectExpr("event_date", *expressions(columns), user), ["event_date", *columns], user)


def same(a, b):
    assert a.columns == b.columns and a.schema.simpleString() == b.schema.simpleString()
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize(("ignored", "sentinel"), [
    ((), ()),
    (("geo.city",), ("event_parameters.view_type_string",)),
    (("app_version.firebase_value", "platform_version.join_value"), ()),
    (("platform_version.major_minor_bugfix", "app_version.major", "app_version.normalized"), ()),
    (("app_id", "app_version.join_value"), ("app_version.firebase_value",)),
    (tuple(f"app_version.{f}" for f in ("firebase_value", "major", "minor", "bugfix", "major_minor",
                                        "major_minor_bugfix", "normalized", "join_value")), ()),
])
def test_the_same_groups(raw, ignored, sentinel):
    dims = dimensions(raw.schema, fv.EVENT_DIMENSIONS, ignored, sentinel)
    found = rollup(raw, {"event_date": "event_date"}, dims, "user_pseudo_id")
    same(found, by_all_columns(raw, fv.EVENT_DIMENSIONS, ignored, sentinel, "user_pseudo_id"))


def test_the_same_groups_of_crashes(spark):
    crashes = crash_raw_of(spark, SMALL).cache()
    dims = dimensions(crashes.schema, fv.CRASH_DIMENSIONS)
    found = rollup(crashes, {"event_date": "event_date"}, dims, "crashlytics_user_pseudo_id")
    same(found, by_all_columns(crashes, fv.CRASH_DIMENSIONS, (), (), "crashlytics_user_pseudo_id"))


def test_odd_versions_are_derived_as_they_were(spark):
    from pulsegrain.functions.versions import clean_version, version_struct, version_without_os

    texts = ["17.0.1.5", "0.9.10", "beta", "", None, "20231015.1", "99999999999999999999.1", "7", "1.2", "iOS 17.1", "iOS beta"]
    df = spark.createDataFrame([(t, o) for t in texts for o in ("iOS", None)], "v string, os string").selectExpr(
        "DATE '2024-01-01' AS event_date", "concat('u', rand()) AS u", "v", f"{version_without_os('v', 'os')} AS bare")
    df = df.selectExpr("event_date", "u", f"{version_struct('v', 'v', clean_version('v'))} AS app_version",
                       f"{version_struct('v', 'bare', clean_version('bare'))} AS platform_version").cache()
    dims = dimensions(df.schema, "*", ("event_date", "u"))
    same(rollup(df, {"event_date": "event_date"}, dims, "u"), by_all_columns(df, "*", ("event_date", "u"), (), "u"))


def test_derived_fields_are_neither_read_nor_shuffled(raw):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    raw.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        events = plan(build_events(raw, WHOLE))
        cohorts = plan(build_events_wid(raw, build_installs_raw(raw, WHOLE), WHOLE))
    finally:
        raw.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")
    read = events[events.index("ReadSchema"):]
    assert "app_version:struct<firebase_value:string>" in read
    assert "platform_version:struct<firebase_value:string,major_minor_bugfix:string,join_value:string>" in read
    assert "reverse_app_id" not in read and "normalized" not in read and "bugfix:bigint" not in read
    for text in (events, cohorts):
        for exchange in (line for line in text.splitlines() if "Exchange hashpartitioning" in line and "app_version" in line):
            assert "reverse_app_id" not in exchange
    keys = dimensions(raw.schema, fv.EVENT_DIMENSIONS)
    fields = ", ".join(keys.keys.values())
    assert fields.count("`") < ", ".join(dimension_columns(
        raw.schema, fv.EVENT_DIMENSIONS).values()).count("`")
