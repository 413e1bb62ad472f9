"""Literal cases for the scalar expressions."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulsegrain.functions import text, times, versions
from pulsegrain.functions.sqltext import literal


def evaluate(spark, *expressions):
    return tuple(spark.range(1).selectExpr(*[f"{e} AS c{i}" for i, e in enumerate(expressions)])
                 .first())


def version(spark, value):
    cleaned = versions.clean_version(literal(value))
    return evaluate(spark, *[versions.KINDS[k](cleaned) for k in versions.KINDS])


@pytest.mark.parametrize("value, expected", [
    ("17.0.1.5", (17, 0, 1, 17.0, "17.0.1", 17000000000001)),
    ("17", (17, None, None, 17.0, "17", 17000000000000)),
    ("17.1", (17, 1, None, 17.1, "17.1", 17000001000000)),
    ("17.10", (17, 10, None, 17.1, "17.10", 17000010000000)),
    ("0.9.10", (0, 9, 10, 0.9, "0.9.10", 9000010)),
    ("007.01", (7, 1, None, 7.1, "007.01", 7000001000000)),
    ("3.2beta", (3, 2, None, 3.2, "3.2", 3000002000000)),
    ("1.1234567", (1, 1234567, None, 1.1234567, "1.1234567", 11234567000000)),
    ("20231015.1", (20231015, 1, None, 20231015.1, "20231015.1", None)),
    ("1.99999999999999999999", (1, None, None, 1.0, "1.99999999999999999999", 1000000000000)),
    ("beta", (None,) * 6),
    ("", (None,) * 6),
    (None, (None,) * 6),
])
def test_version_parts(spark, value, expected):
    assert version(spark, value) == expected


def test_unknown_version_kind():
    with pytest.raises(ValueError):
        versions.version_as("v", "patch")


@pytest.mark.parametrize("value, expected", [
    ("17000001000000", (17, 1, 0, 17.1, "17.1.0", 17000001000000)),
    ("1000000000000", (1, 0, 0, 1.0, "1.0.0", 1000000000000)),
    ("9000010", (None,) * 6),
    ("beta", (None,) * 6),
    ("20231015.1", (None,) * 6),
    (None, (None,) * 6),
])
def test_version_record(spark, value, expected):
    (record,) = evaluate(spark, versions.version_from_normalized(literal(value)))
    assert record is not None and tuple(record) == expected


def test_join_value(spark):
    for value, expected in (("17.1", "17000001000000"), ("beta", "beta"),
                            ("20231015.1", "20231015.1"), (None, None)):
        cleaned = versions.clean_version(literal(value))
        assert evaluate(spark, versions.join_value(cleaned, literal(value))) == (expected,)


def test_os_name_is_removed(spark):
    assert evaluate(spark, versions.version_without_os("'iOS 17.1'", "'iOS'"),
                    versions.version_without_os("'17.1'", "NULL")) == ("17.1", None)


@given(st.lists(st.integers(0, 10**7), min_size=1, max_size=3))
@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_normalized_matches_padding(spark, parts):
    digits = "".join(f"{p:06d}" for p in (parts + [0, 0])[:3])
    expected = int(digits) if int(digits) < 2**63 else None
    assert version(spark, ".".join(map(str, parts)))[-1] == expected


def at(value: dt.datetime) -> str:
    return f"TIMESTAMP '{value} UTC'"


START = dt.datetime(2023, 10, 12, 19, 20, 28, 13000)


@pytest.mark.parametrize("later, age", [
    (START + dt.timedelta(hours=23, minutes=58), 0),
    (START + dt.timedelta(hours=24), 1),
    (START - dt.timedelta(minutes=30), 0),
    (START - dt.timedelta(hours=1), -1),
    (START - dt.timedelta(hours=25), -2),
])
def test_install_age(spark, later, age):
    assert evaluate(spark, times.age_in_days(at(later), at(START))) == (age,)


def test_wall_clock_age_counts_minute_boundaries(spark):
    earlier = dt.datetime(2023, 10, 12, 19, 20, 59)
    for later, age in ((dt.datetime(2023, 10, 13, 19, 20, 1), 1),
                       (dt.datetime(2023, 10, 13, 19, 19, 59), 0),
                       (dt.datetime(2023, 10, 12, 19, 19, 59), -1)):
        assert evaluate(spark, times.wall_clock_age(at(later), at(earlier))) == (age,)
    assert evaluate(spark, times.wall_clock_age("CAST(NULL AS timestamp)",
                                                at(earlier))) == (None,)


@pytest.mark.parametrize("age, label", [
    ("0", "Age 0"), ("1", "Age 1-6"), ("6", "Age 1-6"), ("7", "Age 7-30"), ("30", "Age 7-30"),
    ("31", "Age 31+"), ("-1", "Age 1-6"), ("CAST(NULL AS bigint)", "Age 31+"),
])
def test_age_group(spark, age, label):
    assert evaluate(spark, times.age_group(age)) == (label,)


@pytest.mark.parametrize("seconds, offset", [
    ("0", "+00:00"), ("7200", "+02:00"), ("-19800", "-05:30"), ("45900", "+12:45"),
    ("CAST(NULL AS bigint)", None), ("-1", "-00:00"),
])
def test_offset_text(spark, seconds, offset):
    assert evaluate(spark, times.offset_text(seconds)) == (offset,)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for instant in (dt.datetime(2024, 3, 10, 11, 59, 59, 999999),
                        dt.datetime(1969, 12, 31, 23, 0), dt.datetime(2024, 11, 3, 12, 0)):
            ts = at(instant)
            day, zones = evaluate(spark, times.utc_date(ts),
                                  times.zone_dates(f"({times.hour_number(ts)})"))
            assert day == instant.date()
            assert len(zones) == 24 and "plus_0" not in zones
            for hours in (-12, -1, 1, 12):
                assert (zones[times.offset_name(hours)]
                        == (instant + dt.timedelta(hours=hours)).date())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_within_a_day_is_inclusive(spark):
    day = dt.timedelta(days=1)
    for later, inside in ((START, True), (START + day, True),
                          (START + day + dt.timedelta(microseconds=1), False),
                          (START - dt.timedelta(microseconds=1), False)):
        assert evaluate(spark, times.within_a_day_after(at(later), at(START))) == (inside,)


def test_text(spark):
    assert evaluate(spark, text.reverse_dotted("'com.example.app1'"),
                    text.null_if_empty("''"), text.null_if_empty("'x'"),
                    text.first_tag_part("'zh-hans-cn'"), text.last_tag_part("'zh-hans-cn'"),
                    text.last_tag_part("'sv'")) == (
        "app1.example.com", None, "x", "zh", "cn", "sv")


def test_platform_of_shard(spark):
    assert evaluate(spark, *[text.platform_of_shard(f"'{s}'") for s in (
        "com_x_ANDROID", "com_x_IOS_REALTIME", "com_x", "ANDROID_IOS")]) == (
        "ANDROID", "IOS", "UNKNOWN", "ANDROID")


def test_name_list(spark):
    names = ["a", "LIKE 'error_%'", "like 'x%'"]
    rows = spark.createDataFrame([(n,) for n in ("a", "ab", "errorXfoo", "error", "xy")], "n string")
    assert {r.n for r in rows.where(text.in_name_list("n", names)).collect()} == {
        "a", "errorXfoo", "xy"}
    assert rows.where(text.in_name_list("n", [])).count() == 5
