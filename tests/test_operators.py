"""Operators on small fixtures, against literal formulations of their definition."""

from __future__ import annotations

import datetime as dt
import random
import re
from functools import reduce

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from harness.exports import lookups
from harness.settings import WHOLE
from pulsegrain import ParamSpec
from pulsegrain import fixed_values as fv
from pulsegrain.config import ANALYTICS_TYPES, CRASH_TYPES
from pulsegrain.functions.params import with_parameter_struct
from pulsegrain.functions.sqltext import expressions
from pulsegrain.operators.dedup import keep_one_copy
from pulsegrain.operators.dims import (
    aligned_struct, dimension_columns, flat_columns, pack, selected)
from pulsegrain.operators.lookups import Lookups, checked_codes, with_country, with_language
from pulsegrain.plans import app_health
from pulsegrain.plans.events_raw import build_events_raw
from pulsegrain.session import tune
from pulsegrain.sources.exports import ANALYTICS_EXPORT


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def entries(spark, *pairs):
    """One event whose parameters are the given (key, string, int, double)."""
    items = ", ".join(
        f"named_struct('key', '{k}', 'value', named_struct('string_value', CAST({s!r} AS string), "
        f"'int_value', CAST({i} AS bigint), 'double_value', CAST({d} AS double)))"
        .replace("CAST(None AS string)", "CAST(NULL AS string)").replace("None", "NULL")
        for k, s, i, d in pairs)
    array = f"array({items})" if pairs else "NULL"
    schema = ("array<struct<key:string,value:struct<string_value:string,int_value:bigint,"
              "double_value:double>>>")
    return spark.sql(f"SELECT 'ui_view_shown' AS event_name, CAST({array} AS {schema}) AS params")


SPECS = [
    ParamSpec("name", "string", extract_transformation="LOWER(TRIM(##))"),
    ParamSpec("n", "int"), ParamSpec("d", "double"), ParamSpec("b", "bool"),
    ParamSpec("other", "string", event_name_filter=("something_else",)),
    ParamSpec("gone", "string", extract_transformation="COALESCE(##, 'default')"),
    ParamSpec("day", "string", extract_transformation="TIMESTAMP(##)",
              output_data_type="timestamp", struct_field_name="day"),
]


def extracted(df, **options):
    return with_parameter_struct(df, "p", "params", SPECS, ANALYTICS_TYPES, **options).first().p


def test_parameters_become_typed_fields(spark):
    p = extracted(entries(spark, ("name", " A B ", None, None), ("n", None, 7, None),
                          ("d", None, None, 1.5), ("b", None, 1, None), ("other", "x", None, None),
                          ("day", "2024-01-02", None, None)))
    assert tuple(p) == ("a b", 7, 1.5, True, None, None, dt.datetime(2024, 1, 2))


def test_a_template_sees_null_values_but_not_missing_keys(spark):
    assert extracted(entries(spark)).gone_string is None
    assert extracted(entries(spark, ("x", "1", None, None))).gone_string is None
    assert extracted(entries(spark, ("gone", None, None, None))).gone_string == "default"


def test_a_repeated_key_is_an_error_unless_first_is_wanted(spark):
    twice = entries(spark, ("n", None, 1, None), ("n", None, 2, None))
    with pytest.raises(PySparkException, match="more than once"):
        extracted(twice)
    assert extracted(twice, on_duplicate="first").n_int == 1
    # Only requested keys matter.
    harmless = entries(spark, ("x", "1", None, None), ("x", "2", None, None),
                       ("n", None, 3, None))
    assert extracted(harmless).n_int == 3


def test_interface_text_loses_any_white_space(spark):
    spec = ParamSpec("name", "string", extract_transformation=fv.UI_TEXT)
    df = entries(spark, ("name", "x", None, None)).withColumn(
        "params", F.expr("transform(params, e -> named_struct('key', e.key, 'value', "
                         "named_struct('string_value', '\\t\\u00a0 Shop \\n', 'int_value', "
                         "e.value.int_value, 'double_value', e.value.double_value)))"))
    assert with_parameter_struct(df, "p", "params", [spec],
                                 ANALYTICS_TYPES).first().p.name_string == "shop"


def test_no_crash_keys_configured(spark):
    df = spark.sql("SELECT array(named_struct('key', 'a', 'value', 'b')) AS keys")
    assert with_parameter_struct(df, "k", "keys", (), CRASH_TYPES).first().k.asDict() == {
        "empty": "noCustomKeysDefined"}


def test_dedup_keeps_the_preferred_copy_and_counts(spark):
    df = spark.createDataFrame(
        [("a", 1, "late", 5), ("a", 1, "early", 9), (None, 1, "x", 1), (None, 1, "x", 1),
         ("b", None, "y", 2)], "k1 string, k2 int, shard string, v int")
    assert rows(keep_one_copy(df, ["k1", "k2"], ["shard"])) == sorted(
        [("a", 1, "early", 9, 2), (None, 1, "x", 1, 2), ("b", None, "y", 2, 1)], key=str)
    once = keep_one_copy(df, ["k1", "k2"], ["shard"]).drop("duplicates_cnt")
    assert rows(keep_one_copy(once, ["k1", "k2"], ["shard"]).drop("duplicates_cnt")) == rows(once)


def test_dedup_matches_the_window_form_with_one_hot_key(spark):
    df = spark.range(5000).selectExpr("IF(id % 3 = 0, 0, id % 700) AS k", "hash(id) AS t",
                                      "id AS v", "map('a', id) AS m")
    w = Window.partitionBy("k")
    expected = (df.withColumn("n", F.count(F.lit(1)).over(w))
                .withColumn("r", F.row_number().over(w.orderBy("t", "v"))).where("r = 1"))
    columns = ["k", "t", "v", "m.a", "n"]
    assert (rows(keep_one_copy(df, ["k"], ["t"], "n").select(*columns))
            == rows(expected.select(*columns)))


def test_dedup_reduces_copies_before_the_shuffle(spark):
    plan = keep_one_copy(spark.range(10).selectExpr("id % 2 AS k", "id AS v"), ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") < text.rindex("partial_min") and text.count("Exchange") == 1


COUNTRY = "firebase_name string, name string, alpha_2 string, alpha_3 string, numeric int"


def codes(spark):
    country = spark.createDataFrame(
        [("Germany", "Germany", "de", "deu", 276), ("Namibia", "Namibia", "na", "nam", 516),
         (None, "El Salvador", "sv", "slv", 222), ("", "Norway", "no", "nor", 578)], COUNTRY)
    language = spark.createDataFrame([("German", "de"), ("Swedish", "sv")],
                                     "name string, alpha_2 string")
    return Lookups.checked(country, language)


def test_lookups(spark):
    lookups = codes(spark)
    df = spark.createDataFrame([("GERMANY",), ("Nowhere",), ("",), (None,)], "c string")
    assert rows(with_country(df, lookups, "c")) == sorted(
        [("GERMANY", "Germany", "de"), ("Nowhere", None, None), ("", None, None),
         (None, None, None)], key=str)
    tags = spark.createDataFrame([("de-DE",), ("sv",), ("xx-latn-na",), (None,)], "t string")
    assert rows(with_language(tags, lookups, "t")) == sorted(
        [("de-DE", "de", "de"), ("sv", "sv", "sv"), ("xx-latn-na", None, "na"),
         (None, None, None)], key=str)


def test_code_tables_are_checked(spark):
    row = ("A", "A", "aa", "aaa", 1)
    with pytest.raises(ValueError, match="alpha_2"):
        checked_codes(spark.createDataFrame([row, row], COUNTRY), "country")
    with pytest.raises(ValueError, match="firebase_name"):
        checked_codes(spark.createDataFrame([row, ("a", "B", "bb", "bbb", 2)], COUNTRY), "c")
    many = spark.range(700).selectExpr("CAST(id AS string) AS alpha_2")
    assert checked_codes(many, "language").count() == 700
    empty = [(None, "A", None, "aaa", 1), (None, "B", None, "bbb", 2), ("", "C", "cc", "ccc", 3)]
    assert checked_codes(spark.createDataFrame(empty, COUNTRY), "country").count() == 3


def test_dimensions(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('x', 'p', 'y', 2) AS s, "
                   "named_struct('z', 1) AS t, 'q' AS b")
    assert [f.name for f in selected(df.schema, ["b", "a"])] == ["a", "b"]
    dims = dimension_columns(df.schema, "*", {"s.y", "t.z"}, {"s.x"}, prefix="i_")
    assert df.selectExpr(*expressions(dims)).first().asDict(True) == {
        "i_a": 1, "i_s": {"x": fv.SENTINEL}, "i_b": "q"}
    flat = flat_columns(df.schema, "*", {"s.y"}, prefix="f_")
    assert list(flat) == ["f_a", "f_s_x", "f_t_z", "f_b"]
    packed = df.selectExpr(*expressions(flat)).selectExpr(
        *expressions(pack(df.schema, "*", {"s.y"}, "f_")))
    assert packed.first().asDict(True) == {"a": 1, "s": {"x": "p"}, "t": {"z": 1}, "b": "q"}
    with pytest.raises(ValueError, match="string"):
        dimension_columns(df.schema, "*", sentinel={"s.y"})
    nested = spark.sql("SELECT named_struct('x', array(1)) AS s")
    with pytest.raises(ValueError, match="flat"):
        dimension_columns(nested.schema, "*")


def test_aligned_struct(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'c', 'x') AS s")
    wanted = [("a", "bigint", True), ("b", "string", True), ("c", "string", False)]
    assert df.selectExpr(f"{aligned_struct(df.schema, 's', wanted)} AS s").first().s.asDict() == {
        "a": 1, "b": None, "c": None}


def test_health_rows_equal_the_chain_of_outer_joins(spark):
    """Random keys with NULL parts, some in only one or two of the inputs."""
    random.seed(7)
    keys = list(app_health.KEYS)

    def value():
        return random.choice(["a", "b", None])

    inputs, measures = {}, {"analytics": "m1", "analytics_forced_nulls": "m2", "installs": "m3",
                            "crashlytics": "m4"}
    for source, measure in measures.items():
        made = {tuple(["d"] * 6 + [value(), value(), value()]) for _ in range(14)}
        inputs[source] = spark.createDataFrame(
            [(*key, i) for i, key in enumerate(sorted(made, key=str))],
            ", ".join(f"{k} string" for k in keys) + f", {measure} long")
    a, *others = inputs.values()
    joined = a.alias("t0")
    for i, other in enumerate(others, 1):
        condition = reduce(lambda x, y: x & y,
                           [F.col(f"t0.{k}") == F.col(f"t{i}.{k}") for k in keys])
        joined = joined.join(other.alias(f"t{i}"), condition, "full")
    expected = joined.select(
        *[F.coalesce(*[F.col(f"t{i}.{k}") for i in range(4)]).alias(k) for k in keys],
        *measures.values())
    assert rows(app_health.combine(inputs)) == rows(expected)
    merged = app_health.combine(inputs, merge_keys=True)
    assert merged.count() == expected.select(*keys).distinct().count()


def test_health_inputs_are_grouped_without_another_shuffle(spark):
    made = spark.range(20).selectExpr(*[f"CAST(id % {i + 2} AS string) AS {k}"
                                        for i, k in enumerate(app_health.KEYS)], "id")
    inputs = {s: made.groupBy(*app_health.KEYS).agg(F.sum("id").alias(f"m_{s}"))
              for s in app_health.SOURCES}
    text = app_health.combine(inputs)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == len(inputs)


def test_tasks_read_few_bytes_but_lower_limits_stay(spark):
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for given, wanted in (("64MB", {16 << 20, 32 << 20}), ("1g", {16 << 20, 32 << 20}), ("64k", {"64k"})):
            for n in names:
                spark.conf.set(n, given)
            tune(spark)
            assert {spark.conf.get(n) for n in names} == {str(w) for w in wanted}
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def test_the_raw_table_copies_rows_few_times_and_samples_them_before_the_codes(spark):
    tune(spark)
    export = spark.createDataFrame([], f"{ANALYTICS_EXPORT}, table_suffix string")
    raw = build_events_raw(export, lookups(spark), WHOLE, in_file_order=True)
    text = raw._jdf.queryExecution().executedPlan().toString()
    after, found, before = text.partition("rangepartitioning")
    assert found
    # Borders are found in rows without their codes: those are joined once, where the rows lie.
    assert after.count("BroadcastHashJoin") == 3 and "Join" not in before
    # Parts, positions and hours take one step, the columns another.
    assert len(re.findall(r"^[ :+-]*Project ", after.partition("BroadcastHashJoin")[0], re.MULTILINE)) == 2


def test_the_rest_of_a_row_is_one_value_before_the_sort_of_a_dedup(spark):
    df = spark.range(10).selectExpr("string(id % 2) AS k", "id % 3 AS n", "id AS v", "'x' AS w")
    text = keep_one_copy(df, ["k", "n"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(__row" in text
    # The number is the first key: the sort compares it without reading rows.
    assert re.search(r"Sort \[n#\d+L ASC", text)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_a_repeated_key_is_found_in_lists_of_any_length(spark, n):
    others = [(f"x{i}", None, i, None) for i in range(n)]
    assert extracted(entries(spark, *others, ("n", None, 1, None))).n_int == 1
    with pytest.raises(PySparkException, match="more than once"):
        extracted(entries(spark, ("n", None, 1, None), *others, ("n", None, 2, None)))
