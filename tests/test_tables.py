"""Reading shards and seeds, writing days, whole builds and checks."""

from __future__ import annotations

import contextlib
import datetime as dt
import itertools
import os
import signal
import subprocess
import sys
import threading
import time
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from harness import exports
from harness.queries import WHOLE, events_raw_of
from harness.settings import SETTINGS
from pulsegrain import Run, Settings
from pulsegrain import fixed_values as fv
from pulsegrain.plans import checks
from pulsegrain.plans.app_health import key_matches
from pulsegrain.plans.build import Warehouse, build_all
from pulsegrain.plans.crash_raw import build_crash_events_raw
from pulsegrain.plans.events_raw import build_events_raw
from pulsegrain.plans.installs import build_cohorts, build_installs_raw
from pulsegrain.plans.usage import build_events, build_events_forced_nulls
from pulsegrain.sources.comments import EVENTS_RAW, comment_table, with_comments
from pulsegrain.sources import tables
from pulsegrain.sources.exports import scan_analytics, scan_crashes
from pulsegrain.sources.seeds import read_lookups
from pulsegrain.sources.tables import current, read_days, remove_unused, write_days
from pulsegrain.windows import DateWindow
from tests.conftest import SMALL

DAY = dt.date(2024, 1, 10)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def raw(spark):
    df = events_raw_of(spark, SMALL).cache()
    yield df
    df.unpersist()


def test_scan_reads_only_shards_of_the_window(spark, tmp_path):
    template = exports.analytics_export(spark, SMALL).drop("table_suffix").limit(3)
    for shard in ("20240101", "20240114", "20240115", "intraday_20240116", "20240122"):
        template.write.parquet(str(tmp_path / f"events_{shard}"))
    run = Run(Settings(analytics_source=str(tmp_path)), dt.date(2024, 1, 20))
    scanned = scan_analytics(spark, run)
    assert {r.table_suffix for r in scanned.collect()} == {
        "20240114", "20240115", "intraday_20240116"}
    assert len(scanned.inputFiles()) == 3
    empty = Run(Settings(analytics_source=str(tmp_path)), dt.date(2020, 1, 1))
    assert scan_analytics(spark, empty).count() == 0
    with pytest.raises(ValueError):
        scan_analytics(spark, Run(Settings(analytics_source="x", analytics_shards="events"), DAY))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_analytics(spark, Run(Settings(analytics_source=str(tmp_path / "typo")), DAY))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_crashes(spark, Run(Settings(crash_source=str(tmp_path / "typo"), crash_shards="a_*"), DAY))
    assert scan_crashes(spark, Run(Settings(), DAY)).count() == 0


def test_scan_crashes_aligns_shards(spark, tmp_path):
    crash = exports.crash_export(spark, SMALL).select(
        "event_timestamp", "received_timestamp", "installation_uuid", "event_id", "variant_id",
        "unity_metadata").limit(2)
    crash.write.parquet(str(tmp_path / "com_app_IOS"))
    crash.drop("unity_metadata").write.parquet(str(tmp_path / "com_app_ANDROID"))
    run = Run(Settings(crash_source=str(tmp_path), crash_shards="com_app_*"), DAY)
    got = scan_crashes(spark, run)
    assert {(r.table_suffix, r.unity_metadata is None) for r in got.collect()} == {
        ("IOS", False), ("ANDROID", True)}


def test_seeds(spark, tmp_path):
    country, language = tmp_path / "country.csv", tmp_path / "language.csv"
    country.write_text("firebase_name,name,alpha_2,alpha_3,numeric\n"
                       "Namibia,Namibia,na,nam,516\n,Norway,no,nor,578\n")
    language.write_text("name,alpha_2,alpha_3,alphe_3_en,alpha_3_variety\n"
                        "German,de,deu,ger,deu\n")
    lookups = read_lookups(spark, str(country), str(language))
    assert [tuple(r) for r in lookups.country.collect()] == [
        ("Namibia", "Namibia", "na", "nam", 516), (None, "Norway", "no", "nor", 578)]
    assert lookups.language.first().alpha_3_en == "ger"


def everything(spark, path):
    return read_days(spark, path, dt.date(1970, 1, 1), dt.date(9999, 12, 31))


def test_only_the_new_days_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-05')) AS event_date,"
                      " 'old' AS v")
    write_days(first, path, ["v"], full_refresh=True)
    write_days(first.where("event_date >= DATE '2024-01-04'").withColumn("v", F.lit("new")), path)
    days = read_days(spark, path, dt.date(2024, 1, 2), dt.date(2024, 1, 5))
    assert {(r.event_date.day, r.v) for r in days.collect()} == {
        (2, "old"), (3, "old"), (4, "new"), (5, "new")}
    assert "PartitionFilters: [isnotnull(event_date" in (
        days._jdf.queryExecution().executedPlan().toString())
    write_days(first.limit(1), path, full_refresh=True)
    assert everything(spark, path).count() == 1
    with pytest.raises(ValueError, match="erase"):
        write_days(first.limit(0), path, full_refresh=True)
    assert everything(spark, path).count() == 1
    write_days(first.limit(0), path, full_refresh=True, may_erase=True)
    nothing = read_days(spark, path, dt.date(2024, 1, 2), dt.date(2024, 1, 5))
    assert nothing.count() == 0 and set(nothing.columns) == {"event_date", "v"}
    with pytest.raises(ValueError):
        read_days(spark, path, None, dt.date(2024, 1, 5))


SMALL_PARTS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
               "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB"}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def parquet_files(folder):
    return list(folder.glob("commit=*/event_date=*/*.parquet"))


@pytest.mark.parametrize("keys", [[], ["v"], ["same"]])
def test_a_large_day_is_written_by_several_tasks(spark, tmp_path, keys):
    one_day = spark.range(0, 40000, 1, 8).selectExpr("DATE '2024-01-01' AS event_date", "'x' AS same",
                                                     "sha2(string(id), 256) AS v")
    with settings(spark, SMALL_PARTS):
        write_days(one_day, str(tmp_path / "t"), keys)
    assert len(parquet_files(tmp_path / "t")) > 1
    assert everything(spark, str(tmp_path / "t")).select("v").distinct().count() == 40000


def test_files_of_a_day_do_not_overlap(spark, tmp_path, raw):
    path = str(tmp_path / "t")
    names = spark.range(0, 60000, 1, 8).selectExpr(
        "date_add(DATE '2024-01-01', int(id % 3)) AS event_date", "concat('name', pmod(xxhash64(id), 40)) AS event_name",
        "if(id % 2 = 0, 'IOS', 'ANDROID') AS platform", "'app' AS app_id", "sha2(string(id), 256) AS v")
    with settings(spark, {**SMALL_PARTS, "spark.sql.shuffle.partitions": "24"}):
        write_days(names, path, fv.EVENT_CLUSTER_KEYS)
    stored = everything(spark, path)
    files = (stored.groupBy("event_date", F.input_file_name().alias("file"))
             .agg(F.min("event_name").alias("low"), F.max("event_name").alias("high"), F.count("*").alias("n")).collect())
    assert len(files) > 12 and sum(f.n for f in files) == 60000
    for day in {f.event_date for f in files}:
        spans = sorted((f.low, f.high) for f in files if f.event_date == day)
        assert all(a[1] <= b[0] for a, b in itertools.pairwise(spans))
    # A name is looked for in few files: of the others the statistics are read, no rows.
    one = stored.where("event_name = 'name7' AND event_date = DATE '2024-01-02'")
    assert one.select(F.input_file_name()).distinct().count() < sum(f.event_date == dt.date(2024, 1, 2) for f in files) / 2


def test_a_write_that_stops_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-05')) AS event_date")
    write_days(days.withColumn("v", F.lit("old")), path, full_refresh=True)
    reader = everything(spark, path)
    broken = days.withColumn("v", F.expr("if(day(event_date) = 5, string(raise_error('stop')), 'new')"))
    for full in (True, False):
        with pytest.raises(Exception, match="stop"):
            write_days(broken, path, full_refresh=full)
        assert {r.v for r in everything(spark, path).collect()} == {"old"}
    assert current(spark, path).number == 1
    write_days(days.where("day(event_date) > 3").withColumn("v", F.lit("new")), path)
    assert [r.v for r in everything(spark, path).orderBy("event_date").collect()] == ["old"] * 3 + ["new"] * 2
    # Who began to read before goes on with what was there.
    assert {r.v for r in reader.collect()} == {"old"}


KILLED = """
import sys
import threading
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pulsegrain.sources.tables import write_days
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())

def slow(batches):
    import time
    for batch in batches:
        yield batch
        if batch.num_rows and batch.column(0)[0].as_py().day == 5:
            time.sleep(600)

days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-05')) AS event_date").withColumn("v", F.lit("new"))
spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
parts = days.repartition(5, "event_date").mapInArrow(slow, days.schema)
write_days(parts, {path!r}, full_refresh=True, in_place=True)
"""


def test_a_killed_build_leaves_the_table_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-05')) AS event_date")
    write_days(days.withColumn("v", F.lit("old")), path, full_refresh=True)
    root = str(Path(__file__).resolve().parent.parent)
    child = subprocess.Popen([sys.executable, "-c", KILLED.format(root=root, path=path)], start_new_session=True,
                             stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    try:
        def staged():
            return [f for f in (tmp_path / "t").glob("commit=*/**/*.parquet") if "_temporary" in str(f)]

        end = time.time() + 120
        while not staged() and child.poll() is None and time.time() < end:
            time.sleep(0.2)
        assert staged() and child.poll() is None
    finally:
        os.killpg(child.pid, signal.SIGKILL)
        child.wait()
    assert {r.v for r in everything(spark, path).collect()} == {"old"}
    assert len(remove_unused(spark, path)) == 0  # it could still be going on
    assert len(remove_unused(spark, path, older_than=dt.timedelta(0))) == 1
    write_days(days.withColumn("v", F.lit("again")), path, full_refresh=True)
    assert {r.v for r in everything(spark, path).collect()} == {"again"}
    write_days(days.withColumn("v", F.lit("last")), path)
    gone = remove_unused(spark, path, keep=1, older_than=dt.timedelta(0))
    assert len(gone) == 2 and {r.v for r in everything(spark, path).collect()} == {"last"}


def test_of_two_writes_at_once_one_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-02')) AS event_date")
    write_days(days.withColumn("v", F.lit("first")), path)
    before = current(spark, path)
    write_days(days.withColumn("v", F.lit("second")), path)
    monkeypatch.setattr(tables, "current", lambda *_: before)
    with pytest.raises(tables.ConcurrentWrite):
        write_days(days.withColumn("v", F.lit("third")), path)
    monkeypatch.undo()
    assert {r.v for r in everything(spark, path).collect()} == {"second"}
    assert len([f for f in (tmp_path / "t" / "_manifests").iterdir() if "draft" in f.name and "crc" not in f.name]) == 0


def test_a_table_keeps_its_schema_and_takes_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-02')) AS event_date, 1 AS a")
    write_days(days, path)
    write_days(days.where("day(event_date) = 2").withColumn("b", F.lit("x")), path)
    assert [(r.a, r.b) for r in everything(spark, path).orderBy("event_date").collect()] == [(1, None), (1, "x")]
    write_days(days.withColumn("event_date", F.lit(None).cast("date")), path)
    assert everything(spark, path).count() == 2


def test_plain_days_are_read_too(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT DATE '2024-01-01' AS event_date, 1 AS a").write.partitionBy("event_date").parquet(path)
    assert everything(spark, path).first().a == 1


def test_comments_are_kept_with_the_data(spark, tmp_path, raw):
    path = str(tmp_path / "raw")
    write_days(with_comments(raw.limit(5), EVENTS_RAW), path)
    schema = everything(spark, path).schema
    assert schema["install_age"].metadata["comment"].startswith("Whole days")
    assert schema["geo"].dataType["city"].metadata["comment"] == "City as exported"
    assert set(EVENTS_RAW) >= {f for f in raw.columns}
    spark.sql("CREATE TABLE described (event_ts timestamp, other int) USING parquet")
    try:
        comment_table(spark, "described", "User's events", EVENTS_RAW)
        assert spark.table("described").schema["event_ts"].metadata["comment"] == (
            EVENTS_RAW["event_ts"])
    finally:
        spark.sql("DROP TABLE described")


def test_rollup_totals(raw):
    events = build_events(raw, WHOLE)
    forced = build_events_forced_nulls(raw, WHOLE)
    assert events.agg(F.sum("cnt")).first()[0] == raw.count()
    ui = events.where(F.col("event_name").isin("ui_view_shown", "ui_button_tapped"))
    assert ui.agg(F.sum("cnt")).first()[0] == forced.agg(F.sum("cnt")).first()[0]
    assert forced.count() <= ui.count()


def test_hot_users_are_split(spark, raw, tmp_path):
    """One user with most of the events, many of them at the same time."""
    hot = raw.withColumn("user_pseudo_id", F.expr("if(hash(event_ts) % 4 = 0, user_pseudo_id, 'hot')"))
    path = str(tmp_path / "hot")
    write_days(hot, path)
    stored = read_days(spark, path, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    write_days(build_installs_raw(stored, WHOLE), f"{path}_installs")
    installs = read_days(spark, f"{path}_installs", dt.date(2023, 12, 1), dt.date(2024, 1, 31))
    plain = rows(build_cohorts(stored, installs, WHOLE))
    skewed = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2"}
    with settings(spark, skewed):
        cohorts = build_cohorts(stored, installs, WHOLE)
        assert rows(cohorts) == plain
        assert "SortMergeJoin(skew=true)" in plan_of(cohorts)


def test_checks(raw, spark):
    export = exports.analytics_export(spark, SMALL)
    run = Run(SETTINGS, dt.date(2024, 1, 12))
    assert checks.raw_counts(raw, export, run).count() > 0
    assert checks.raw_reconciliation(raw, export, run).count() == 0
    installs = build_installs_raw(raw, WHOLE)
    since = dt.date(2020, 1, 1)
    early = Run(SETTINGS, dt.date(2024, 1, 4))
    assert checks.install_uniqueness(installs, early, since).count() == 0
    assert checks.install_uniqueness(installs.union(installs), early, since).count() == 1
    lines = checks.dimension_cardinality(raw, WHOLE, dt.date(2030, 1, 1))
    assert {r.dist_cnt for r in lines.collect()} == {0}
    counts = [r.dist_cnt for r in checks.dimension_cardinality(raw, WHOLE, DAY).collect()]
    assert counts == sorted(counts, reverse=True) and counts[0] > 0


def test_build_twice_changes_nothing(spark, tmp_path):
    def analytics(session, run):
        return exports.analytics_export(session, SMALL)

    def crashes(session, run):
        return exports.crash_export(session, SMALL)

    lookups = exports.lookups(spark)
    full = Run(SETTINGS, dt.date(2024, 2, 5), incremental=False)
    trailing = Run(SETTINGS, dt.date(2024, 1, 8))
    root = str(tmp_path / "warehouse")
    names = ("events_raw", "installs_raw", "events", "events_wid", "ui_wid", "app_health")

    def content():
        return {t: rows(everything(spark, f"{root}/{t}")) for t in names}

    build_all(spark, root, full, lookups, analytics, crashes)
    before = content()
    assert all(before.values())
    build_all(spark, root, trailing, lookups, analytics, crashes)
    assert content() == before
    w = build_all(spark, root, trailing, lookups, analytics, crashes)
    assert content() == before
    assert w.read("errors").count() >= 0
    with pytest.raises(ValueError, match="mandatory"):
        build_all(spark, root, Run(Settings(), DAY), lookups, analytics, crashes)


def test_a_build_refuses_code_tables_with_a_repeated_code(spark, tmp_path):
    lookups = exports.lookups(spark)
    twice = type(lookups)(lookups.country.union(lookups.country.limit(1)), lookups.language)
    with pytest.raises(ValueError, match="not unique"):
        build_all(spark, str(tmp_path / "w"), WHOLE, twice, lambda s, _: exports.analytics_export(s, SMALL))


def test_build_of_an_app_without_crashes_views_or_installs(spark, tmp_path):
    def analytics(session, run):
        return exports.analytics_export(session, SMALL).where(
            "event_name = 'user_engagement'").withColumn("user_first_touch_timestamp", F.lit(None).cast("bigint"))

    settings = Settings(project="p", analytics_source="x", analytics_start="2023-12-01", crash_start="2023-12-01")
    full = Run(settings, dt.date(2024, 2, 5), incremental=False)
    w = build_all(spark, str(tmp_path / "w"), full, exports.lookups(spark), analytics)
    assert w.read("events_raw").count() > 0
    for table in ("crash_events_raw", "installs_raw", "ui", "events_wid"):
        assert w.read(table).count() == 0
    assert checks.install_uniqueness(w.read("installs_raw"), full, dt.date(2020, 1, 1)).count() == 0
    trailing = Run(settings, dt.date(2024, 1, 8))
    assert build_all(spark, str(tmp_path / "w"), trailing, exports.lookups(spark), analytics)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, tmp_path, raw):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        path = str(tmp_path / "raw")
        write_days(raw, path)
        stored = read_days(spark, path, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
        forced = plan_of(build_events_forced_nulls(stored, WHOLE))
        assert "PushedFilters: [In(event_name" in forced
        assert "PartitionFilters: [isnotnull(event_date" in forced
        schema = forced[forced.index("ReadSchema"):]
        assert "event_parameters_raw" not in schema and "city" not in schema
        assert "event_dates" not in schema

        shard = tmp_path / "export" / "events_20240102"
        exports.analytics_export(spark, SMALL).drop("table_suffix").limit(5).write.parquet(
            str(shard))
        run = Run(Settings(analytics_source=str(tmp_path / "export")), dt.date(2024, 1, 3))
        export = plan_of(build_events_raw(scan_analytics(spark, run), exports.lookups(spark), run))
        assert "GreaterThanOrEqual(event_timestamp" in export

        exports.crash_export(spark, SMALL).drop("table_suffix", "logs", "breadcrumbs", "blame_frame", "exceptions",
                                                "errors", "threads").limit(5).write.parquet(
            str(tmp_path / "crashes" / "app_IOS"))
        run = Run(Settings(crash_source=str(tmp_path / "crashes"), crash_shards="app_*"), dt.date(2024, 1, 3))
        crashes = plan_of(build_crash_events_raw(scan_crashes(spark, run), run))
        assert "GreaterThanOrEqual(event_timestamp" in crashes
        assert "LessThanOrEqual(event_timestamp" in crashes
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_rollups_and_cohorts_shuffle_as_little_as_possible(raw, spark, tmp_path):
    path = str(tmp_path / "raw")
    write_days(raw, path)
    stored = read_days(spark, path, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    # Exact distinct users: by keys and user, then by keys.
    assert plan_of(build_events(stored, WHOLE)).count("Exchange hashpartitioning") == 2
    assert plan_of(build_installs_raw(stored, WHOLE)).count("Exchange hashpartitioning") == 1


def test_sketches_are_close_and_decide_as_exact_counts_do(spark, raw):
    days = DateWindow(dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    many = raw.withColumn("app_id", F.concat("user_pseudo_id", F.lit("."), F.col("event_ts").cast("string")))
    counts = {r.dim_name: r.dist_cnt for r in many.where(days.has_date("event_date")).agg(*[
        F.countDistinct(c).alias(c) for c in ("app_id", "event_name", "platform")]).unpivot(
            [], ["app_id", "event_name", "platform"], "dim_name", "dist_cnt").collect()}
    sketches = checks.profile_sketches(many, WHOLE).cache()
    merged = sketches.where(days.has_date("event_date")).agg(*[
        F.expr(f"hll_sketch_estimate(hll_union_agg({c}))").alias(c) for c in counts]).first()
    assert counts["app_id"] > 500
    assert all(abs(merged[c] - n) <= checks.SKETCH_ERROR * n + 1 for c, n in counts.items())
    # At the very limit only an exact count can tell.
    for limit in (counts["app_id"] - 1, counts["app_id"], 1):
        over = {r.dim_name: r.over for r in checks.dimensions_over(many, WHOLE, days, limit, sketches).collect()}
        assert {c: over[c] for c in counts} == {c: n > limit for c, n in counts.items()}


def test_key_matches_tell_what_does_not_meet(spark):
    keys = list(fv.HEALTH_DIMENSIONS)

    def keyed(*rows):
        return spark.createDataFrame([(dt.date(2024, 1, 1), *r) for r in rows], "event_date date, " + ", ".join(
            f"{k} string" for k in keys[1:]))

    full, other, gap = ("p",) * 8, ("q",) * 8, (None, *("p",) * 7)
    found = {r.source: (r.n_keys, r.n_incomplete, r.n_unmatched) for r in key_matches({
        "analytics": keyed(full, gap), "installs": keyed(full, other, gap), "crashlytics": keyed(other)}).collect()}
    assert found == {"analytics": (2, 1, 0), "installs": (3, 1, 1), "crashlytics": (1, 0, 1)}


def test_independent_writes_run_at_once_and_end_before_an_error(spark, tmp_path):
    both, ended = threading.Barrier(2, timeout=60), []
    w = Warehouse(spark, str(tmp_path), WHOLE)

    def one():
        both.wait()
        w.write("one", spark.range(3).selectExpr("id", "DATE '2024-01-02' AS event_date"))
        ended.append("one")

    def other():
        both.wait()
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        w.write_all(other, one)
    assert ended == ["one"] and w.read("one").count() == 3
