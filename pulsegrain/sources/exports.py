"""The two export feeds: folders with one subfolder per shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrain import fixed_values as fv
from pulsegrain.sources.files import Files
from pulsegrain.windows import DateWindow, Run

# Input schemas. Given to the reader, so that no footers have to be merged and
# a field that some shards lack is NULL there.
KEY_VALUES = ("array<struct<key:string,value:struct<string_value:string,int_value:bigint,"
              "double_value:double>>>")
ANALYTICS_EXPORT = f"""
    event_timestamp bigint,
    user_first_touch_timestamp bigint,
    event_previous_timestamp bigint,
    event_bundle_sequence_id bigint,
    event_name string,
    platform string,
    user_pseudo_id string,
    user_id string,
    stream_id string,
    app_info struct<id:string,version:string,install_source:string,firebase_app_id:string>,
    device struct<category:string,mobile_brand_name:string,mobile_model_name:string,
        mobile_marketing_name:string,mobile_os_hardware_model:string,operating_system:string,
        operating_system_version:string,language:string,advertising_id:string,
        time_zone_offset_seconds:bigint>,
    geo struct<city:string,country:string,continent:string,sub_continent:string,region:string,
        metro:string>,
    traffic_source struct<name:string,medium:string,source:string>,
    user_ltv struct<revenue:double,currency:string>,
    event_params {KEY_VALUES},
    user_properties {KEY_VALUES}
"""
UNITY = ",".join(f"{name}:{kind}" for name, kind, filled in fv.UNITY_METADATA if filled)
CRASH_EXPORT = f"""
    event_timestamp timestamp,
    received_timestamp timestamp,
    installation_uuid string,
    event_id string,
    variant_id string,
    bundle_identifier string,
    issue_id string,
    issue_title string,
    issue_subtitle string,
    error_type string,
    process_state string,
    app_orientation string,
    device_orientation string,
    crashlytics_sdk_version string,
    application struct<display_version:string,build_version:string>,
    operating_system struct<display_version:string,name:string,modification_state:string,
        device_type:string>,
    device struct<manufacturer:string,model:string,architecture:string>,
    memory struct<used:bigint,free:bigint>,
    storage struct<used:bigint,free:bigint>,
    user struct<id:string,name:string,email:string>,
    custom_keys array<struct<key:string,value:string>>,
    logs array<struct<timestamp:timestamp,message:string>>,
    breadcrumbs array<struct<timestamp:timestamp,name:string,
        params:array<struct<key:string,value:string>>>>,
    blame_frame struct<line:bigint,file:string,symbol:string,library:string,owner:string,
        blamed:boolean>,
    exceptions array<struct<type:string,exception_message:string,nested:boolean,title:string,
        subtitle:string,blamed:boolean>>,
    errors array<struct<queue:string,code:bigint,title:string,subtitle:string,blamed:boolean>>,
    threads array<struct<crashed:boolean,thread_name:string,queue_name:string,title:string,
        subtitle:string,blamed:boolean>>,
    unity_metadata struct<{UNITY}>
"""


def _stem(shards: str) -> str:
    if not shards.endswith("*"):
        raise ValueError(f"shard name {shards!r} has to end in *")
    return shards[:-1]


def _without_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], T.StructType([
        *schema.fields, T.StructField("table_suffix", T.StringType())]))


def _read(spark: SparkSession, root: str, stem: str, wanted: list[str] | None,
          schema: T.StructType | str, source_format: str) -> DataFrame:
    """Read shards and add ``table_suffix``, the part of the folder name after ``stem``.

    ``wanted`` are the folders of some shards. None of them may exist, but a
    root without any shard is an error, not an empty feed.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.format(source_format).schema(schema)
    rows = reader.load(f"{root.rstrip('/')}/{stem}*" if wanted is None else wanted)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.select(*schema.names,
                       F.substr(folder, F.lit(len(stem.rpartition("/")[2]) + 1)).alias("table_suffix"))


def date_shards(spark: SparkSession, root: str, stem: str, window: DateWindow) -> tuple[list[str], bool]:
    """Folders of the daily and intraday shards of the window's days, and whether there are any shards.

    The root is listed once, whatever the length of the window.
    """
    inside, _, prefix = stem.rpartition("/")
    folder = "/".join(filter(None, [root.rstrip("/"), inside]))
    suffixes = [n.removeprefix(prefix) for n in Files(spark, folder).names(folder) if n.startswith(prefix)]
    wanted = [f"{folder}/{prefix}{s}" for s in sorted(suffixes) if window.covers_shard(s)]
    return wanted, bool(suffixes)


def scan_analytics(spark: SparkSession, run: Run, extend: int = 0,
                   schema: T.StructType | str = ANALYTICS_EXPORT,
                   source_format: str = "parquet") -> DataFrame:
    """Analytics shards of the run's days; no other folder is listed or opened."""
    settings = run.settings
    stem = _stem(settings.analytics_shards)
    wanted, any_shard = date_shards(spark, settings.analytics_source, stem, run.shards(extend))
    if any_shard and not wanted:
        return _without_rows(spark, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    # Without any shard the pattern is not found either: an error.
    return _read(spark, settings.analytics_source, stem, wanted or None, schema, source_format)


def scan_crashes(spark: SparkSession, run: Run, schema: T.StructType | str = CRASH_EXPORT,
                 source_format: str = "parquet") -> DataFrame:
    """All crash shards. They are cut by platform, not by day: the filter on the
    event time is what keeps a run from reading old rows. An app without a
    crash source has no crashes."""
    settings = run.settings
    if not settings.crash_source:
        return _without_rows(spark, T.StructType.fromDDL(schema) if isinstance(schema, str)
                             else schema)
    return _read(spark, settings.crash_source, _stem(settings.crash_shards), None, schema,
                 source_format)
