"""Day-partitioned tables: write whole days in one step, read a range of days.

A table is a folder with one subfolder for each write, `commit=<id>/event_date=<day>/`, and
numbered manifests that say which write each day is read from. Files are staged first; the write
counts from the moment its manifest gets its name, which is one rename. So a build that dies before that leaves
the table as it was, a reader sees either all days of a write or none, and a reader that has
begun goes on with the files it found.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrain.functions.sqltext import name
from pulsegrain.sources.files import Files
from pulsegrain.windows import DateWindow

DAY = "event_date"
COMMIT = "commit"
MANIFESTS = "_manifests"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a day
RANGE_BYTES = 128 << 20


class ConcurrentWrite(RuntimeError):
    """Another write of the table was published first."""


@dataclass(frozen=True)
class Manifest:
    """What a table consists of after its number-th write."""

    number: int = 0
    days: dict[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    table_format: str = "parquet"

    def text(self) -> str:
        return json.dumps({"days": self.days, "schema": self.schema.jsonValue(), "format": self.table_format})

    @classmethod
    def parse(cls, number: int, text: str) -> Manifest:
        content = json.loads(text)
        return cls(number, content["days"], T.StructType.fromJson(content["schema"]), content["format"])


def _manifest_file(path: str, number: int) -> str:
    return f"{path}/{MANIFESTS}/{number:012d}.json"


def _numbers(files: Files, path: str) -> list[int]:
    found = (n.removesuffix(".json") for n in files.names(f"{path}/{MANIFESTS}") if n.endswith(".json"))
    return sorted(int(n) for n in found if n.isdigit())


def current(spark: SparkSession, path: str) -> Manifest:
    """The last published manifest; an empty one where nothing was written yet."""
    path = path.rstrip("/")
    files = Files(spark, path)
    numbers = _numbers(files, path)
    if not numbers:
        return Manifest()
    return Manifest.parse(numbers[-1], files.read(_manifest_file(path, numbers[-1])))


def in_ranges(df: DataFrame, *order: str | Column, as_large_as: DataFrame | None = None) -> DataFrame:
    """Rows dealt out by ranges of the given columns: no two tasks overlap in them.

    The number of ranges follows the size Spark expects of the rows (or of ``as_large_as``, as it
    multiplies sizes at joins); adaptive execution joins small neighbours. The rows are computed a second time for the sample that finds the
    borders, from the last shuffle on, so this belongs where rows are narrow.
    """
    plan = (as_large_as or df)._jdf.queryExecution().optimizedPlan()
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(int(plan.stats().sizeInBytes()) / RANGE_BYTES)
    # A guess over many joins can be absurd; ranges beyond these would only be joined again.
    if shuffled < wanted < 100_000:
        return df.repartitionByRange(wanted, *order)
    return df.repartitionByRange(*order)


def _spread(schema: T.StructType, keys: Sequence[str]) -> list[Column]:
    """A hash of the scalars beside the keys, so that very many rows of equal keys are split."""
    rest = [f.name for f in schema.fields if f.name not in keys
            and not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType))]
    return [F.xxhash64(*[F.col(name(c)) for c in rest])] if rest else []


def write_days(df: DataFrame, path: str, cluster_by: Sequence[str] = (),
               full_refresh: bool = False, table_format: str = "parquet",
               may_erase: bool = False, in_place: bool = False) -> Manifest:
    """Replace the days that ``df`` has rows for, or everything, in one step.

    A day without new rows stays as it was. A full refresh without any row is an
    error where the table has some, unless ``may_erase`` allows it.

    With cluster keys the rows are dealt out by ranges of (day, keys) and sorted, so that the files
    of a day do not overlap in the keys and their statistics skip whole files; equal keys
    with very many rows are split by a hash of the row. Without keys a large day is cut by size.
    ``in_place`` leaves rows in the tasks where a plan has put them. If another write is published meanwhile, this
    one raises ConcurrentWrite and changes nothing.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = current(spark, path)
    keys = [DAY, *[c for c in cluster_by if c != DAY]]
    if in_place:
        placed = df
    elif len(keys) > 1:
        placed = in_ranges(df, *[F.col(name(c)) for c in keys], *_spread(df.schema, keys))
    else:
        placed = df.hint("rebalance", F.col(DAY))
    commit = uuid.uuid4().hex
    staged = f"{path}/{COMMIT}={commit}"
    (placed.sortWithinPartitions(*[F.col(name(c)) for c in keys])
     .write.format(table_format).partitionBy(DAY).save(staged))

    files = Files(spark, path)
    prefix = f"{DAY}="
    new = {n.removeprefix(prefix): commit for n in files.names(staged) if n.startswith(prefix)}
    if full_refresh and not new and before.days and not may_erase:
        files.remove(staged)
        raise ValueError(f"a full refresh without rows would erase {path}")
    after = Manifest(before.number + 1, new if full_refresh else before.days | new, df.schema, table_format)
    draft = f"{path}/{MANIFESTS}/draft-{commit}"
    files.write(draft, after.text())
    if not files.publish(draft, _manifest_file(path, after.number)):
        files.remove(draft)
        files.remove(staged)
        raise ConcurrentWrite(f"{path} was written by someone else; its days stay as they wrote them")
    return after


def read_days(spark: SparkSession, path: str, start: dt.date | None, end: dt.date | None,
              table_format: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Days ``start`` to ``end`` of a table. Both are required.

    Only the folders of these days are listed, as the last manifest names them. A folder without manifests
    is read as plain days of ``table_format``; with its schema given it may have no rows.
    """
    if start is None or end is None:
        raise ValueError("reading a table needs a first and a last day")
    path = path.rstrip("/")
    in_window = DateWindow(start, end).has_date(DAY)
    manifest = current(spark, path)
    if manifest.schema is None:
        reader = spark.read.format(table_format)
        return (reader if schema is None else reader.schema(schema)).load(path).where(in_window)
    first, last = start.isoformat(), end.isoformat()
    wanted = [f"{path}/{COMMIT}={commit}/{DAY}={day}" for day, commit in sorted(manifest.days.items())
              if day != NO_DAY and first <= day <= last]
    shape = schema or manifest.schema
    if not wanted:
        return spark.createDataFrame([], shape)
    rows = (spark.read.format(manifest.table_format).option("basePath", path)
            .schema(shape).load(wanted).where(in_window))
    if COMMIT not in shape.names:
        rows = rows.drop(COMMIT)
    # What a partition column says about itself is not in its files.
    about = shape[DAY].metadata if DAY in shape.names else None
    return rows.withMetadata(DAY, about) if about else rows


def remove_unused(spark: SparkSession, path: str, keep: int = 2,
                  older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Delete folders of writes that the last ``keep`` manifests do not name, and older manifests.

    Folders younger than ``older_than`` stay, as a write that goes on has them. Returns what was deleted.
    """
    if keep < 1:
        raise ValueError("the current manifest has to stay")
    path = path.rstrip("/")
    files = Files(spark, path)
    numbers = _numbers(files, path)
    used: set[str] = set()
    for number in numbers[-keep:]:
        used |= set(Manifest.parse(number, files.read(_manifest_file(path, number))).days.values())
    before = (time.time() - older_than.total_seconds()) * 1000
    gone = [n for n, changed in files.names(path).items()
            if n.startswith(f"{COMMIT}=") and n.removeprefix(f"{COMMIT}=") not in used and changed <= before]
    for folder in gone:
        files.remove(f"{path}/{folder}")
    for number in numbers[:-keep]:
        files.remove(_manifest_file(path, number))
    return gone
