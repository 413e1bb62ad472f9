"""One row per group of copies, with the number of copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrain.functions.sqltext import aliased, name

COUNT_COLUMN = "duplicates_cnt"


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def keep_one_copy(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = (),
                  count_column: str = COUNT_COLUMN) -> DataFrame:
    """Keep the row with the smallest ``prefer`` values of each group of copies.

    What ``prefer`` leaves open is settled by the remaining columns, so the
    result does not depend on partitioning. NULL keys group together. This is
    an aggregate, not a window: each task reduces its own copies before the
    shuffle, so a key with any number of copies costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    columns = [*prefer, *rest]
    # The rest of a row is made one value before the sort, not anew at every step of the aggregate.
    rows = df.select(*keys, F.struct(*columns).alias("__row"))
    if all(_orderable(f.dataType) for f in df.schema.fields):
        survivor = F.min("__row")
    else:
        order = [F.col(name("__row", c)).alias(c) for c in columns if _orderable(df.schema[c].dataType)]
        survivor = F.min_by("__row", F.struct(*order))
    # The aggregate sorts by its keys, and numbers of eight bytes are compared without reading the rows.
    strings = [c for c in keys if isinstance(df.schema[c].dataType, T.StringType)]
    grouping = [*[c for c in keys if c not in strings], *strings]
    grouped = rows.groupBy(*grouping).agg(survivor.alias("__row"), F.count(F.lit(1)).alias(count_column))
    return grouped.selectExpr(
        *[name(c) if c in keys else aliased(name("__row", c), c) for c in df.columns],
        name(count_column))
