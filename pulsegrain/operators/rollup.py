"""Dimensional rollups with exact distinct users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.config import ParamSpec
from pulsegrain.functions.sqltext import aliased, expressions, name, struct
from pulsegrain.operators.determinants import Dimensions

METRIC_INPUT = "__metric_input"


def metric_input(metrics: Sequence[ParamSpec]) -> list[str]:
    """The struct that metric templates read, with just the fields they need."""
    fields = dict.fromkeys(m.struct_field_name for m in metrics)
    if not fields:
        return []
    return [aliased(struct({f: name("event_parameters", f) for f in fields}), METRIC_INPUT)]


def aggregate(df: DataFrame, keys: Sequence[str], user: str,
              metrics: Sequence[ParamSpec] = ()) -> DataFrame:
    """Group by columns: rows, distinct users, configured metrics.

    Spark plans the distinct count as an aggregate by keys and user followed by
    one by keys, both with a partial step, so neither a hot user nor a hot
    combination of dimensions ends up in one task.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.countDistinct(F.col(user)).alias("users"),
        *[F.expr(m.metric_sql(METRIC_INPUT)).alias(m.rollup_struct_field_name)
          for m in metrics])


def rollup(df: DataFrame, keys: Mapping[str, str], dims: Dimensions, user: str,
           metrics: Sequence[ParamSpec] = ()) -> DataFrame:
    """:func:`aggregate` by the given expressions and dimensions."""
    rows = df.selectExpr(*expressions({**keys, **dims.keys, "__user": name(user)}), *metric_input(metrics))
    grouped = aggregate(rows, [*keys, *dims.keys], "__user", metrics)
    measures = grouped.columns[len(keys) + len(dims.keys):]
    return dims.finished(grouped, [*keys, *dims.outputs, *measures])
