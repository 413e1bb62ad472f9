"""Group by the columns that determine the dimensions, and derive the others from them.

Most fields of a version record, and the reversed app id, are functions of a few fields. Rows that
agree in those agree in all, so grouping by them gives the same groups with shorter keys: fewer
bytes to read, compare and shuffle, on both sides of a cohort join and through both steps of a distinct count.
The derived fields are computed once for each group.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pulsegrain.functions.sqltext import aliased, expressions, name, struct
from pulsegrain.functions.text import reverse_dotted
from pulsegrain.functions.versions import clean_version, version_fields, version_parts
from pulsegrain.operators.dims import dimension_columns, selected

REVERSED = {"reverse_app_id": "app_id"}
# Records whose original text gives all of the record, and such whose cleaned form does.
FROM_ORIGINAL = ("app_version",)
FROM_CLEANED = ("platform_version",)
CLEANED, ORIGINAL, JOIN_VALUE = "major_minor_bugfix", "firebase_value", "join_value"


@dataclass
class Dimensions:
    """Columns to group by, and how to get every dimension from them afterwards."""

    keys: dict[str, str] = field(default_factory=dict)
    steps: tuple[dict[str, str], dict[str, str]] = field(default_factory=lambda: ({}, {}))
    outputs: dict[str, str] = field(default_factory=dict)

    def finished(self, grouped: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The given columns of the groups, dimensions derived from their keys."""
        for step in self.steps:
            if step:
                grouped = grouped.selectExpr("*", *expressions(step))
        return grouped.selectExpr(*[aliased(self.outputs.get(c, name(c)), c) for c in columns])

    def __add__(self, other: Dimensions) -> Dimensions:
        return Dimensions(self.keys | other.keys, tuple(a | b for a, b in zip(self.steps, other.steps, strict=True)),
                          self.outputs | other.outputs)


def _version(dims: Dimensions, column: str, record: T.StructField, kept: list[str]) -> bool:
    """Group by part of a version record, if what determines the rest is kept."""
    whole = record.name in FROM_ORIGINAL and ORIGINAL in kept
    if not whole and not (record.name in FROM_CLEANED and CLEANED in kept):
        return False
    types = {f.name: f.dataType for f in record.dataType.fields}
    clean, parts = f"__{column}_clean", f"__{column}_parts"
    values = version_fields(name(clean), name(column, ORIGINAL), name(parts))
    if not whole:
        values = {f: v for f, v in values.items() if f not in (CLEANED, JOIN_VALUE)}
    values.pop(ORIGINAL, None)
    derived = [f for f in kept if f in values]
    if any(types[f] != T.DataType.fromDDL(KINDS[f]) for f in derived):
        return False
    dims.keys[column] = struct({f: name(record.name, f) for f in kept if f not in derived})
    dims.steps[0][clean] = clean_version(name(column, ORIGINAL)) if whole else name(column, CLEANED)
    dims.steps[1][parts] = version_parts(name(clean))
    dims.outputs[column] = struct({f: values[f] if f in derived else name(column, f) for f in kept})
    return True


KINDS = {"major": "bigint", "minor": "bigint", "bugfix": "bigint", "major_minor": "double",
         CLEANED: "string", "normalized": "bigint", JOIN_VALUE: "string"}


def dimensions(schema: T.StructType, wanted: Collection[str] | str, ignored: Collection[str] = (),
               sentinel: Collection[str] = (), prefix: str = "") -> Dimensions:
    """The dimensions of :func:`dimension_columns`, with what determines them as keys.

    A record of which a field is collapsed, or whose determining fields are left out, is a key as it is.
    """
    plain = dimension_columns(schema, wanted, ignored, sentinel, prefix)
    dims = Dimensions()
    for source in selected(schema, wanted, ignored):
        column = prefix + source.name
        if column not in plain:
            continue
        base = REVERSED.get(source.name)
        if base and prefix + base in plain:
            dims.outputs[column] = reverse_dotted(name(prefix + base))
            continue
        if isinstance(source.dataType, T.StructType):
            kept = [f.name for f in source.dataType.fields if f"{source.name}.{f.name}" not in ignored]
            untouched = not any(s.startswith(f"{source.name}.") for s in sentinel)
            if untouched and _version(dims, column, source, kept):
                continue
        dims.keys[column] = plain[column]
        dims.outputs[column] = name(column)
    return dims
