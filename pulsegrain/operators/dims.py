"""Dimension columns: selection by schema, dropped fields, sentinels, flat form.

All of these return SQL expressions for ``selectExpr``.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import types as T

from pulsegrain import fixed_values as fv
from pulsegrain.functions.sqltext import literal, name, struct


def _fields(field: T.StructField, ignored: Collection[str]) -> list[T.StructField]:
    for inner in field.dataType.fields:
        if isinstance(inner.dataType, (T.StructType, T.ArrayType, T.MapType)):
            raise ValueError(f"dimension {field.name}.{inner.name} is not flat")
    return [f for f in field.dataType.fields if f"{field.name}.{f.name}" not in ignored]


def _value(field: T.StructField, inner: T.StructField, sentinel: Collection[str]) -> str:
    path = f"{field.name}.{inner.name}"
    if path not in sentinel:
        return name(field.name, inner.name)
    if not isinstance(inner.dataType, T.StringType):
        raise ValueError(f"{path} is no string, it cannot hold the sentinel")
    return literal(fv.SENTINEL)


def selected(schema: T.StructType, wanted: Collection[str] | str,
             ignored: Collection[str] = ()) -> list[T.StructField]:
    """Fields of ``schema`` that are wanted (``"*"``: all), in table order."""
    return [f for f in schema.fields
            if (wanted == "*" or f.name in wanted) and f.name not in ignored]


def dimension_columns(schema: T.StructType, wanted: Collection[str] | str,
                      ignored: Collection[str] = (), sentinel: Collection[str] = (),
                      prefix: str = "") -> dict[str, str]:
    """Grouping columns by name, structs rebuilt from the fields that remain.

    A struct that loses every field is left out. Only the remaining fields are
    referenced, so the scan reads no others.
    """
    columns = {}
    for field in selected(schema, wanted, ignored):
        if not isinstance(field.dataType, T.StructType):
            columns[prefix + field.name] = name(field.name)
            continue
        kept = _fields(field, ignored)
        if kept:
            columns[prefix + field.name] = struct(
                {inner.name: _value(field, inner, sentinel) for inner in kept})
    return columns


def flat_columns(schema: T.StructType, wanted: Collection[str] | str = "*",
                 ignored: Collection[str] = (), sentinel: Collection[str] = (),
                 prefix: str = "") -> dict[str, str]:
    """The same dimensions with every struct field as its own column ``struct_field``."""
    columns = {}
    for field in selected(schema, wanted, ignored):
        if not isinstance(field.dataType, T.StructType):
            columns[prefix + field.name] = name(field.name)
            continue
        for inner in _fields(field, ignored):
            columns[f"{prefix}{field.name}_{inner.name}"] = _value(field, inner, sentinel)
    return columns


def pack(schema: T.StructType, wanted: Collection[str] | str = "*",
         ignored: Collection[str] = (), flat_prefix: str = "", prefix: str = "") -> dict[str, str]:
    """Inverse of :func:`flat_columns`: structs shaped as in ``schema``."""
    columns = {}
    for field in selected(schema, wanted, ignored):
        if not isinstance(field.dataType, T.StructType):
            columns[prefix + field.name] = name(flat_prefix + field.name)
            continue
        kept = _fields(field, ignored)
        if kept:
            columns[prefix + field.name] = struct(
                {inner.name: name(f"{flat_prefix}{field.name}_{inner.name}") for inner in kept})
    return columns


def aligned_struct(schema: T.StructType, column: str,
                   wanted: Collection[tuple[str, str, bool]]) -> str:
    """Struct of exactly the wanted ``(name, type, filled)`` fields.

    A field that is not filled, or that ``column`` does not have, is NULL.
    """
    present: set[str] = set()
    if column in schema.names and isinstance(schema[column].dataType, T.StructType):
        present = set(schema[column].dataType.names)
    return struct({
        field: f"CAST({name(column, field) if filled and field in present else 'NULL'} "
               f"AS {data_type})"
        for field, data_type, filled in wanted})
