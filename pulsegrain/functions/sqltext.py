"""Quoting and structs in SQL text."""

from __future__ import annotations

from collections.abc import Mapping


def literal(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(*path: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in path)


def aliased(expression: str, alias: str) -> str:
    return f"{expression} AS {name(alias)}"


def struct(fields: Mapping[str, str]) -> str:
    return "named_struct(" + ", ".join(
        f"{literal(field)}, {value}" for field, value in fields.items()) + ")"


def expressions(columns: Mapping[str, str]) -> list[str]:
    """Column name -> expression, as arguments of ``selectExpr``."""
    return [aliased(value, column) for column, value in columns.items()]
