"""Typed struct fields out of key/value arrays.

An array is passed over once for its keys, in which repeated ones are refused; every lookup is a position in
them, and the entry at that position is read in place. All of it is built-in array functions,
which stay inside generated code; lambda functions such as ``filter`` would not, and are used only on the way to an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pulsegrain import fixed_values as fv
from pulsegrain.config import ParamSpec
from pulsegrain.functions.sqltext import aliased, expressions, literal, name, struct
from pulsegrain.functions.text import in_name_list


def checked_keys(entries: str, wanted: Sequence[str], on_duplicate: str = "error") -> str:
    """The keys of an array, in order.

    A wanted key that occurs twice has no single value, which is an error unless
    ``on_duplicate`` is ``"first"``. Other keys may occur as often as they like.
    """
    keys = name(entries, "key")
    if on_duplicate == "first":
        return keys
    among = f"array({', '.join(literal(k) for k in dict.fromkeys(wanted))})"
    twice = f"filter({among}, w -> size({keys}) - size(array_remove({keys}, w)) > 1)"
    message = f"concat('key occurs more than once in {entries}: ', array_join({twice}, ', '))"
    # Two keys are compared in place; only more of them are worth a set.
    repeated = f"if(size({keys}) = 2, get({keys}, 0) <=> get({keys}, 1), size(array_distinct({keys})) < size({keys}))"
    return (f"if(size({keys}) > 1 AND {repeated} AND size({twice}) > 0, "
            f"CAST(raise_error({message}) AS array<string>), {keys})")


def key_position(keys: str, key: str) -> str:
    """1-based position of the key's entry, 0 if there is none."""
    return f"coalesce(array_position({keys}, {literal(key)}), 0)"


def value_at(entries: str, position: str, value_field: str | None) -> str:
    path = "value" if value_field is None else f"value.{name(value_field)}"
    return f"get({name(entries)}, int({position} - 1)).{path}"


def key_value(entries: str, key: str, value_field: str | None = None,
              on_duplicate: str = "error") -> str:
    """The value of one key, NULL when absent."""
    return value_at(entries, key_position(checked_keys(entries, [key], on_duplicate), key), value_field)


@dataclass(frozen=True)
class Extraction:
    """A parameter struct in two steps, each a set of columns over the one before.

    Positions are columns of their own, so that parameters with the same key
    share them; Spark computes the keys that they look into once for all of
    them. Several extractions can share a step.
    """

    positions: dict[str, str]
    struct: str


def extraction(field: str, entries: str, specs: Sequence[ParamSpec],
               types: Mapping[str, tuple[str | None, str]],
               on_duplicate: str = "error") -> Extraction:
    """How to build struct ``field`` from the parameters found in ``entries``."""
    if not specs:
        return Extraction({}, struct({"empty": literal(fv.NO_CUSTOM_KEYS)}))
    wanted = list(dict.fromkeys(p.key_name for p in specs))
    keys = checked_keys(entries, wanted, on_duplicate)
    at = {key: f"__{field}_at_{i}" for i, key in enumerate(wanted)}
    fields = {}
    for spec in specs:
        position = name(at[spec.key_name])
        value = value_at(entries, position, spec.value_field(types))
        extracted = spec.extract_transformation.replace("##", value)
        # Without an entry there is no value, whatever the template makes of NULL.
        present = f"{position} > 0"
        if spec.event_name_filter:
            present += f" AND {in_name_list('event_name', spec.event_name_filter)}"
        fields[spec.struct_field_name] = (
            f"if({present}, CAST({extracted} AS {spec.spark_type(types)}), NULL)")
    return Extraction({column: key_position(keys, key) for key, column in at.items()}, struct(fields))


def with_parameter_struct(df: DataFrame, field: str, entries: str, specs: Sequence[ParamSpec],
                          types: Mapping[str, tuple[str | None, str]],
                          on_duplicate: str = "error") -> DataFrame:
    """Add struct ``field`` with one field per parameter found in ``entries``."""
    steps = extraction(field, entries, specs, types, on_duplicate)
    return (df.selectExpr("*", *expressions(steps.positions))
            .selectExpr(*[name(c) for c in df.columns], aliased(steps.struct, field)))
