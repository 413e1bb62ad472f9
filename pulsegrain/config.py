"""Declarative settings: parameters, health measures, run-wide options."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, fields
from typing import Any

from pulsegrain import fixed_values as fv
from pulsegrain.functions.sqltext import literal

ROLES = ("raw", "dimension", "alsoForceNullDimension", "metric", "metricOnly")

# data type -> (field of the entry's value, Spark type)
ANALYTICS_TYPES = {
    "string": ("string_value", "string"),
    "int": ("int_value", "bigint"),
    "double": ("double_value", "double"),
    "bool": ("int_value", "boolean"),
}
CRASH_TYPES = {"string": (None, "string")}
# Accepted as an output type only: the template has to produce the value.
OUTPUT_ONLY_TYPES = {"timestamp": "timestamp"}


def _as_tuple(value: Iterable[str] | None) -> tuple[str, ...]:
    return tuple(value) if value else ()


@dataclass(frozen=True)
class ParamSpec:
    """One key of a key/value array that becomes a typed struct field.

    ``extract_transformation`` and ``metric_rollup_transformation`` are Spark
    SQL templates in which ``##`` stands for the value.
    """

    key_name: str
    data_type: str
    rollup_type: str | None = None
    extract_transformation: str = "##"
    metric_rollup_transformation: str | None = None
    struct_field_name: str | None = None
    rollup_struct_field_name: str | None = None
    output_data_type: str | None = None
    event_name_filter: tuple[str, ...] = ()
    force_null_dimension_event_name_filter: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        role = self.rollup_type or "raw"
        if role not in ROLES:
            raise ValueError(f"{self.key_name}: rollup_type {role!r} is not one of {ROLES}")
        names = _as_tuple(self.event_name_filter)
        sentinel_names = _as_tuple(self.force_null_dimension_event_name_filter)
        metric = self.metric_rollup_transformation
        if metric is None and role == "metric":
            metric = "SUM(##)"
        if metric is None and role == "metricOnly":
            raise ValueError(f"{self.key_name}: metricOnly needs metric_rollup_transformation")
        if role == "alsoForceNullDimension":
            if not sentinel_names:
                raise ValueError(
                    f"{self.key_name}: {role} needs force_null_dimension_event_name_filter")
            if (self.output_data_type or self.data_type).lower() != "string":
                raise ValueError(f"{self.key_name}: only a string dimension can be force-nulled")
        struct_field = self.struct_field_name or f"{self.key_name}_{self.data_type.lower()}"
        rollup_field = self.rollup_struct_field_name
        if rollup_field is None and metric is not None:
            rollup_field = f"cm_{struct_field}_{metric.split('(')[0].lower()}"
        for name, value in (
            ("rollup_type", role),
            ("event_name_filter", names),
            ("force_null_dimension_event_name_filter", sentinel_names),
            ("metric_rollup_transformation", metric),
            ("struct_field_name", struct_field),
            ("rollup_struct_field_name", rollup_field),
        ):
            object.__setattr__(self, name, value)

    @classmethod
    def of(cls, spec: ParamSpec | Mapping[str, Any]) -> ParamSpec:
        return spec if isinstance(spec, cls) else cls(**spec)

    def value_field(self, types: Mapping[str, tuple[str | None, str]]) -> str | None:
        return types[self.data_type.lower()][0]

    def spark_type(self, types: Mapping[str, tuple[str | None, str]]) -> str:
        wanted = (self.output_data_type or self.data_type).lower()
        if wanted in types:
            return types[wanted][1]
        return OUTPUT_ONLY_TYPES[wanted]

    def check_types(self, types: Mapping[str, tuple[str | None, str]]) -> None:
        if self.data_type.lower() not in types:
            raise ValueError(
                f"{self.key_name}: data_type {self.data_type!r} is not one of {tuple(types)}")
        if self.output_data_type is not None:
            allowed = (*types, *OUTPUT_ONLY_TYPES) if types is ANALYTICS_TYPES else tuple(types)
            if self.output_data_type.lower() not in allowed:
                raise ValueError(f"{self.key_name}: output_data_type {self.output_data_type!r} "
                                 f"is not one of {allowed}")

    @property
    def is_metric(self) -> bool:
        return self.rollup_type in ("metric", "metricOnly")

    def metric_sql(self, struct: str) -> str:
        """The aggregate as Spark SQL over ``struct``'s field."""
        target = f"{struct}.`{self.struct_field_name}`"
        return self.metric_rollup_transformation.replace("##", target)


@dataclass(frozen=True)
class MeasureSpec:
    """A conditional measure of the health table."""

    name: str
    model: str = "analytics"
    agg: str = "SUM(##)"
    event_name: str | None = None
    mini_measures: tuple[str, ...] = ("cnt", "users")
    additional_filter: str = "True"

    MODELS = ("analytics", "analytics_forced_nulls", "crashlytics")

    def __post_init__(self) -> None:
        if self.model not in self.MODELS:
            raise ValueError(f"measure {self.name!r}: model must be one of {self.MODELS}")
        if " " in self.name:
            raise ValueError(f"measure {self.name!r}: the name becomes a column, no spaces")
        object.__setattr__(self, "mini_measures", tuple(self.mini_measures))

    @classmethod
    def of(cls, spec: MeasureSpec | Mapping[str, Any]) -> MeasureSpec:
        return spec if isinstance(spec, cls) else cls(**spec)

    @property
    def condition_sql(self) -> str:
        """Which rows count.

        A LIKE event name stands alone: the additional filter is not applied.
        """
        if self.event_name is None:
            return self.additional_filter
        if self.event_name.lower().startswith("like "):
            return f"event_name {self.event_name}"
        return f"event_name = {literal(self.event_name)} AND {self.additional_filter}"

    @property
    def ignores_filter(self) -> bool:
        return (self.event_name is not None
                and self.event_name.lower().startswith("like ")
                and self.additional_filter != "True")

    def columns(self) -> dict[str, str]:
        """Output column -> aggregate SQL, one per mini measure."""
        return {
            f"{self.name}_{mini}": self.agg.replace("##", f"IF({self.condition_sql}, {mini}, 0)")
            for mini in self.mini_measures
        }


def _date(value: dt.date | str | None) -> dt.date | None:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Settings:
    """Everything a project can configure.

    ``analytics_source`` and ``crash_source`` are folders that hold one
    subfolder per shard; ``*_shards`` is the shard name with a trailing ``*``.
    """

    project: str | None = None
    analytics_source: str | None = None
    analytics_shards: str = "events_*"
    crash_source: str | None = None
    crash_shards: str | None = None
    analytics_start: dt.date | str = fv.FULL_REFRESH_START
    analytics_end: dt.date | str | None = None
    crash_start: dt.date | str = fv.FULL_REFRESH_START
    crash_end: dt.date | str | None = None
    analytics_incremental_days: int = fv.INCREMENTAL_DAYS
    crash_incremental_days: int | None = None
    custom_install_event: str | None = None
    platform_expr: str = "platform"
    excluded_dimensions: tuple[str, ...] = fv.DEFAULT_EXCLUDED_DIMENSIONS
    custom_user_properties: tuple[ParamSpec, ...] = ()
    custom_event_parameters: tuple[ParamSpec, ...] = ()
    custom_crash_keys: tuple[ParamSpec, ...] = ()
    custom_measures: tuple[MeasureSpec, ...] = ()
    duplicate_keys: str = "error"

    user_properties: tuple[ParamSpec, ...] = field(init=False, default=())
    event_parameters: tuple[ParamSpec, ...] = field(init=False, default=())
    crash_keys: tuple[ParamSpec, ...] = field(init=False, default=())
    measures: tuple[MeasureSpec, ...] = field(init=False, default=())

    def __post_init__(self) -> None:
        def put(name: str, value: Any) -> None:
            object.__setattr__(self, name, value)

        for name in ("analytics_start", "analytics_end", "crash_start", "crash_end"):
            put(name, _date(getattr(self, name)))
        put("excluded_dimensions", tuple(self.excluded_dimensions))
        put("custom_install_event", self.custom_install_event or None)
        put("user_properties", self._params(fv.BUILTIN_USER_PROPERTIES,
                                            self.custom_user_properties, ANALYTICS_TYPES))
        put("event_parameters", self._params(fv.BUILTIN_EVENT_PARAMETERS,
                                             self.custom_event_parameters, ANALYTICS_TYPES))
        put("crash_keys", self._params((), self.custom_crash_keys, CRASH_TYPES))
        put("measures", tuple(MeasureSpec.of(m)
                              for m in (*fv.BUILTIN_MEASURES, *self.custom_measures)))
        for spec in self.user_properties:
            if spec.is_metric:
                warnings.warn(f"{spec.key_name}: user properties are not aggregated; the metric "
                              "stays a raw field", stacklevel=2)
        if self.duplicate_keys not in ("error", "first"):
            raise ValueError("duplicate_keys must be 'error' or 'first'")

    @staticmethod
    def _params(builtin, custom, types) -> tuple[ParamSpec, ...]:
        specs = tuple(ParamSpec.of(p) for p in (*builtin, *custom))
        for spec in specs:
            spec.check_types(types)
        return specs

    @classmethod
    def from_variables(cls, variables: Mapping[str, Any]) -> Settings:
        """Settings from a project's variable block."""
        known = {f.name for f in fields(cls) if f.init}
        values = {}
        for name, value in variables.items():
            key = fv.SETTING_NAMES.get(name.split(":")[-1], name)
            if key not in known:
                raise ValueError(f"unknown setting {name!r}")
            values[key] = value
        return cls(**values)

    def require_mandatory(self) -> None:
        """Refuse to build from sources that were never configured."""
        default_start = _date(fv.FULL_REFRESH_START)
        missing = [name for name, unset in (
            ("project", not self.project),
            ("analytics_source", not self.analytics_source),
            ("analytics_start", self.analytics_start == default_start),
            ("crash_start", self.crash_start == default_start),
        ) if unset]
        if missing:
            raise ValueError(f"these settings are mandatory and still unset: {missing}")

    # Which parameters play which part.

    @property
    def extracted_event_parameters(self) -> tuple[ParamSpec, ...]:
        return tuple(p for p in self.event_parameters if p.rollup_type != "metricOnly")

    @property
    def metrics(self) -> tuple[ParamSpec, ...]:
        by_role = {role: [p for p in self.event_parameters if p.rollup_type == role]
                   for role in ("metric", "metricOnly")}
        return (*by_role["metric"], *by_role["metricOnly"])

    @property
    def fields_left_out_of_rollups(self) -> frozenset[str]:
        kept_back = [f"event_parameters.{p.struct_field_name}" for p in self.event_parameters
                     if p.rollup_type == "raw" or p.is_metric]
        kept_back += [f"user_properties.{p.struct_field_name}" for p in self.user_properties
                      if p.rollup_type == "raw" or p.is_metric]
        return frozenset((*kept_back, *self.excluded_dimensions))

    @property
    def sentinel_fields(self) -> frozenset[str]:
        return frozenset(
            f"{struct}.{p.struct_field_name}"
            for struct, specs in (("event_parameters", self.event_parameters),
                                  ("user_properties", self.user_properties))
            for p in specs if p.rollup_type == "alsoForceNullDimension")

    @property
    def sentinel_events(self) -> tuple[str, ...]:
        """Events of the sentinel rollup. Event parameters alone decide this."""
        names = [name for p in self.event_parameters
                 if p.rollup_type == "alsoForceNullDimension"
                 for name in p.force_null_dimension_event_name_filter]
        return tuple(dict.fromkeys(names))
