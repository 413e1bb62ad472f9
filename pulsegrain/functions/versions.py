"""Version text: cleaning, parts, sortable number, and back again."""

from __future__ import annotations

from collections.abc import Mapping

from pulsegrain import fixed_values as fv
from pulsegrain.functions.sqltext import literal, struct


def version_found(version: str) -> str:
    """Leading one to three numeric parts; empty when there are none."""
    return f"regexp_extract({version}, {literal(fv.VERSION_PATTERN)}, 1)"


def clean_found(found: str) -> str:
    """A :func:`version_found` with NULL for none. Spark gives a ``nullif`` of more than a column a step of its own."""
    return f"nullif({found}, '')"


def clean_version(version: str) -> str:
    """Leading one to three numeric parts; NULL when there are none."""
    return clean_found(version_found(version))


def version_parts(cleaned: str) -> str:
    # Empty text has one part that is no number, so it may stand for NULL here. An escaped dot is split without a pattern matcher.
    return f"split({cleaned}, '\\\\.')"


def part(cleaned: str, index: int, parts: str | None = None) -> str:
    """``parts`` is a column with the parts, where a caller has made one."""
    return f"try_cast(get({parts or version_parts(cleaned)}, {index}) AS bigint)"


def major_minor(cleaned: str, parts: str | None = None) -> str:
    """As a decimal number, so 17.1 and 17.10 are the same."""
    return (f"try_cast(concat(string({part(cleaned, 0, parts)}), '.', "
            f"string(coalesce({part(cleaned, 1, parts)}, 0))) AS double)")


def _six_digits(number: str) -> str:
    # lpad would cut a longer part, so pad only as far as it is short.
    text = f"string(coalesce({number}, 0))"
    return f"lpad({text}, greatest({fv.VERSION_PART_DIGITS}, length({text})), '0')"


def normalized(cleaned: str, parts: str | None = None) -> str:
    """Sortable integer, six digits per part; NULL if it does not fit."""
    digits = ", ".join(_six_digits(part(cleaned, n, parts)) for n in range(3))
    return f"if({cleaned} IS NOT NULL, try_cast(concat({digits}) AS bigint), NULL)"


def join_value(cleaned: str, version: str, parts: str | None = None) -> str:
    return f"coalesce(string({normalized(cleaned, parts)}), {version})"


KINDS = {
    "major": lambda cleaned: part(cleaned, 0),
    "minor": lambda cleaned: part(cleaned, 1),
    "bugfix": lambda cleaned: part(cleaned, 2),
    "major.minor": major_minor,
    "major.minor.bugfix": lambda cleaned: cleaned,
    "normalized": normalized,
}


def version_as(version: str, kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"unknown version kind {kind!r}; one of {tuple(KINDS)}")
    return KINDS[kind](clean_version(version))


def version_struct(original: str, version: str, cleaned: str,
                   extra: Mapping[str, str] | None = None, parts: str | None = None) -> str:
    """The version record.

    ``version`` is ``original`` without any OS name, ``cleaned`` is its
    cleaned form and ``parts`` that form's parts, passed in so that a caller can
    compute them once per row.
    """
    return struct({"firebase_value": original, **(extra or {}), **version_fields(cleaned, version, parts)})


def version_fields(cleaned: str, version: str, parts: str | None = None) -> dict[str, str]:
    """The fields that follow from the cleaned form, and the join value, by name."""
    return {
        "major": part(cleaned, 0, parts),
        "minor": part(cleaned, 1, parts),
        "bugfix": part(cleaned, 2, parts),
        "major_minor": major_minor(cleaned, parts),
        "major_minor_bugfix": cleaned,
        "normalized": normalized(cleaned, parts),
        "join_value": join_value(cleaned, version, parts),
    }


def version_without_os(os_version: str, os_name: str) -> str:
    return f"replace({os_version}, concat({os_name}, ' '), '')"


def version_from_normalized(text: str) -> str:
    """Version record from a join value.

    The digits are read from the right. Text that is no number, or too short
    (which includes every version with major 0), gives a record of NULLs.
    """
    number = f"try_cast({text} AS bigint)"
    width = fv.VERSION_PART_DIGITS
    usable = f"{number} IS NOT NULL AND length({text}) >= {fv.VERSION_RECORD_MIN_LENGTH}"
    major = f"try_cast(substring({text}, 1, length({text}) - {2 * width}) AS bigint)"
    minor = f"try_cast(substring({text}, {-2 * width}, {width}) AS bigint)"
    bugfix = f"try_cast(substring({text}, {-width}, {width}) AS bigint)"
    short = f"concat(string({major}), '.', string({minor}))"
    values = {
        "major": major,
        "minor": minor,
        "bugfix": bugfix,
        "major_minor": f"try_cast({short} AS double)",
        "major_minor_bugfix": f"concat({short}, '.', string({bugfix}))",
        "normalized": number,
    }
    return struct({field: f"if({usable}, {value}, NULL)" for field, value in values.items()})
