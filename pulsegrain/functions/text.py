"""Small text helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pulsegrain.functions.sqltext import literal


def reverse_dotted(dotted: str) -> str:
    """``com.example.app`` -> ``app.example.com``."""
    # An escaped dot is split without a pattern matcher.
    return f"array_join(reverse(split({dotted}, '\\\\.')), '.')"


def null_if_empty(text: str) -> str:
    return f"nullif({text}, '')"


def first_tag_part(tag: str) -> str:
    return f"get(split({tag}, '-'), 0)"


def last_tag_part(tag: str) -> str:
    """Last part of a language tag; of a one-part tag that is the whole tag."""
    return f"try_element_at(split({tag}, '-'), -1)"


def platform_of_shard(suffix: str) -> str:
    return (f"CASE WHEN {suffix} LIKE '%ANDROID%' THEN 'ANDROID' "
            f"WHEN {suffix} LIKE '%IOS%' THEN 'IOS' ELSE 'UNKNOWN' END")


def in_name_list(column: str, names: Iterable[str]) -> str:
    """True for the listed names; an entry ``LIKE '<pattern>'`` is a pattern.

    An empty list accepts every row.
    """
    names = list(names)
    tests = [f"{column} {n}" for n in names if n.lower().startswith("like ")]
    exact = [literal(n) for n in names if not n.lower().startswith("like ")]
    if exact:
        tests.insert(0, f"{column} IN ({', '.join(exact)})")
    return f"({' OR '.join(tests)})" if tests else "true"
