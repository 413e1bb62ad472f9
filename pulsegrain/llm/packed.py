"""Arrays that go to tasks by part number, as bytes in few rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def part_of(values: np.ndarray, n_parts: int) -> np.ndarray:
    """Equal ranges of 64-bit hashes."""
    return (((values >> np.uint64(32)) * np.uint64(n_parts)) >> np.uint64(32)).astype(np.int32)


def cut(parts: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """A stable order by part, and (part, begin, end) in that order."""
    order = np.argsort(parts, kind="stable")
    ranked = parts[order]
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(ranked)) + 1, [len(ranked)]])
    return order, [(int(ranked[a]), a, b) for a, b in
                   zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if b > a]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin, and their lengths."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return at, np.diff(np.append(at, len(values)))


def binary(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows of a part number and arrays, the arrays as bytes."""
    columns = [pa.array([r[0] for r in rows], pa.int32())]
    columns += [pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in range(1, len(names) + 1)]
    return pa.RecordBatch.from_arrays(columns, ["part", *names])


def schema(names: list[str]) -> str:
    return "part int, " + ", ".join(f"{n} binary" for n in names)


def by_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The parts that lie in a task, each with its columns joined."""
    rows: dict[int, list[tuple[bytes, ...]]] = {}
    for batch in batches:
        for part, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows.setdefault(part, []).append(tuple(row))
    for part in list(rows):
        yield part, [b"".join(c) for c in zip(*rows.pop(part), strict=True)]
