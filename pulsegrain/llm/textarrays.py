"""Words, lines and hashes of many texts at once, as numpy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D. Hashes are 64-bit: a
polynomial over a random table of byte values, taken as differences of one running sum,
and mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  # arrays of 64-bit values over it stay small
_RANDOM = np.random.default_rng(20240601)
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
BASE = 0x9E3779B97F4A7C15
PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & (2**64 - 1)))
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least n of each."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _POWERS["up"] = _powers(BASE, size)
        _POWERS["down"] = _powers(pow(BASE, -1, 2**64), size)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Texts:
    """Some rows of an Arrow batch: row numbers from first, bytes, and where each text begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Cut a string column into runs of rows of about chunk_bytes; a longer text is its own run.

    A null counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1] \
        .astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield Texts(row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row])
        row = end


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]


def words_of(texts: Texts) -> Words:
    solid = NOT_SPACE[texts.data]
    before = np.empty_like(solid)
    before[1:] = solid[:-1]
    after = np.empty_like(solid)
    after[:-1] = solid[1:]
    filled = texts.offsets[:-1] < texts.offsets[1:]
    before[texts.offsets[:-1][filled]] = False
    after[texts.offsets[1:][filled] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


def running(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """Running sum of the polynomial: element i covers the bytes before i."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[:len(data)], out=out[1:])
    return out


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end, the same wherever they stand."""
    _, down = powers(len(total))
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n words in a row, in order."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[:len(words) - n + 1] * PLACE[0]
    for j in range(1, n):
        out = out + words[j:len(words) - n + 1 + j] * PLACE[j]
    return mix(out)


def short_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole sequence that is shorter than a gram."""
    value = np.sum(words * PLACE[32:32 + len(words)], dtype=np.uint64) + np.uint64(len(words))
    return mix(np.array([value], np.uint64))[0]
