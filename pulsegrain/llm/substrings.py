"""Removal of repeated byte strings of WINDOW bytes, by suffix arrays.

Every window of WINDOW bytes has an anchor, its GRAM-byte string with the smallest hash, the
leftmost of equals; equal windows have equal anchors at equal places. Anchors that occur once
are dropped by a first exchange of hashes, so only passages that may repeat go on. Each of
their anchors goes, with the bytes around it that its windows can reach, to the task of its
hash. There the distinct right sides are sorted by the suffix array of their sequence of
blocks, and so are the left sides, read backwards. Two windows are equal where no smaller
common prefix lies between their anchors' sides in either array. Of equal windows all but the
first are removed.

An anchor with more than HOT_SIDES different surroundings would be too much for one task. Its
windows go by 128-bit hashes of all their bytes instead, each task sending one place of each.

A task keeps one entry of surroundings that it sees several times and settles the others
itself, so copies, however many, cost one row for each task. All numbers between the steps are
packed arrays. The suffix array (suffix_groups) is over blocks of 20 and 17 bytes, not single
bytes: an interpreter takes some 8 microseconds for each of its symbols.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.packed import binary, by_parts, cut, part_of, runs, schema
from pulsegrain.llm.shared import partitions, written
from pulsegrain.llm.suffix_groups import suffix_array
from pulsegrain.llm.textarrays import BYTE_VALUES, Texts, mix, powers, texts_of

WINDOW = 100
GRAM = 32
REACH = WINDOW - GRAM  # bytes that a window can have before its anchor
RIGHT_BLOCK, LEFT_BLOCK = 20, 17
SEGMENT = 4 << 20  # a longer text is read in segments
PLACE_BITS = np.uint64(24)
FLUSH_ANCHORS = 1 << 18
FLUSH_SIDES = 1 << 18  # about 44 MB of surroundings
SENT_SIDES = 1 << 14
FLUSH_WINDOWS = 1 << 19
HOT_SIDES = 1 << 16  # surroundings of an anchor, summed over the flushes of all tasks
COMPARED_SIDES = 1 << 13  # anchors compared at once; more only for a single anchor


@dataclass
class Anchors:
    """Hash, row, place in the row's bytes, the least and greatest bytes before the anchor in
    those windows that it is the anchor of, and a hash of the bytes around it, to count by."""

    hashes: np.ndarray
    rows: np.ndarray
    places: np.ndarray
    low: np.ndarray
    high: np.ndarray
    around: np.ndarray


def _segments(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, offsets of the texts in them, and where the first text goes on."""
    if len(texts) > 1 or len(texts.data) <= SEGMENT + WINDOW:
        yield texts.data, texts.offsets, 0
        return
    for begin in range(0, len(texts.data) - WINDOW + 1, SEGMENT):
        data = texts.data[begin:begin + SEGMENT + WINDOW - 1]
        yield data, np.array([0, len(data)]), begin


def anchors_of(texts: Texts) -> Anchors:
    parts = []
    for data, offsets, begin in _segments(texts):
        if len(data) < WINDOW:
            continue
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[:len(data)], out=total[1:])
        n = len(data) - GRAM + 1
        hashes = mix((total[GRAM:] - total[:n]) * down[:n])
        least = (hashes >> PLACE_BITS << PLACE_BITS) | np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = REACH + 1 - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        # Windows that lie in one text.
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        starts = np.flatnonzero(row[:len(data) - WINDOW + 1] == row[WINDOW - 1:])
        if not len(starts):
            continue
        chosen = (least[starts] & np.uint64((1 << 24) - 1)).astype(np.int64)
        at, lengths = runs(chosen)
        place = chosen[at]
        first, last = starts[at], starts[at + lengths - 1]
        own = row[first]
        a, b = np.maximum(place - REACH, offsets[own]), np.minimum(place + WINDOW, offsets[own + 1])
        around = mix((total[b] - total[a]) * down[a] + (place - a).astype(np.uint64))
        # Least hashes are small numbers; mixed again, they fall evenly into the parts.
        parts.append(Anchors(mix(hashes[place]), own + texts.first, place - offsets[own] + begin,
                             place - last, place - first, around))
    if not parts:
        empty = np.zeros(0, np.int64)
        return Anchors(empty.astype(np.uint64), empty, empty, empty, empty, empty.astype(np.uint64))
    return Anchors(*[np.concatenate([getattr(p, k) for p in parts])
                     for k in ("hashes", "rows", "places", "low", "high", "around")])


HITS = ["kind", "hashes", "docs", "places", "counts"]
FOUND = ["docs", "places", "hot"]


def _codes(hashes: np.ndarray, n_parts: int) -> np.ndarray:
    """Part and the lower half of each hash, which is what a part's task has of it."""
    return part_of(hashes, n_parts).astype(np.int64) << 32 | (hashes & np.uint64(2**32 - 1)).astype(np.int64)


def repeated_places(docs: DataFrame, n_parts: int) -> DataFrame:
    """doc_id, places: the anchors of each document that occur elsewhere too. Rows without
    doc_id have the codes of the anchors with more than HOT_SIDES surroundings."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            hashes, ids, places, around = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((around, hashes))
            hashes, ids, places, around = hashes[order], ids[order], places[order], around[order]
            at, lengths = runs(hashes)
            new = np.ones(len(hashes), np.int64)
            new[1:] = (hashes[1:] != hashes[:-1]) | (around[1:] != around[:-1])
            counts = np.add.reduceat(new, at).astype(np.uint32)
            rows = []
            # Hashes seen several times here are repeated; one of each still tells other tasks.
            several = np.repeat(lengths > 1, lengths)
            for part, a, b in cut(part_of(hashes[at], n_parts))[1]:
                one = at[a:b]
                rows.append((part, np.zeros(b - a, np.uint8), hashes[one].astype(np.uint32), ids[one],
                             places[one].astype(np.uint32), counts[a:b]))
            order, cuts = cut(part_of(mix(ids[several].view(np.uint64)), n_parts))
            mine, there = ids[several][order], places[several][order]
            for part, a, b in cuts:
                rows.append((part, np.ones(b - a, np.uint8), np.zeros(b - a, np.uint32), mine[a:b],
                             there[a:b].astype(np.uint32), np.zeros(0, np.uint32)))
            return binary(rows, HITS)

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for texts in texts_of(batch.column(1)):
                found = anchors_of(texts)
                if len(found.rows):
                    held.append((found.hashes, ids[found.rows], found.places, found.around))
                    n += len(found.rows)
                if n >= FLUSH_ANCHORS:
                    yield flush()
                    n = 0
        if n:
            yield flush()

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, (kind, hashes, ids, places, counts) in by_parts(batches):
            known = np.frombuffer(kind, np.uint8) == 1
            hashes, ids = np.frombuffer(hashes, np.uint32), np.frombuffer(ids, np.int64)
            places = np.frombuffer(places, np.uint32)
            distinct, index, times = np.unique(hashes[~known], return_inverse=True, return_counts=True)
            several = times[index] > 1
            sides = np.bincount(index, np.frombuffer(counts, np.uint32), len(distinct))
            hot = own << 32 | distinct[sides > HOT_SIDES].astype(np.int64)
            ids = np.concatenate([ids[known], ids[~known][several]])
            places = np.concatenate([places[known], places[~known][several]])
            order, cuts = cut(part_of(mix(ids.view(np.uint64)), n_parts))
            ids, places = ids[order], places[order]
            rows = [(part, ids[a:b], places[a:b], hot[:0]) for part, a, b in cuts]
            if len(hot):
                rows.append((own, ids[:0], places[:0], hot))
            yield binary(rows, FOUND)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (ids, places, hot) in by_parts(batches):
            if hot:
                hot = np.frombuffer(hot, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.ListArray.from_arrays(
                    pa.array([0, len(hot)], pa.int32()), pa.array(hot))], ["doc_id", "places"])
            ids, places = np.frombuffer(ids, np.int64), np.frombuffer(places, np.uint32).astype(np.int64)
            order = np.lexsort((places, ids))
            ids, places = ids[order], places[order]
            if not len(ids):
                continue
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (places[1:] != places[:-1])
            ids, places = ids[new], places[new]
            at, lengths = runs(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.ListArray.from_arrays(
                    pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(places))], ["doc_id", "places"])

    hashed = docs.mapInArrow(split, schema(HITS)).repartitionById(n_parts, F.col("part"))
    matched = hashed.mapInArrow(match, schema(FOUND)).repartitionById(n_parts, F.col("part"))
    return matched.mapInArrow(gather, "doc_id long, places array<long>")


def _surroundings(texts: Texts, found: Anchors, at: np.ndarray) -> np.ndarray:
    """The REACH bytes before and WINDOW bytes from each chosen anchor on, 0 outside its text."""
    out = np.zeros((len(at), REACH + WINDOW), np.uint8)
    for a in range(0, len(at), 4096):
        row = found.rows[at[a:a + 4096]] - texts.first
        place = found.places[at[a:a + 4096]] + texts.offsets[row]
        index = place[:, None] + np.arange(-REACH, WINDOW)
        inside = (index >= texts.offsets[row][:, None]) & (index < texts.offsets[row + 1][:, None])
        out[a:a + 4096][inside] = texts.data[index[inside]]
    return out


def _rank_classes(sides: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row of bytes its place among the sorted distinct rows, and the common prefix of
    each distinct row with the one before it.

    The distinct rows, cut into blocks, are one text of block symbols with an end mark behind
    each row; its suffix array has the rows in order.
    """
    width = sides.shape[1]
    numbers: dict[bytes, int] = {}
    data = np.ascontiguousarray(sides).tobytes()
    index = np.array([numbers.setdefault(data[i:i + width], len(numbers))
                      for i in range(0, len(data), width)], np.int64)
    rows = np.frombuffer(b"".join(numbers), np.uint8).reshape(-1, width)
    per_row = width // block
    cells = rows.reshape(-1, block).view(np.dtype((np.void, block))).ravel()
    _, symbols = np.unique(cells, return_inverse=True)  # block numbers in byte order
    text = np.zeros((len(rows), per_row + 1), np.int64)
    text[:, :per_row] = symbols.reshape(-1, per_row) + 1
    suffixes = np.array(suffix_array(text.ravel().tolist()), np.int64)
    order = suffixes[suffixes % (per_row + 1) == 0] // (per_row + 1)
    ranked = rows[order]
    differs = ranked[1:] != ranked[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    place = np.empty(len(rows), np.int64)
    place[order] = np.arange(len(rows))
    return place[index], np.concatenate([[-1], common])


def later_windows(bytes_: np.ndarray, ids: np.ndarray, places: np.ndarray, low: np.ndarray,
                  high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of the runs of windows that are not the first of their kind."""
    order = np.lexsort((places, ids))
    bytes_, ids, places, low, high = bytes_[order], ids[order], places[order], low[order], high[order]
    right, right_common = _rank_classes(bytes_[:, REACH:], RIGHT_BLOCK)
    left, left_common = _rank_classes(bytes_[:, :REACH][:, ::-1], LEFT_BLOCK)
    flags = np.zeros((len(ids), REACH + 2), bool)
    for before in range(REACH + 1):
        rows = np.flatnonzero((low <= before) & (before <= high))
        if len(rows) < 2:
            continue
        right_class = np.cumsum(right_common < WINDOW - before)[right[rows]]
        left_class = np.cumsum(left_common < before)[left[rows]]
        key = right_class * (len(left_common) + 1) + left_class
        ranked = np.argsort(key, kind="stable")
        at, lengths = runs(key[ranked])
        first = np.repeat(rows[ranked[at]], lengths)
        mine = rows[ranked]
        # A repeated row of the same document is not earlier.
        flags[mine, before] = (ids[mine] != ids[first]) | (places[mine] != places[first])
    edge = np.diff(np.concatenate([np.zeros((len(ids), 1), np.int8), flags.astype(np.int8)], axis=1), axis=1)
    row, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return ids[row], places[row] - (end - 1), places[row] - begin + WINDOW


SIDES = ["kind", "docs", "places", "low", "high", "bytes", "marks"]
SPANS = ["docs", "starts", "ends"]


def _window_marks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128-bit hashes of the WINDOW bytes at each start."""
    out = np.empty((len(starts), 2), np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)
    for a in range(0, len(starts), 8192):
        some = np.zeros((min(8192, len(starts) - a), -(-WINDOW // 8) * 8), np.uint8)
        some[:, :WINDOW] = windows[starts[a:a + 8192]]
        one = np.full(len(some), 1, np.uint64)
        two = np.full(len(some), 2, np.uint64)
        for word in some.view(np.uint64).T:
            one = mix(one + word)
            two = mix((two ^ word) * np.uint64(0x9E3779B97F4A7C15))
        out[a:a + 8192, 0], out[a:a + 8192, 1] = one, two
    return out


def _later_marks(marks: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are the first of their mark, one of each, and rows that are later ones."""
    order = np.lexsort((places, ids, marks[:, 1], marks[:, 0]))
    ranked = marks[order]
    new = np.ones(len(order), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    first = order[np.flatnonzero(new)]
    origin = first[np.cumsum(new) - 1]
    later = (ids[order] != ids[origin]) | (places[order] != places[origin])
    return first, order[later]


def _row_hashes(sides: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    words = sides.view(np.uint64)
    out = mix((low << 8 | high).astype(np.uint64))
    for k in range(words.shape[1]):
        out = mix(out + words[:, k])
    return out


def _same_rows(sides: np.ndarray, origin: np.ndarray) -> np.ndarray:
    same = np.empty(len(origin), bool)
    for a in range(0, len(origin), 8192):
        same[a:a + 8192] = (sides[a:a + 8192] == sides[origin[a:a + 8192]]).all(axis=1)
    return same


def _by_anchor(sides: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of whole anchors, COMPARED_SIDES or a few more at a time."""
    grams = np.ascontiguousarray(sides[:, REACH:REACH + GRAM]).view(np.uint64)
    key = mix(grams[:, 0] + mix(grams[:, 1] + mix(grams[:, 2] + mix(grams[:, 3]))))
    order = np.argsort(key, kind="stable")
    at, _ = runs(key[order])
    begin = 0
    while begin < len(order):
        after = np.searchsorted(at, begin + COMPARED_SIDES)
        end = int(at[after]) if after < len(at) else len(order)
        yield order[begin:end]
        begin = end


def removed_spans(docs: DataFrame, hits: DataFrame, n_parts: int) -> DataFrame:
    """doc_id, starts, ends: the byte runs of each document that go."""
    # At most one for HOT_SIDES anchors.
    hot = np.array([c for r in hits.where("doc_id IS NULL").select("places").collect() for c in r.places], np.int64)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            hashes, ids, places, low, high, sides = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((places, ids))
            keys = _row_hashes(sides, low, high)
            _, first, index = np.unique(keys[order], return_index=True, return_inverse=True)
            origin = np.empty(len(order), np.int64)
            origin[order] = order[first[index]]
            same = _same_rows(sides, origin) & (low == low[origin]) & (high == high[origin])
            rows, none = [], np.zeros(0, np.uint8)
            sent = np.flatnonzero((origin == np.arange(len(origin))) | ~same)
            by_part, cuts = cut(part_of(hashes[sent], n_parts))
            sent = sent[by_part]
            size = 0
            for part, a, b in cuts:
                if size > SENT_SIDES:  # copies of all surroundings at once would be the peak of a worker
                    yield binary(rows, SIDES)
                    rows, size = [], 0
                size += b - a
                at = sent[a:b]
                rows.append((part, np.zeros(b - a, np.uint8), ids[at], places[at].astype(np.uint32),
                             low[at].astype(np.uint8), high[at].astype(np.uint8), sides[at], none))
            # A later anchor with the same surroundings is settled here, unless it is the same
            # place of a repeated row.
            gone = np.flatnonzero(same & ((ids != ids[origin]) | (places != places[origin])))
            order, cuts = cut(part_of(mix(ids[gone].view(np.uint64)), n_parts))
            gone = gone[order]
            for part, a, b in cuts:
                at = gone[a:b]
                rows.append((part, np.ones(b - a, np.uint8), ids[at], places[at].astype(np.uint32),
                             low[at].astype(np.uint8), high[at].astype(np.uint8), none, none))
            yield binary(rows, SIDES)

        windows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_windows = 0

        def flush_windows() -> pa.RecordBatch:
            marks, ids, places = (np.concatenate(c) for c in zip(*windows, strict=True))
            windows.clear()
            rows, none = [], np.zeros(0, np.uint8)
            sent, gone = _later_marks(marks, ids, places)
            for kind, chosen, keys in ((2, sent, marks[sent, 0]), (1, gone, mix(ids[gone].view(np.uint64)))):
                order, cuts = cut(part_of(keys, n_parts))
                chosen = chosen[order]
                for part, a, b in cuts:
                    at, zero = chosen[a:b], np.zeros(b - a, np.uint8)
                    rows.append((part, zero + np.uint8(kind), ids[at], places[at].astype(np.uint32), zero, zero,
                                 none, marks[at] if kind == 2 else none))
            return binary(rows, SIDES)

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(2)
            for texts in texts_of(batch.column(1)):
                found = anchors_of(texts)
                if not len(found.rows):
                    continue
                wanted = lists.slice(texts.first, len(texts))
                keys = np.repeat(np.arange(len(texts)), wanted.value_lengths().to_numpy())
                chosen = np.isin((found.rows - texts.first) << 40 | found.places,
                                 keys << 40 | wanted.flatten().to_numpy())
                at = np.flatnonzero(chosen)
                if len(hot):
                    is_hot = np.isin(_codes(found.hashes[at], n_parts), hot)
                    at, split_up = at[~is_hot], at[is_hot]
                    for a in range(0, len(split_up), 4096):
                        some = split_up[a:a + 4096]
                        times = found.high[some] - found.low[some] + 1
                        every = np.repeat(some, times)
                        before = found.low[every] + np.arange(len(every)) - np.repeat(np.cumsum(times) - times, times)
                        row, start = found.rows[every], found.places[every] - before
                        marks = _window_marks(texts.data, start + texts.offsets[row - texts.first])
                        windows.append((marks, ids[row], start))
                        n_windows += len(every)
                        if n_windows >= FLUSH_WINDOWS:
                            yield flush_windows()
                            n_windows = 0
                for a in range(0, len(at), FLUSH_SIDES):
                    some = at[a:a + FLUSH_SIDES]
                    held.append((found.hashes[some], ids[found.rows[some]], found.places[some],
                                 found.low[some], found.high[some], _surroundings(texts, found, some)))
                    n += len(some)
                    if n >= FLUSH_SIDES:
                        yield from flush()
                        n = 0
        if n:
            yield from flush()
        if n_windows:
            yield flush_windows()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (kind, ids, places, low, high, sides, marks) in by_parts(batches):
            kind = np.frombuffer(kind, np.uint8)
            known = kind == 1
            ids, places = np.frombuffer(ids, np.int64), np.frombuffer(places, np.uint32).astype(np.int64)
            low = np.frombuffer(low, np.uint8).astype(np.int64)
            high = np.frombuffer(high, np.uint8).astype(np.int64)
            spans = [(ids[known], places[known] - high[known], places[known] - low[known] + WINDOW)]
            sides = np.frombuffer(sides, np.uint8).reshape(-1, REACH + WINDOW)
            single = np.flatnonzero(kind == 2)
            _, later = _later_marks(np.frombuffer(marks, np.uint64).reshape(-1, 2), ids[single], places[single])
            later = single[later]
            spans.append((ids[later], places[later], places[later] + WINDOW))
            open_ = np.flatnonzero(kind == 0)
            for some in _by_anchor(sides):
                at = open_[some]
                spans.append(later_windows(sides[some], ids[at], places[at], low[at], high[at]))
            ids, starts, ends = (np.concatenate(c) for c in zip(*spans, strict=True))
            order, cuts = cut(part_of(mix(ids.view(np.uint64)), n_parts))
            ids, starts, ends = ids[order], starts[order], ends[order]
            yield binary([(part, ids[a:b], starts[a:b], ends[a:b]) for part, a, b in cuts], SPANS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in by_parts(batches):
            ids, starts, ends = (np.frombuffer(c, np.int64) for c in columns)
            if not len(ids):
                continue
            order = np.lexsort((starts, ids))
            ids, starts, ends = ids[order], starts[order], ends[order]
            # The furthest end so far in the same document: documents are set far apart.
            at, lengths = runs(ids)
            far = int(ends.max()) + 1
            shift = np.repeat(np.arange(len(at)), lengths) * far
            reach = np.maximum.accumulate(ends + shift)
            new = np.ones(len(ids), bool)
            new[1:] = starts[1:] + shift[1:] > reach[:-1]
            new[at] = True
            heads = np.flatnonzero(new)
            lasts = np.append(heads[1:], len(ids)) - 1
            at, _ = runs(ids[heads])
            bounds = pa.array(np.append(at, len(heads)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[heads][at]), pa.ListArray.from_arrays(bounds, pa.array(starts[heads])),
                 pa.ListArray.from_arrays(bounds, pa.array(reach[lasts] - shift[lasts]))],
                ["doc_id", "starts", "ends"])

    rows = docs.join(hits, "doc_id").select("doc_id", "text", "places")
    sides = rows.mapInArrow(split, schema(SIDES)).repartitionById(n_parts, F.col("part"))
    spans = sides.mapInArrow(compare, schema(SPANS)).repartitionById(n_parts, F.col("part"))
    return spans.mapInArrow(merge, "doc_id long, starts array<long>, ends array<long>")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, kept (the bytes left), n_bytes, n_removed, n_spans, kept_sha256 of each row.

    A byte goes where some string of WINDOW bytes over it starts earlier too: in a document with
    a smaller id, or before it in the same one; strings are judged on the texts as they are.
    Null texts are empty. Rows without doc_id take no part and stay whole. Rows with the same
    doc_id are one document: none is earlier than the other at the same place. Other columns are
    ignored whatever their names; an empty table gives no rows.
    """
    n_parts = partitions(docs.sparkSession)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    known = rows.where("doc_id IS NOT NULL AND octet_length(text) >= " + str(WINDOW))
    hits = written(repeated_places(known, n_parts), "hits")
    gone = written(removed_spans(known, hits, n_parts), "gone")
    joined = rows.join(gone.withColumnRenamed("doc_id", "id"), F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", "text", "starts", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 500) for b in batches for i in range(0, len(b), 500)):
            out = {k: [] for k in ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for value, starts, ends in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                data = value.encode("utf-8", "surrogatepass")
                kept, at = [], 0
                for a, b in zip(starts or (), ends or (), strict=True):
                    kept.append(data[at:a])
                    at = b
                left = b"".join([*kept, data[at:]])
                out["kept"].append(left)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(left))
                out["n_spans"].append(len(starts or ()))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["kept"], pa.binary()),
                 *[pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")],
                 pa.array(out["kept_sha256"], pa.string())], ["doc_id", *out])

    return joined.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, "
                             "kept_sha256 string")
