from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from pulsegrain.llm import substrings
from pulsegrain.llm.packed import part_of
from pulsegrain.llm.substrings import without_repeats
from pulsegrain.llm.suffix_groups import suffix_array
from pulsegrain.llm.textarrays import Texts
from tests.llm.cases import clashing, frame, hard_documents, nothing, prose


def brute(rows: list[tuple]) -> dict[int | None, list[tuple]]:
    """Windows in a dictionary; of rows with the same id each is judged by itself."""
    seen: dict[bytes, tuple[int, int]] = {}
    for doc_id, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        for i in range(len(data) - 99):
            seen.setdefault(data[i:i + 100], (doc_id, i))
    out: dict[int | None, list[tuple]] = {}
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        gone, reach, spans = bytearray(len(data)), 0, 0
        for i in range(len(data) - 99 if doc_id is not None else 0):
            if seen[data[i:i + 100]] < (doc_id, i):
                spans += i > reach or not spans
                reach = i + 100
                gone[i:i + 100] = b"\x01" * 100
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        out.setdefault(doc_id, []).append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages() -> list[tuple]:
    pick = random.Random(4)
    shared = [prose(i, 40) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(100 + i, 10)]
        for _ in range(pick.randrange(4)):
            text = pick.choice(shared)
            a = pick.randrange(len(text) // 2)
            parts += [text[a:a + pick.choice((90, 99, 100, 101, 130, 400))], prose(pick.randrange(9999), 5)]
        rows.append((3000 + i, " ".join(parts), "en", "a", 1))
    copies = [(4000 + i, shared[0] * 2, "en", "a", 1) for i in range(150)]
    odd = [(5000, "ab" * 300), (5001, "x" * 99), (5002, "x" * 100), (5003, "x" * 101), (5004, "é" * 60),
           (5005, "z" + "é" * 60), (5006, bytes(range(128)).decode() * 2)]
    return rows + copies + [(i, t, "en", "a", 1) for i, t in odd]


def test_matches_brute_force(spark):
    rows = passages() + hard_documents()
    found: dict[int | None, list[tuple]] = {}
    for r in without_repeats(clashing(frame(spark, rows))).collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        found.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in brute(rows).items()}


def test_long_text_in_segments_and_small_flushes(spark, monkeypatch):
    """Anchors do not depend on how a text is cut."""
    import pyarrow as pa

    text = prose(9, 3000)
    column = pa.array([text, text[50:5000]])
    whole = [substrings.anchors_of(t) for t in substrings.texts_of(column)]
    monkeypatch.setattr(substrings, "SEGMENT", 777)
    cut = [substrings.anchors_of(t) for t in substrings.texts_of(column, 1)]

    def windows(parts):
        return {(r, p, b, h) for a in parts for r, p, lo, hi, h in zip(
            a.rows.tolist(), a.places.tolist(), a.low.tolist(), a.high.tolist(), a.hashes.tolist(), strict=True)
            for b in range(lo, hi + 1)}

    assert windows(whole) == windows(cut)
    assert len(windows(whole)) == sum(len(t) - 99 for t in column.to_pylist())


def results(spark, rows):
    found: dict[int | None, list[tuple]] = {}
    for r in without_repeats(frame(spark, rows)).collect():
        found.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    return {k: sorted(v) for k, v in found.items()}


def test_anchor_with_many_surroundings_is_split(spark, monkeypatch):
    """A line that all documents hold, each with other text around it, is in no task whole."""
    compared = substrings.later_windows

    def few(bytes_, ids, *others):
        assert len(ids) <= 250, len(ids)
        return compared(bytes_, ids, *others)

    monkeypatch.setattr(substrings, "later_windows", few)
    monkeypatch.setattr(substrings, "COMPARED_SIDES", 50)
    monkeypatch.setattr(substrings, "HOT_SIDES", 100, raising=False)
    line = "all rights reserved by the owners of this page, whoever they are"
    rows = [(i, f"{prose(9000 + i, 12)} {line} {prose(20000 + i, 12)}", "en", "a", 1) for i in range(400)]
    rows += [(1000 + i, t, "en", "a", 1) for i, (_, t, *_) in enumerate(rows[:30])]
    assert results(spark, rows) == {k: sorted(v) for k, v in brute(rows).items()}


def test_all_anchors_split_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_SIDES", 1, raising=False)
    monkeypatch.setattr(substrings, "FLUSH_WINDOWS", 3000, raising=False)
    rows = passages() + hard_documents()
    assert results(spark, rows) == {k: sorted(v) for k, v in brute(rows).items()}


def test_empty_table(spark):
    assert without_repeats(nothing(frame(spark, hard_documents()))).count() == 0


@pytest.mark.parametrize("alphabet", [1, 2, 3, 6])
def test_suffix_array_is_sorted(alphabet):
    random_ = np.random.default_rng(alphabet)
    for n in range(120):
        text = random_.integers(0, alphabet, n).tolist() * (1 + n % 3)
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_anchors_fall_evenly_into_parts():
    data = np.random.default_rng(7).integers(32, 127, 1 << 17, dtype=np.uint8)
    found = substrings.anchors_of(Texts(0, data, np.array([0, len(data)])))
    times = np.bincount(part_of(found.hashes, 16), minlength=16)
    assert len(found.hashes) > 2000 and times.max() < 1.5 * times.mean()
