from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from pulsegrain.llm.mixing import mix_report, mixed
from tests.llm.cases import clashing, frame, hard_documents, nothing, prose


def targets_of(rows):
    """Shares by weight, capped at twice a source's size, by repeated resharing."""
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall("[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > 2 * sizes[s]}
        if not full:
            return sizes, out | {s: unit * weights[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return sizes, out


def many() -> list[tuple]:
    return [(i, prose(i, 5 + i % 40), "en", "big" if i % 3 else f"s{i % 7}", 1) for i in range(600)]


def test_targets_and_taken(spark):
    rows = many() + [(9000 + r[0], *r[1:]) for r in hard_documents()]
    found = mix_report(clashing(frame(spark, rows))).collect()
    assert len(found) == len(rows)
    sizes, targets = targets_of(rows)
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], abs=1e-6)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    longest = max(r.size for r in found)
    for s, target in targets.items():
        assert abs(taken[s] - target) <= (longest if s is None or s.startswith("src") else 100)
    assert sum(taken.values()) <= sum(targets.values()) + 1e-6


def test_reruns_agree_and_rows_follow(spark):
    docs = clashing(frame(spark, many()))
    first = {r.doc_id: r.taken for r in mix_report(docs).collect()}
    assert first == {r.doc_id: r.taken for r in mix_report(docs.repartition(7)).collect()}
    out = mixed(docs)
    assert out.columns == docs.columns
    sizes = {r[0]: len(r[1].split()) for r in many()}
    assert {k: n * sizes[k] for k, n in Counter(r.doc_id for r in out.collect()).items()} == {
        k: v for k, v in first.items() if v}


def test_repeated_rows(spark):
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, "d e", "en", None, 3)]
    report = mix_report(frame(spark, rows)).collect()
    assert len(report) == 3
    words = sum(r.taken for r in report)
    assert sum(len(r.text.split()) for r in mixed(frame(spark, rows)).collect()) == words


def test_empty_table(spark):
    docs = nothing(frame(spark, many()))
    assert mix_report(docs).count() == mixed(docs).count() == 0
