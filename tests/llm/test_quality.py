from __future__ import annotations

import re
from collections import Counter

from pulsegrain.llm.quality import estimate, filter_quality, posterior, quality_verdicts
from tests.llm.cases import clashing, frame, hard_documents, nothing, prose


def brute(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    counts, hit = Counter(grams), set()
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            hit |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), again, len(hit)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def junk() -> list[tuple]:
    good = [(1000 + i, "A. " + re.sub("[0-9]", "", prose(i, 90)), "en", "a", 1) for i in range(40)]
    loud = [(2000 + i, " ".join(w.upper() + "!!" for w in re.sub("[0-9]", "", prose(i, 90)).split()), "en", "a", 1)
            for i in range(8)]
    marked = [(3000 + i, " ".join(w + "%%%" for w in prose(i, 90).split()), "en", "a", 1) for i in range(8)]
    return good + loud + marked


def test_counts_match_brute_force(spark):
    rows = hard_documents() + junk()
    found = quality_verdicts(clashing(frame(spark, rows)), ["doc_id"]).collect()
    expected = Counter((r[0], *brute(r[1])) for r in rows)
    assert Counter((r.doc_id, *[r[c] for c in COLUMNS]) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rules_tell_junk_from_prose(spark):
    docs = clashing(frame(spark, junk()))
    kept = {r.doc_id for r in quality_verdicts(docs, ["doc_id"]).where("kept").collect()}
    assert kept == {r[0] for r in junk() if r[0] < 2000}
    filtered = filter_quality(docs)
    assert filtered.columns == docs.columns
    assert {r.doc_id for r in filtered.collect()} == kept


def test_empty_table(spark):
    docs = nothing(frame(spark, hard_documents()))
    assert quality_verdicts(docs, ["doc_id"]).count() == 0
    assert filter_quality(docs).count() == 0


def test_estimate_finds_reliable_rules():
    patterns = [((1, 1, 1), 800), ((-1, -1, 0), 150), ((1, -1, 0), 10), ((-1, 1, 1), 10)]
    share, tables = estimate(patterns)
    assert posterior((1, 1, 1), share, tables) > 0.99 > 0.01 > posterior((-1, -1, 0), share, tables)
