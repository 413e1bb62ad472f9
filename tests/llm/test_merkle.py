from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pulsegrain.llm import merkle
from pulsegrain.llm.merkle import fingerprint_report
from tests.llm.cases import DOCUMENTS, clashing, frame, hard_documents, nothing, prose

PIECE = re.compile("[^.!?\n]{1,128}[.!?\n]*|[.!?\n]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(text: str):
    """root, fingerprint, sections' digests, {leaf: length}."""
    sections, paragraphs, leaves, weights = [], [], [], {}
    pieces = PIECE.findall(text)
    assert "".join(pieces) == text
    for i, piece in enumerate(pieces):
        d, last = sha(piece), i == len(pieces) - 1
        leaves.append((d, f"{d[:10]}:{len(piece)}"))
        weights[d[:10], len(piece)] = len(piece)
        if "\n" in piece or last:
            paragraphs.append((sha("".join(x[0] for x in leaves)), " ".join(x[1] for x in leaves)))
            leaves = []
            if "\n\n" in piece or d[0] in "0123" or last:
                sections.append((sha("".join(x[0] for x in paragraphs)), ",".join(x[1] for x in paragraphs)))
                paragraphs = []
    root = sha("".join(x[0] for x in sections))
    return root, root + "".join(f"|{d[:16]}({code})" for d, code in sections), [x[0] for x in sections], weights


def near(a, b) -> float:
    if a[0] == b[0]:
        return 1.0
    return 2 * sum(a[3][k] for k in a[3].keys() & b[3].keys()) / (sum(a[3].values()) + sum(b[3].values()))


def brute(docs: list[tuple]):
    """Documents in order of (falling id, null last); equal ids in the order given."""
    out = []
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        m = len(text) // 3
        edited = text[:len(text) - m] + following[:m]
        one, two = tree(text), tree(edited)
        out.append((doc_id, len(text), sha(edited), one[1], two[1], near(one, two), near(one, tree(following))))
    return out


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.mark.parametrize("range_rows", [2, 7, 2000])
def test_against_brute_force(spark, monkeypatch, range_rows):
    monkeypatch.setattr(merkle, "RANGE_ROWS", range_rows)
    texts = [t for _, t, *_ in hard_documents()]
    texts += ["A b. C d!\n\nE f? G.\nH", "\n\n\n", "...", "x", "xy", "xyz", "a\r\n\x0bb c.\u0085", "é" * 500, "😀" * 400,
              *["\n".join(f"{prose(i * 50 + k, 9)}." for k in range(40)) for i in range(4)]]
    docs = [(3 * i - 40, t, "en", "s", 0) for i, t in enumerate(texts)]
    found = rows(fingerprint_report(clashing(frame(spark, docs))))
    ordered = [(d, t or "") for d, t, *_ in sorted(docs, key=lambda r: -r[0])]
    assert found == sorted(brute(ordered), key=str)


@pytest.mark.parametrize("range_rows", [2, 2000])
def test_equal_ids_repeated_rows_and_null_ids(spark, monkeypatch, range_rows):
    monkeypatch.setattr(merkle, "RANGE_ROWS", range_rows)
    # Rows of equal id have equal texts, so that their order does not matter.
    docs = [(i // 3, f"Text {i // 3}. {prose(i // 3, 20)}") for i in range(30)] + [(None, "none. at all.")] * 2
    found = rows(fingerprint_report(frame(spark, [(d, t, "", "", 0) for d, t in docs])))
    assert found == sorted(brute(sorted(docs, key=lambda r: -1 if r[0] is None else r[0], reverse=True)), key=str)


def test_one_document_no_document_and_null_ids_only(spark):
    one = frame(spark, [(5, "One text. Two.", "", "", 0)])
    assert rows(fingerprint_report(one)) == brute([(5, "One text. Two.")])
    assert fingerprint_report(nothing(one)).count() == 0
    blank = spark.createDataFrame([(None, "a b c.", None, None, None)] * 3, DOCUMENTS)
    assert rows(fingerprint_report(blank)) == brute([(None, "a b c.")] * 3)


def test_equal_texts_have_equal_fingerprints_and_others_do_not(spark):
    texts = ["a.\nb.", "a.b.\n", "a.\n\nb.", "a", "", "a.\nb."]
    found = {r.doc_id: r.fingerprint for r in fingerprint_report(
        frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)])).collect()}
    assert found[0] == found[5] and len(set(found.values())) == 5


def test_edits_are_located_by_section(spark):
    lines = [f"{prose(i, 12)}.\n" for i in range(60)]
    text = "".join(lines)
    changed = text.replace(lines[30], "Something else stands here.\n")
    df = spark.createDataFrame([(text, changed)], "a string, b string")
    trees = merkle.with_tree(merkle.with_tree(df, "a", "a").select("*"), "b", "b")
    edit = trees.select(F.expr(merkle.edited_sections("a", "b")).alias("e"),
                        F.expr(merkle.edited_sections("a", "a")).alias("same"), F.expr(merkle.likeness("a", "b")).alias("near")).first()
    digests = tree(text)[2]
    other = set(tree(changed)[2])
    differing = [i + 1 for i, d in enumerate(digests) if d not in other]
    assert (edit.e.first, edit.e.last) == (differing[0], differing[-1]) and edit.same is None
    assert 0.95 < edit.near < 1


def test_no_python_in_the_plan(spark):
    plan = fingerprint_report(frame(spark, hard_documents()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
