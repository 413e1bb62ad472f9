from __future__ import annotations

import zlib

from pulsegrain.llm import toxicity
from tests.llm.cases import clashing, frame, hard_documents, nothing, prose

INSULTS = ("grumbo", "snarfel", "plonker", "dwibble")


def labelled(n: int = 400):
    rows, labels = [], []
    for i in range(n):
        sentences = [prose(100 * i + k, 8) for k in range(6)]
        toxic = i % 4 == 0
        if toxic:
            sentences[i % 6] += f" you {INSULTS[i % 16 // 4]}{'abcdef'[i % 6]} there"
        rows.append((i, ". ".join(sentences) + ".", "en", "a", 1))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_places(spark):
    rows, labels = labelled()
    docs = clashing(frame(spark, rows)).drop("score").withColumnRenamed("rank", "score")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    truth, texts = dict(labels), {r[0]: r[1] for r in rows}
    held = right = 0
    for r in toxicity.scored(docs, model).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if r.held_out:
            held, right = held + 1, right + (r.predicted == truth[r.doc_id])
        for span in r.offending:
            assert any(w in texts[r.doc_id][span.start:span.end] for w in INSULTS)
    assert right / held >= 0.95


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = labelled(120)
    docs = frame(spark, rows)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    one, other = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert one == other


def test_hard_rows_and_missing_labels(spark):
    rows, labels = labelled(80)
    docs = frame(spark, rows + [(1000 + r[0], *r[1:]) for r in hard_documents()])
    known = spark.createDataFrame([*labels, (None, 1), (3, None), (3, 0)], "doc_id long, toxic int")
    found = toxicity.scored(docs, toxicity.fit(docs, known)).collect()
    assert len(found) == len(rows) + len(hard_documents())
    assert all(r.score < 0.5 for r in found if r.doc_id is None or r.doc_id in (1015, 1016, 1017))
    assert toxicity.fit(docs, nothing(known)) is None
    assert {r.score for r in toxicity.scored(docs, None).collect()} == {0.0}
    assert toxicity.scored(nothing(docs), None).count() == 0
