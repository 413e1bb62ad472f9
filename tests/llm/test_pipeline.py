from __future__ import annotations

import __spark_entry__
import corpus_pipeline
from pulsegrain.llm.mixing import mix_report
from pulsegrain.llm.quality import quality_verdicts
from pulsegrain.llm.similar import similar_documents
from tests.conftest import SMALL
from tests.llm.cases import clashing, frame, hard_documents, nothing


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "similar", "private", "mixing", "tokens"]
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)

    def ids(df):
        assert sorted(df.columns) == sorted(columns)
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    one = stage["quality"](spark, docs, SMALL)
    assert ids(one) == sorted(r.doc_id for r in quality_verdicts(docs, ["doc_id"]).where("kept").collect())
    two = stage["similar"](spark, one, SMALL)
    assert ids(two) == sorted(r.doc_id for r in similar_documents(one).where("doc_id = component_id").collect())
    three = stage["private"](spark, two, SMALL)
    assert ids(three) == ids(two)
    four = stage["mixing"](spark, three, SMALL)
    assert ids(four) == sorted(r.doc_id for r in mix_report(three).where("taken > 0").collect()
                               for _ in range(r.taken // r["size"]))


def test_whole_run(spark):
    out = __spark_entry__.queries()["pipeline"](spark, SMALL).collect()
    assert out and all(r.round_trip for r in out)


def test_stages_on_hard_rows_and_empty_tables(spark):
    rows = hard_documents()
    docs = frame(spark, rows)
    stage = dict(corpus_pipeline.STAGES)

    def run(name):
        assert stage[name](spark, nothing(docs), SMALL).count() == 0, name
        plain, clash = (stage[name](spark, d, SMALL) for d in (docs, clashing(docs)))
        assert plain.columns == clash.columns
        found = sorted(map(tuple, plain.collect()), key=str)
        assert found == sorted(map(tuple, clash.collect()), key=str), name
        return found

    def ids(found):
        return sorted(r[0] for r in found)

    assert ids(run("quality")) == sorted(r.doc_id for r in quality_verdicts(docs, ["doc_id"]).where("kept").collect())
    # One of each group, one of repeated rows, and every row without words.
    groups = similar_documents(docs).where("n_shingles > 0 AND doc_id = component_id").distinct().collect()
    wordless = [r[0] for r in rows if not (r[1] or "").split()]
    assert ids(run("similar")) == sorted([r.doc_id for r in groups] + wordless)
    private = run("private")
    assert ids(private) == sorted(r[0] for r in rows)
    assert {r[0] for r in private if r[1] is None} == {r[0] for r in rows if r[1] is None}
    assert ids(run("mixing")) == sorted(r.doc_id for r in mix_report(docs).where("taken > 0").collect()
                                        for _ in range(r.taken // r["size"]))
    tokens = run("tokens")
    assert ids(tokens) == sorted(r[0] for r in rows)
    assert {r[0] for r in tokens if not r[1]} == {r[0] for r in rows if not r[1]} and all(r[3] for r in tokens)


def test_a_document_taken_twice_is_cut_twice(spark):
    docs = frame(spark, [(7, "international conversations " * 100, "en", "a", 2800)] * 2)
    one, two = dict(corpus_pipeline.STAGES)["tokens"](spark, docs, SMALL).collect()
    assert one.round_trip and two.round_trip and one.token_ids != two.token_ids
