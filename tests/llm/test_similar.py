from __future__ import annotations

import re

import numpy as np

from pulsegrain.llm.components import smallest_reachable
from pulsegrain.llm.queries import ORACLE, op4_similar
from pulsegrain.llm.similar import one_of_each_group, similar, similar_documents
from tests.compare import connect, differences
from tests.conftest import SMALL
from tests.llm.cases import clashing, frame, hard_documents, nothing, prose


def sets_of(rows):
    out = {}
    for doc_id, text, *_ in rows:
        words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[doc_id] = ({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5
                       else {tuple(words)} if words else set())
    return out


def brute(rows):
    sets = sets_of(rows)
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (len(sets[k]), find(k)) for k in ids}


def family(seed: int, first_id: int, n: int) -> list[tuple]:
    """A text and copies with one to six changed words: links run through the less changed."""
    words, rows = prose(seed, 150).split(), []
    for i in range(n):
        own = list(words)
        for k in range(i % 7):
            own[(i * 13 + k * 29) % 150] = f"new{i}x{k}"
        rows.append((first_id + i, " ".join(own), "en", "a", 1))
    return rows


def test_components_match_brute_force(spark):
    rows = hard_documents() + family(900, 1000, 40) + family(901, 2000, 25)
    shared = " ".join(prose(77, 30).split())
    rows += [(3000 + i, prose(3000 + i, 20) + " " + shared, "en", "a", 1) for i in range(40)]
    found = {r.doc_id: (r.n_shingles, r.component_id)
             for r in similar_documents(clashing(frame(spark, rows))).collect()}
    assert found == brute(rows)
    kept = one_of_each_group(clashing(frame(spark, rows)))
    expected = sorted([k for k, (n, c) in brute(rows).items() if c == k])
    assert sorted(r.doc_id for r in kept.collect()) == expected


def test_rows_without_id_or_words(spark):
    rows = [(None, prose(1, 30), "en", "a", 1), (None, None, None, None, None), (7, prose(1, 30), "en", "a", 1),
            (9, "", "en", "a", 0), (9, "", "en", "a", 0)]
    found = similar_documents(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == [
        ("7", "7"), ("9", "9"), ("9", "9"), ("None", "None"), ("None", "None")]
    assert one_of_each_group(frame(spark, rows)).count() == 5


def test_empty_table(spark):
    docs = nothing(frame(spark, hard_documents()))
    assert similar_documents(docs).count() == one_of_each_group(docs).count() == 0


def test_against_sql(spark):
    assert differences(op4_similar(spark, SMALL), connect(SMALL), ORACLE["op4_similar"]) is None


def test_prefix_filters_lose_nothing():
    random = np.random.default_rng(3)
    for _ in range(300):
        pool = np.unique(random.integers(0, 2**63, 60).astype(np.uint64))
        x = np.sort(random.choice(pool, random.integers(1, 50), replace=False))
        y = np.sort(np.unique(np.concatenate([x[random.random(len(x)) < 0.9], random.choice(pool, 3)])))
        common = len(np.intersect1d(x, y))
        assert similar(x, y) == (100 * common >= 75 * (len(x) + len(y) - common))


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, k) for k in range(200, 260)] + [(3, 3)]
    found = dict(smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {i: 100 for i in range(100, 141)} | {k: 5 for k in [5, *range(200, 260)]}
