from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pulsegrain.llm.neighbours import nearest, probe_steps
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows: list[tuple[int, list[float]]], k: int = 20) -> dict[int, list[tuple[int, float]]]:
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i, v in zip(ids, x, strict=True):
        score = np.einsum("ij,j->i", x, v)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(df):
    out: dict[int, list] = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found = out.setdefault(r.query_id, [])
        assert r["rank"] == len(found) + 1
        found.append((r.vec_id, r.score))
    return out


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    truth = exact(rows)
    found = answers(nearest(vectors, vectors.where("vec_id % 20 = 0")))
    assert set(found) == {i for i, _ in rows if i % 20 == 0}
    hits = sum(len(set(found[q]) & set(truth[q])) for q in found)
    assert hits >= 0.9 * sum(len(found[q]) for q in found) and all(len(v) == 20 for v in found.values())


def test_copies_ties_and_unusable_vectors(spark):
    random = np.random.default_rng(1)
    one = [float(x) for x in random.standard_normal(8).astype(np.float32)]
    rows = [(i, one, 0) for i in range(200)]
    rows += [(1000 + i, [float(x) for x in random.standard_normal(8).astype(np.float32)], 1) for i in range(30)]
    bad = [(2000, None, 0), (2001, [0.0] * 8, 0), (2002, [1.0, None] + one[2:], 0), (2003, [float("nan")] + one[1:], 0),
           (2004, [float("inf")] + one[1:], 0), (None, one, 0), (2005, [], 0), (2020, [1.0, 2.0], 0)]
    df = spark.createDataFrame([*rows, *bad, rows[3], rows[3]], SCHEMA).withColumns(
        {n: F.lit("clash") for n in ("hash", "ids", "vector", "entry", "norm", "rank", "tab")}).repartition(4)
    found = answers(nearest(df, df.where("vec_id % 20 = 0"), probes=200, n_tables=12))
    truth = exact([(i, v) for i, v, _ in rows])
    assert set(found) == {i for i in truth if i % 20 == 0}  # 2020 is alone in its dimension
    for q in range(0, 200, 20):
        assert [v for v, _ in found[q]] == [v for v, _ in truth[q]] and found[q][0][1] == truth[q][0][1]


def test_few_candidates_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (20, [-5.0, 0.0], 0)], SCHEMA)
    found = answers(nearest(df, df.where("vec_id % 20 = 0"), probes=200, n_tables=30))
    assert [v for v, _ in found[0]] == [1, 20] and [v for v, _ in found[20]] == [0, 1]
    assert nearest(df.where("false"), df).count() == 0
    assert nearest(df, df.where("false")).count() == 0


def test_probes_come_in_order_of_their_score():
    fractions = np.array([0.1, 0.45, 0.8])
    steps = probe_steps(fractions, 27)
    assert len({tuple(s) for s in steps}) == 27
    cost = [sum((f if x < 0 else 1 - f) ** 2 for f, x in zip(fractions, s, strict=True) if x) for s in steps]
    assert cost == sorted(cost) and cost[0] == 0


def test_answers_are_full_with_the_registered_parameters(spark):
    """One vector of very large norm, few rows, opposite vectors, copies: nothing is missing."""
    random = np.random.default_rng(4)
    many = [(i, [float(x) for x in v]) for i, v in enumerate(random.standard_normal((400, 16)).astype(np.float32))]
    many[7] = (7, [50.0 * x for x in many[7][1]])
    few = many[:3]
    opposite = [(0, [1.0, 0.0, 0.5]), (1, [-1.0, 0.0, -0.5]), (20, [-1.0, 0.25, -0.5]), (3, [0.0, -1.0, 0.0])]
    copies = [(i, [1.0, 2.0]) for i in range(50)] + [(i, [float(i), -1.0]) for i in range(60, 64)]
    for rows in (many, few, opposite, copies):
        df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
        found, truth = answers(nearest(df, df.where("vec_id % 20 = 0"))), exact(rows)
        for q, nearest_found in found.items():
            assert len(nearest_found) == min(20, len(rows) - 1), (len(rows), q)
            if len(rows) <= 21:
                assert nearest_found == truth[q]
        assert set(found) == {i for i, _ in rows if i % 20 == 0}
