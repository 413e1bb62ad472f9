"""Approximate nearest neighbours by multiprobe p-stable hashing.

The largest inner product is the smallest Euclidean distance once every vector gets one more
component that brings it to the largest norm, and every query is scaled to that norm. Each of
TABLES tables cuts HASHES random Gaussian projections into steps of WIDTH; a vector lies in one
bucket of a table. A query visits its own bucket and then neighbouring ones in the order of the
estimated chance of success: the sum of squared distances to the borders that are crossed.

A query that has found fewer than it can have goes on to every bucket of one table, so an answer is
short only where there are no more vectors.

The candidates of a visited bucket are scored exactly in the task of the bucket, the best of
each visit are kept, and a query's visits are merged. Buckets of more than BLOCK vectors or
visits are dealt out as blocks against blocks. Equal vectors are one entry that carries its
smallest ids, as many as an answer can take.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrain.llm.shared import partitions, written

TABLES = 8
HASHES = 4
WIDTH = 1.5
PROBES = 16
SEED = 7
BLOCK = 4096


def _usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, vector of distinct rows that take part: no null, NaN or infinity, not all zero."""
    v = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("vector", lambda x: x != 0)).withColumn(
        "vector", F.transform("vector", lambda x: x + 0))


def _norm() -> F.Column:
    return F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


class _Tables:
    """The random projections; the same wherever they are made."""

    def __init__(self, dimension: int, largest: float, n_tables: int, n_hashes: int, width: float,
                 seed: int) -> None:
        random = np.random.default_rng([seed, dimension])
        self.shape, self.largest = (n_tables, n_hashes), largest
        self.projections = random.standard_normal((dimension + 1, n_tables * n_hashes)) / width
        self.shifts = random.uniform(0, 1, n_tables * n_hashes)
        self.codes = random.integers(1, 2**62, n_hashes) * 2 + 1

    def places(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Coordinates in units of steps: rows, tables, hashes."""
        unit = vectors / self.largest
        norms = np.sqrt((unit ** 2).sum(1))
        if query:
            unit = np.column_stack([unit / norms[:, None], np.zeros(len(unit))])
        else:
            unit = np.column_stack([unit, np.sqrt(np.maximum(0.0, 1.0 - norms ** 2))])
        return (unit @ self.projections + self.shifts).reshape(len(vectors), *self.shape)

    def buckets(self, steps: np.ndarray) -> np.ndarray:
        """One number for the whole steps of a table."""
        return (steps.astype(np.int64) * self.codes).sum(-1)


def probe_steps(fractions: np.ndarray, n: int) -> list[np.ndarray]:
    """Up to n changes of steps, in the order of their scores; the first changes nothing.

    fractions: how far the query is from the lower border in each hash. Sets of crossed borders
    are made from the smallest on by moving or adding to the last border of a set.
    """
    m = len(fractions)
    distance = np.concatenate([fractions, 1 - fractions]) ** 2
    order = np.argsort(distance, kind="stable")
    score = distance[order].tolist()
    which, sign = (order % m).tolist(), np.where(order < m, -1, 1).tolist()
    out = [np.zeros(m, np.int64)]
    heap = [(score[0], (0,))]
    while heap and len(out) < n:
        total, chosen = heapq.heappop(heap)
        if len({which[i] for i in chosen}) == len(chosen):
            step = np.zeros(m, np.int64)
            for i in chosen:
                step[which[i]] = sign[i]
            out.append(step)
        last = chosen[-1]
        if last + 1 < len(score):
            heapq.heappush(heap, (total + score[last + 1] - score[last], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + score[last + 1], (*chosen, last + 1)))
    return out


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, kind))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id",
            vector: str = "embedding", n_tables: int = TABLES, n_hashes: int = HASHES,
            width: float = WIDTH, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products found for each query.

    queries and vectors have the same columns; a query's own id is no answer to it. Ties go to
    the smaller vec_id. Vectors that are null, empty, zero or hold null, NaN or infinity take no
    part, nor do rows without id; repeated rows count once; vectors of another length than the
    query's are no candidates. Other columns are ignored whatever their names. A query without
    candidate, and an empty table, give no rows.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors, vec_id, vector).withColumn("hash", F.xxhash64("vector"))
    few = Window.partitionBy("hash", "vector").orderBy("vec_id")
    entries = written(
        usable.dropDuplicates(["hash", "vec_id"]).withColumn("place", F.row_number().over(few))
        .where(F.col("place") <= k + 1).groupBy("hash", "vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min(_norm()).alias("norm"))
        .withColumn("entry", F.col("ids")[0]), "entries")
    # Copies beyond k + 1 of a vector can be in no answer, so these counts tell what an answer can have.
    asked = written(_usable(queries, vec_id, vector).dropDuplicates(["vec_id"])
                    .withColumn("hash", F.xxhash64("vector")), "asked")
    wanted = asked.select("hash", "vector").distinct()
    sizes = [(r["d"], r["largest"], r["n"]) for r in entries.groupBy(F.size("vector").alias("d")).agg(
        F.max("norm").alias("largest"), F.sum(F.size("ids")).alias("n")).collect()]
    tables = {d: (d, largest, n_tables, n_hashes, width, seed) for d, largest, _ in sizes}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {d: _Tables(*args) for d, args in tables.items()}
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy()
            for d in np.unique(lengths):
                rows = pa.array(np.flatnonzero(lengths == d))
                part = batch.take(rows)
                bucket = made[d].buckets(np.floor(made[d].places(_matrix(part.column(1)), False)))
                for t in range(n_tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), t, np.int32)), pa.array(bucket[:, t] + d), *part.columns],
                        ["tab", "bucket", "entry", "vector", "ids"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {d: _Tables(*args) for d, args in tables.items()}
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy()
            for d in np.unique(lengths):
                if d not in made:
                    continue
                part = batch.take(pa.array(np.flatnonzero(lengths == d)))
                places = made[d].places(_matrix(part.column(1)), True)
                steps = np.floor(places)
                rows, tab, bucket = [], [], []
                for i in range(len(part)):
                    for t in range(n_tables):
                        moves = np.array(probe_steps(places[i, t] - steps[i, t], probes))
                        bucket.append(made[d].buckets(steps[i, t] + moves) + d)
                        rows += [i] * len(moves)
                        tab += [t] * len(moves)
                    if len(rows) > 20_000 or i + 1 == len(part):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(tab, pa.int32()), pa.array(np.concatenate(bucket)),
                             *part.take(pa.array(rows)).columns], ["tab", "bucket", "hash", "vector"])
                        rows, tab, bucket = [], [], []

    kind = entries.schema["vector"].dataType.simpleString()
    placed = entries.select("entry", "vector", "ids").mapInArrow(
        index, f"tab int, bucket long, entry long, vector {kind}, ids array<long>")
    visits = written(wanted.mapInArrow(visit, f"tab int, bucket long, hash long, vector {kind}"), "visits")
    def score(rows: pa.Table, visited: pa.Table) -> pa.Table:
        out = {"ids": [], "scores": []}
        if not len(rows) or not len(visited):
            return pa.table({"hash": pa.array([], pa.int64()), "vector": visited["vector"].slice(0, 0),
                             "ids": pa.array([], pa.list_(pa.int64())),
                             "scores": pa.array([], pa.list_(pa.float64()))})
        x, q = _matrix(rows["vector"]), _matrix(visited["vector"])
        members = rows["ids"].combine_chunks()
        sizes, flat = members.value_lengths().to_numpy(), members.flatten().to_numpy()
        begins = np.cumsum(sizes) - sizes
        for i in range(len(q)):
            # The k + 1 best entries hold the k + 1 best ids; einsum sums in one order everywhere.
            value = np.einsum("ij,j->i", x, q[i])
            if len(value) > k + 1:
                least = np.partition(value, len(value) - k - 1)[len(value) - k - 1]
                best = np.flatnonzero(value >= least)
            else:
                best = np.arange(len(value))
            n = sizes[best]
            at = np.repeat(begins[best] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            ids, scores = flat[at], np.repeat(value[best], n)
            order = np.lexsort((ids, -scores))[:k + 1]
            out["ids"].append(ids[order])
            out["scores"].append(scores[order])
        return pa.table({"hash": visited["hash"], "vector": visited["vector"],
                         "ids": _lists(out["ids"], pa.int64()), "scores": _lists(out["scores"], pa.float64())})

    key = ["tab", "bucket"]
    groups = [*key, "row_block", "visit_block"]
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def scored(visits: DataFrame) -> DataFrame:
        """hash, ids, scores: the best of each visit."""
        # Only buckets that are visited, and how many blocks either side is dealt into.
        sides = (placed.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_rows"))
                 .join(visits.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_visits")), key))
        sides = written(sides, "sides")
        left = (placed.join(sides, key).withColumn("row_block", F.pmod(F.xxhash64("entry"), "n_rows").cast("int"))
                .withColumn("visit_block", blocks("n_visits"))
                .select(*key, "row_block", "visit_block", "entry", "vector", "ids"))
        right = (visits.join(sides, key).withColumn("visit_block", F.pmod("hash", "n_visits").cast("int"))
                 .withColumn("row_block", blocks("n_rows")).select(*key, "row_block", "visit_block", "hash", "vector"))
        return left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInArrow(
            score, f"hash long, vector {kind}, ids array<long>, scores array<double>").select("hash", "ids", "scores")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, dict[int, float]] = {}
        for batch in batches:
            for h, ids, scores in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                have = best.setdefault(h, {})
                have.update(zip(ids, scores, strict=True))
                if len(have) > 8 * (k + 1):
                    best[h] = dict(sorted(have.items(), key=lambda x: (-x[1], x[0]))[:k + 1])
        rows = [(h, *zip(*sorted(have.items(), key=lambda x: (-x[1], x[0]))[:k + 1], strict=True))
                for h, have in best.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())),
             pa.array([r[2] for r in rows], pa.list_(pa.float64()))], ["hash", "ids", "scores"])

    def best(found: DataFrame) -> DataFrame:
        return found.repartition(partitions(spark), "hash").mapInArrow(
            merge, "hash long, ids array<long>, scores array<double>")

    merged = written(best(scored(visits)), "merged")
    # A query needs k ids beside its own, or all there are of its length.
    most = F.create_map(*[F.lit(x) for d, _, n in sizes for x in (d, int(n))]) if sizes else F.lit(None).cast("map<int,int>")
    have = wanted.join(merged.select("hash", F.size("ids").alias("n_found")), "hash", "left")
    short = have.where(F.coalesce("n_found", F.lit(0)) < F.least(F.lit(k + 1), most[F.size("vector")]))
    short = written(short.select("hash", "vector"), "short")
    if not short.isEmpty():
        every = placed.where("tab = 0").select(*key, F.size("vector").alias("d")).distinct()
        more = written(short.join(every, F.size(short["vector"]) == every["d"]).select(*key, "hash", "vector"), "more")
        merged = best(merged.unionByName(scored(more)))
    answers = (asked.select(F.col("vec_id").alias("query_id"), "hash").join(merged, "hash")
               .select("query_id", F.arrays_zip("ids", "scores").alias("found"))
               .select("query_id", F.slice(F.filter("found", lambda f: f["ids"] != F.col("query_id")), 1, k).alias("found"))
               .select("query_id", F.posexplode("found").alias("rank", "f")))
    return answers.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"),
                          F.col("f.ids").alias("vec_id"), F.col("f.scores").alias("score"))
