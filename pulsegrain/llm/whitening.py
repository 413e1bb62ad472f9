"""Whitened principal components of embeddings by block Jacobi-Davidson.

The covariance is never formed. One Spark job over the fit list multiplies it with a few columns:
every task sums (x - mean) ((x - mean)' Q) over its rows and the sums are added by key, so a
product costs one pass and d x k numbers. The driver holds vectors of the space only (d long), never rows.

Each round does a Rayleigh-Ritz step in the subspace, locks the leading pairs whose residual
is at the level of double precision, solves the correction equations

    (I - QQ')(V - theta I)(I - QQ') t = -r,    t orthogonal to Q

of the others roughly by MINRES (all of them share each pass), and adds the corrections to
the subspace. Q has the locked vectors and the Ritz vectors. A subspace that has grown to its limit
is restarted from its best Ritz vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.llm.shared import written

COMPONENTS = 4
GUARD = 4  # further Ritz pairs that are corrected along, so that close eigenvalues part sooner
INNER_STEPS = 8  # MINRES steps of a round at most
RESTART_AT = 64  # columns of the subspace
ROUNDS = 100
BLOCK = 4096  # vectors packed into a row of the fit list
EPS = np.finfo(np.float64).eps
Product = Callable[[np.ndarray], np.ndarray]


def _orthonormal(new: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The part of new orthogonal to basis, without columns that hardly have one."""
    scale = np.linalg.norm(new, axis=0)
    new = new[:, scale > 0] / scale[scale > 0]
    out = np.zeros((len(basis), 0))
    for column in new.T:
        for _ in range(3):
            before = np.linalg.norm(column)
            for b in (basis, out):
                column = column - b @ (b.T @ column)
            if np.linalg.norm(column) > 0.7 * before:
                break
        size = np.linalg.norm(column)
        if size > 1e-8:
            out = np.column_stack([out, column / size])
    return out


def minres(product: Product, shifts: np.ndarray, fixed: np.ndarray, right: np.ndarray,
           steps: int, tolerance: float) -> np.ndarray:
    """Rough solutions of the correction equations, one for each shift and column of right.

    All columns take a Lanczos step together, so that a step is one product.
    """
    def outside(block: np.ndarray) -> np.ndarray:
        return block - fixed @ (fixed.T @ block)

    v = outside(right)
    beta = np.linalg.norm(v, axis=0)
    start = np.maximum(beta, np.finfo(float).tiny)
    v, last = v / start, np.zeros_like(v)
    solution, w, w_last = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    n = len(shifts)
    cos, cos_last, sin, sin_last = np.ones(n), np.ones(n), np.zeros(n), np.zeros(n)
    eta, open_ = beta.copy(), beta > 0
    beta_k = np.zeros(n)
    for _ in range(steps):
        u = outside(product(outside(v)) - shifts * v)
        alpha = (u * v).sum(axis=0)
        u = outside(u - alpha * v - beta_k * last)
        beta_new = np.linalg.norm(u, axis=0)
        # The new column of the tridiagonal matrix, turned by the two last rotations.
        delta = cos * alpha - cos_last * sin * beta_k
        rho1 = np.hypot(delta, beta_new)
        rho2 = sin * alpha + cos_last * cos * beta_k
        rho3 = sin_last * beta_k
        open_ &= rho1 > 0
        safe = np.where(open_, rho1, 1)
        cos_last, sin_last = cos, sin
        cos, sin = np.where(open_, delta / safe, 1), np.where(open_, beta_new / safe, 0)
        w, w_last = np.where(open_, (v - rho3 * w_last - rho2 * w) / safe, 0), w
        solution += np.where(open_, cos * eta, 0) * w
        eta = -sin * eta
        size = np.where(beta_new > 0, beta_new, 1)
        last, v, beta_k = v, u / size, beta_new
        open_ &= (beta_new > EPS * np.abs(shifts).max()) & (np.abs(eta) > tolerance * start)
        if not open_.any():
            break
    return outside(solution)


def jacobi_davidson(product: Product, d: int, wanted: int,
                    seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """The wanted largest eigenvalues, their unit vectors, and the largest residual relative to the first.

    Raises if they do not reach double precision within ROUNDS.
    """
    wanted = min(wanted, d)
    block = min(wanted + GUARD, d)
    start = np.eye(d) if d <= 2 * block else np.random.default_rng(seed).standard_normal((d, block))
    basis = _orthonormal(start, np.zeros((d, 0)))
    image = product(basis)
    locked, locked_image = np.zeros((d, 0)), np.zeros((d, 0))
    for turn in range(ROUNDS):
        small = basis.T @ image
        values, turnings = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)
        values, turnings = values[order], turnings[:, order]
        ritz, ritz_image = basis @ turnings, image @ turnings
        residual = ritz_image - ritz * values
        scale = max(values[0] if len(values) else 0, _rayleigh(locked, locked_image).max(initial=0), 1e-300)
        limit = 16 * EPS * np.sqrt(d) * scale
        sizes = np.linalg.norm(residual, axis=0)
        whole = basis.shape[1] + locked.shape[1] >= d
        # Locked in order only: a later pair may still turn out to be a smaller one.
        n_lock = 0
        while n_lock + locked.shape[1] < wanted and n_lock < len(values) and (whole or sizes[n_lock] <= limit):
            n_lock += 1
        if n_lock:
            locked = np.column_stack([locked, ritz[:, :n_lock]])
            locked_image = np.column_stack([locked_image, ritz_image[:, :n_lock]])
            basis, image = ritz[:, n_lock:], ritz_image[:, n_lock:]
            values, residual = values[n_lock:], residual[:, n_lock:]
            sizes = sizes[n_lock:]
        else:
            basis, image = ritz, ritz_image
        if locked.shape[1] == wanted:
            break
        if basis.shape[1] > RESTART_AT:
            basis, image = basis[:, :3 * block], image[:, :3 * block]
            values, residual, sizes = values[:3 * block], residual[:, :3 * block], sizes[:3 * block]
        n = min(block, basis.shape[1])
        open_ = np.flatnonzero(sizes[:n] > limit)
        fixed = np.column_stack([locked, basis[:, :n]])
        steps = min(INNER_STEPS, 2 + 2 * turn)
        new = minres(product, values[open_], fixed, -residual[:, open_], steps, 0.5 ** (turn + 1))
        new = _orthonormal(new, np.column_stack([locked, basis]))
        if not new.shape[1]:
            spare = np.random.default_rng(seed + turn + 1).standard_normal((d, block))
            new = _orthonormal(spare, np.column_stack([locked, basis]))[:, :d - basis.shape[1] - locked.shape[1]]
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    else:
        raise ArithmeticError(f"{locked.shape[1]} of {wanted} eigenvectors after {ROUNDS} rounds")
    # Once more with fresh products: what is returned is what was checked.
    basis, _ = np.linalg.qr(locked)
    image = product(basis)
    small = basis.T @ image
    values, turnings = np.linalg.eigh((small + small.T) / 2)
    values, vectors = values[::-1], (basis @ turnings)[:, ::-1]
    error = np.linalg.norm((image @ turnings)[:, ::-1] - vectors * values, axis=0).max(initial=0)
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1, 1)
    return values, vectors, float(error / max(abs(values[0]), 1e-300)) if len(values) else 0.0


def _rayleigh(vectors: np.ndarray, image: np.ndarray) -> np.ndarray:
    return (vectors * image).sum(axis=0)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def packed(rows: DataFrame, d: int) -> DataFrame:
    """The vectors x of rows as blocks of bytes, read in every pass without decoding each number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), d)
            for i in range(0, len(x), BLOCK):
                some = x[i:i + BLOCK]
                wide = bool(np.abs(some).max() >= 1 << 31)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([wide]), pa.array([some.astype(np.int64 if wide else np.int32).tobytes()], pa.binary())],
                    ["wide", "x"])

    return rows.select("x").mapInArrow(run, "wide boolean, x binary")


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for wide, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield np.frombuffer(x, np.int64 if wide else np.int32).reshape(-1, d)


def _added(fit: DataFrame, partial: Callable[[np.ndarray], np.ndarray], d: int, n_out: int) -> np.ndarray:
    """Sums over all rows of what partial gives for some rows: n_out numbers, added by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_out)
        for x in _blocks(batches, d):
            total += partial(x.astype(np.float64)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_out, dtype=np.int32)), pa.array(total)], ["i", "v"])

    out = np.zeros(n_out)
    for row in fit.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[row.i] = row.v
    return out


def _exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int], int]:
    """Rows, sum of each dimension and sum of all squares, in whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (d + 2)
        for x in _blocks(batches, d):
            # Beyond these sizes a sum of longs could overflow.
            x = x.astype(np.int64 if np.abs(x).max() < 1 << 20 else object)
            for i, value in enumerate([*x.sum(axis=0), (x * x).sum(), len(x)]):
                total[i] += int(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d + 2), pa.int32()), pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))], ["i", "v"])

    found = (fit.mapInArrow(run, "i int, v decimal(38,0)").groupBy("i")
             .agg(F.sum("v").alias("v")).collect())
    total = {r.i: int(r.v) for r in found}
    return total.get(d + 1, 0), [total.get(i, 0) for i in range(d)], total.get(d, 0)


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x = floor(256 c) + 0 of rows whose vector has finite entries only.

    Null vectors and such that hold a null, NaN or infinity take no part.
    """
    c = F.col(f"`{embedding}`")
    good = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(c, lambda e: F.floor(F.lit(256.0) * e.cast("double")) + F.lit(0).cast("long"))
    return (vectors.where(c.isNotNull() & good & (F.size(c) > 0))
            .select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), whole.alias("x")))


def whitened(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, residual.

    The fit list is each distinct x once. Components are numbered from 1 by falling eigenvalue;
    their sign makes the largest entry positive. A component whose eigenvalue is zero (at most
    1e-12 of the trace, as where there are fewer distinct vectors than components) cannot be whitened and has no rows. Vectors of another
    length than the commonest (of several the longest) lie in another space and take no part.
    Repeated rows each get their rows, null ids stay null, an empty table gives no rows, other
    columns are ignored whatever their names. residual is the largest residual of an eigenvector
    relative to the first eigenvalue. Numbers whose deviation does not fit a long raise an error.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding)
    # One row for each length: as a rule one.
    commonest = (rows.groupBy(F.size("x").alias("d")).count()
                 .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, residual double")
    if not commonest:
        return spark.createDataFrame([], schema)
    d = commonest[0].d
    rows = rows.where(F.size("x") == d)
    fit = written(packed(rows.select("x").distinct(), d), "fit")
    n, sums, squares = _exact_sums(fit, d)
    mean = np.array([s / n for s in sums])
    trace = (n * squares - sum(s * s for s in sums)) / n**2

    def product(q: np.ndarray) -> np.ndarray:
        def partial(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ q)

        return _added(fit, partial, d, q.size).reshape(q.shape) / n

    values, axes, residual = jacobi_davidson(product, d, components)
    real = values > 1e-12 * trace
    values, axes = values[real], axes[:, real]
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    projection = axes / np.sqrt(values)

    def outer(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ projection
        return w.T @ w

    covariance = _added(fit, outer, d, k * k).reshape(k, k) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = values / trace
    whole_sums = np.array(sums, object)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            if not m:
                continue
            x = _matrix(batch.column(1), d)
            largest = max(n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in sums), 1)
            kind = np.int64 if largest * largest * d < 1 << 63 else object
            off = n * x.astype(kind) - whole_sums.astype(kind)
            deviation = pa.array((off * off).sum(axis=1).tolist(), pa.int64())
            w = (x.astype(np.float64) - mean) @ projection
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 deviation.take(pa.array(np.repeat(np.arange(m), k))), pa.array(w.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                 pa.array(np.full(m * k, residual))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return rows.mapInArrow(project, schema)
