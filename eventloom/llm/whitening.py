"""Embedding whitening by a bidiagonal singular value solver.

Rows are centred and reduced block by block to triangular factors, which merge in a tree into one R with the same
singular values. Householder reflections bring R to an upper bidiagonal B. The qd differences algorithm with shifts
(dqds) finds the squared singular values of B to high relative accuracy, and twisted factorisations of B'B, shifted by
each, give the right singular vectors, which the reflections turn into directions of the embedding space. Rows are
projected on them and scaled to unit variance. Only small square matrices of the embedding's dimension leave the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import table, tree_merged
from eventloom.session import materialize

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
MOST = 1 << 40  # of a whole component, so that sums and centred values stay exact
BLOCK_BYTES = 1 << 25  # of centred rows reduced at once
EPS = float(np.finfo(float).eps)
CLOSE = 1e-3  # relative gap under which neighbouring eigenvalues are solved together


def whole_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, parts: floor(scale * c) + shift of each component c as a double. Leaves out vectors that are null, empty,
    or hold a null or non-finite component."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    bound = float(2 * MOST)  # still too large for :func:`whiten`, which raises
    parts = F.transform(x, lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(bound)), F.lit(-bound))) + shift)
    return vectors.filter((F.size(x) > 0) & finite).select(F.col(id_col).alias("vec_id"), parts.alias("parts"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return pa.concat_arrays([column]).flatten().to_numpy().reshape(-1, dims)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of B, and V, with r = U B V' for an orthogonal U that is not kept."""
    a, n = r.astype(float).copy(), r.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or np.linalg.norm(x[1:]) == 0:
            return None
        u = x / size
        u[0] += np.copysign(1.0, u[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        u = reflector(a[k:, k])
        if u is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k + 2 < n:
            u = reflector(a[k, k + 1 :])
            if u is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
                v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B (squared singular values of the bidiagonal B), largest first."""
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in upper]
    found: list[float] = []
    pending = [(q, e, 0.0)]
    while pending:
        q, e, done = pending.pop()
        guess = 0.0  # a shift that the last step suggests
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + done)
                break
            small = EPS * EPS
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= small * (done + q[i + 1]) or e[i] <= small * (done + q[i])), None)
            if cut is not None:
                pending.append((q[: cut + 1], e[:cut], done))
                q, e, guess = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if q[0] < 1.5 * q[-1] and n > 1 and q[0] < q[-1]:  # the small ones belong to the end
                q, e = q[::-1], e[::-1]
            shift = guess
            while True:
                step = _step(q, e, shift)
                if step is not None:
                    break
                shift = shift / 4 if shift > small * (done + max(q)) else 0.0
            q, e, least, last = step
            done += shift
            guess = 0.98 * min(least, last)
    return np.sort(np.array(found))[::-1]


def _step(q: list[float], e: list[float], shift: float):
    """One qd step, or None where the shift is above the least eigenvalue. Without a shift it cannot fail."""
    out_q, out_e, d = [], [], q[0] - shift
    least = d
    for i in range(len(q) - 1):
        if d < 0 or (shift and not np.isfinite(d)):
            return None
        top = d + e[i]
        out_q.append(top)
        if top == 0:
            ratio, d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / top
            d = d * ratio - shift
        out_e.append(e[i] * ratio)
        least = min(least, d)
    if d < 0:
        return None
    out_q.append(d)
    return out_q, out_e, max(least, 0.0), d


def _twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[np.ndarray, tuple]:
    """The vector z with (L D L' - value) z = gamma e_r for the twist r of least gamma."""
    n, tiny = len(d), EPS * EPS * max(float(np.max(np.abs(d))), 1e-300)
    s, p = np.empty(n), np.empty(n)
    down, up = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        down[i] = d[i] * l[i] / pivot
        s[i + 1] = down[i] * l[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * l[i] * l[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        up[i] = d[i] * l[i] / pivot
        p[i] = p[i + 1] * d[i] / pivot - value
    gamma = np.abs(s + p + value)
    r = int(np.argmin(gamma))
    z = np.zeros(n)
    z[r] = 1
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z), (s, down, d, tiny)


def _inverse(factors: tuple, x: np.ndarray) -> np.ndarray:
    """Solves (L+ D+ L+') y = x and scales y to length one."""
    s, down, d, tiny = factors
    y = x.copy()
    for i in range(len(y) - 1):
        y[i + 1] -= down[i] * y[i]
    pivots = s + d
    y /= np.where(np.abs(pivots) > tiny, pivots, -tiny)
    for i in range(len(y) - 2, -1, -1):
        y[i] -= down[i] * y[i + 1]
    return y / np.linalg.norm(y)


def vectors_of(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of B'B for ``values``, its largest eigenvalues in falling order.

    Vectors of well separated values come straight from the twisted factorisation. Within a group of close values they
    are kept orthogonal, with inverse iteration where the twisted vectors do not tell them apart."""
    n = len(diagonal)
    scale = float(np.sqrt(values[0])) if len(values) else 1.0
    cuts = [0, *[i + 1 for i in range(n - 1) if abs(upper[i]) <= EPS * EPS * scale], n]
    blocks = []
    for low, high in zip(cuts, cuts[1:]):
        # A zero pivot belongs to a direction without variance; nudged, it moves the others by less than rounding does.
        a = np.where(np.abs(diagonal[low:high]) > EPS * EPS * scale, diagonal[low:high], EPS * EPS * scale)
        b = upper[low : high - 1]
        blocks.append((low, high, a * a, b / a[:-1], dqds(a, b)))
    owners = sorted(((v, k) for k, block in enumerate(blocks) for v in block[4]), reverse=True)[: len(values)]
    out = np.zeros((n, len(values)))
    rng = np.random.default_rng(0)
    met: dict[int, list[tuple[float, int]]] = {}
    for i, (value, k) in enumerate(owners):
        low, high, d, l, _ = blocks[k]
        close = [j for v, j in met.get(k, []) if v - value <= CLOSE * v]
        z, factors = _twisted(d, l, value)
        if close:
            others = out[low:high, close]
            for attempt in range(8):
                rest = z - others @ (others.T @ z)
                size = np.linalg.norm(rest)
                if size > 0.1:
                    z = rest / size
                    if attempt > 1:
                        break
                else:
                    z = rng.normal(size=high - low)
                z = _inverse(factors, z - others @ (others.T @ z))
            z -= others @ (others.T @ z)
            z /= np.linalg.norm(z)
        out[low:high, i] = z
        met.setdefault(k, []).append((value, i))
    return out


def principal(r: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of R'R / n in falling order and their vectors as columns, ``most`` at most; those that rounding
    alone may have made are left out."""
    diagonal, upper, v = bidiagonal(r)
    squares = dqds(diagonal, upper)
    floor = (EPS * len(squares)) ** 2 * (squares[0] if len(squares) else 0)
    squares = squares[squares > floor][:most]
    return squares / n, v @ vectors_of(diagonal, upper, squares)


def _triangle(stacked: np.ndarray) -> np.ndarray:
    return np.linalg.qr(stacked, mode="r")


def _blocks(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    step = max(1, BLOCK_BYTES // (8 * dims))
    for at in range(0, len(column), step):
        yield _matrix(column.slice(at, step), dims)


def centred(x: np.ndarray, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """x minus the mean ``whole + part``, the whole numbers first, so that nothing cancels."""
    return (x - whole).astype(float) - part


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per vector and component (see :data:`WHITENED`), components numbered by falling variance.

    Vectors that are null, empty, or hold a null or non-finite component take no part, nor do vectors whose length is not
    the most frequent one (of several, the largest). Repeated rows and ids count, and are returned, one by one.
    Directions without variance have no component, so equal vectors, a single one or an empty table give no rows.
    Components beyond 2^40, and deviations beyond 64 bits, raise OverflowError. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = materialize(whole_rows(vectors, id_col, vector_col, scale, shift))
    lengths = rows.groupBy(F.size("parts").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], WHITENED)
    dims = lengths.d
    rows = rows.filter(F.size("parts") == dims)
    by_dim = rows.select(F.posexplode("parts").alias("i", "x")).groupBy("i")
    sums = by_dim.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("i").collect()
    n, total = sums[0].n, [int(r.s) for r in sums]  # one row per dimension
    if max(abs(x) for r in sums for x in (r.low, r.high)) > MOST:
        raise OverflowError("components are too large for exact sums")
    middle, part = np.array([s // n for s in total], np.int64), np.array([s % n / n for s in total])
    widest = max(max(n * r.high - s, s - n * r.low) for r, s in zip(sums, total))
    exact = np.int64 if dims * widest**2 < 2**63 and n * MOST < 2**63 else object

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dims))
        for batch in batches:
            for x in _blocks(batch.column(0), dims):
                r = _triangle(np.vstack([r, centred(x, middle, part)]))
        if len(r):
            yield pa.RecordBatch.from_pydict({"shard": pa.array([0], pa.int32()), "node": pa.array([TaskContext.get().partitionId()], pa.int64()), "payload": [r.tobytes()]})

    def merge(payloads: list[bytes]) -> bytes:
        return _triangle(np.vstack([np.frombuffer(p).reshape(-1, dims) for p in payloads])).tobytes()

    fan = max(2, min(32, (1 << 26) // (8 * dims * dims)))
    state = "shard int, node long, payload binary"
    factors = materialize(rows.select("parts").mapInArrow(reduce, state))
    r = np.frombuffer(tree_merged(factors, merge, fan).first().payload).reshape(-1, dims)
    r = np.vstack([r, np.zeros((dims - len(r), dims))]) if len(r) < dims else r
    variances, directions = principal(r, n, min(components, dims))
    count = len(variances)
    if not count:
        return spark.createDataFrame([], WHITENED)
    explained = variances / ((r**2).sum() / n)
    projection = directions / np.sqrt(variances)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, mean, met = np.zeros((count, count)), np.zeros(count), False
        for batch in batches:
            for x in _blocks(batch.column(0), dims):
                w, met = centred(x, middle, part) @ projection, True
                gram, mean = gram + w.T @ w, mean + w.sum(axis=0)
        if met:
            yield pa.RecordBatch.from_pydict({"shard": pa.array([0], pa.int32()), "node": pa.array([TaskContext.get().partitionId()], pa.int64()), "payload": [np.vstack([gram, mean]).tobytes()]})

    def add(payloads: list[bytes]) -> bytes:
        return np.sum([np.frombuffer(p) for p in payloads], axis=0).tobytes()

    found = tree_merged(materialize(rows.select("parts").mapInArrow(moments, state)), add)
    gram = np.frombuffer(found.first().payload).reshape(count + 1, count)
    mean = gram[-1] / n
    error = float(np.abs(gram[:-1] / n - np.outer(mean, mean) - np.eye(count)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _blocks(batch.column(1), dims):
                w = centred(x, middle, part) @ projection
                far = x.astype(exact) * n - np.array(total, exact)
                deviation = (far * far).sum(axis=1)
                if exact is object and max(deviation) >= 2**63:
                    raise OverflowError("a deviation does not fit in 64 bits")
                own = pa.array(np.repeat(np.arange(at, at + len(x)), count))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(own), pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()), pa.array(np.full(len(x) * count, n), pa.int64()),
                        pa.array(np.repeat(deviation.astype(np.int64), count)), pa.array(w.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * count, error)),
                    ], [c.split()[0] for c in WHITENED.split(", ")],
                )
                at += len(x)

    return rows.select(F.col("vec_id").cast("long"), "parts").mapInArrow(project, WHITENED)


def op12_bidiagonal_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
