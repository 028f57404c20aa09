"""Whitening of embeddings by a bidiagonal qd solver.

* `reduced`: each task centres its rows and keeps one triangle R of a blockwise QR; triangles are
  combined in groups of `FAN` by Spark until one is left. It has the rows' covariance, without ever
  forming products of the rows, and its size depends on the number of dimensions alone.
* On the driver, with that one triangle: Householder reflections make R bidiagonal (`bidiagonal`), the
  differential qd algorithm with shifts finds its squared singular values to high relative accuracy
  (`squared_singular_values`), and each direction comes from a twisted factorisation, the forward and
  the backward one joined where the residual is least (`twisted_vector`). Directions of values too
  close together are made orthogonal by inverse iteration (`directions`).
* The directions are broadcast (dimensions times components numbers); rows are projected in batches.

Entries become whole numbers first, so sums, counts and deviations are exact; a centred entry
(n*x - S)/n is rounded once.

Defined results: vectors that are null or hold null, NaN or infinite entries are left out; so are
vectors whose length is not the most frequent one (the longer one of a tie) and empty ones. Repeated
rows count as often as they come; null and repeated ids stay rows. A component without variance has no
whitened values and no rows, so equal vectors, one vector and an empty table give no rows. A deviation
beyond a long is null. Entries are taken to be small enough for n*x to fit a long. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
BLOCK, FAN = 4096, 16
EPS = np.finfo(np.float64).eps


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole-number vectors of a batch, per vector length."""
    lists = batch.column("embedding").cast(pa.large_list(pa.float64()))
    ends = np.frombuffer(lists.buffers()[1], np.int64)[lists.offset:][:len(lists) + 1]
    values = lists.values
    numbers = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    bad = ~np.isfinite(numbers) | np.asarray(values.is_null())
    before = np.concatenate([[0], np.cumsum(bad)])
    sizes = np.diff(ends)
    good = (before[ends[1:]] == before[ends[:-1]]) & (sizes > 0) & np.asarray(lists.is_valid())
    for size in np.unique(sizes[good]):
        rows = np.flatnonzero(good & (sizes == size))
        for a in range(0, len(rows), BLOCK):
            some = rows[a:a + BLOCK]
            x = numbers[ends[some][:, None] + np.arange(size)]
            yield some, np.floor(SCALE * x).astype(np.int64) + OFFSET


def sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for rows, x in vectors(batch):
            size = x.shape[1]
            n, s = sums.get(size, (0, 0))
            sums[size] = n + len(rows), s + x.sum(axis=0)
    for size, (n, s) in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()),
             pa.array([n] * size, pa.int64()), pa.array(s, pa.int64())],
            names=["size", "dimension", "n", "total"])


def fitted(embeddings: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors of the most frequent length and their sum per dimension."""
    sums = stored(embeddings.mapInArrow(
        sum_rows, "size int, dimension int, n long, total long").groupBy("size", "dimension").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")), "vector-sums")
    most = sums.filter("dimension = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return 0, np.zeros(0, np.int64)
    rows = sums.filter(F.col("size") == most["size"]).orderBy("dimension").collect()
    return most["n"], np.array([r["total"] for r in rows], np.int64)


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return (n * x - total) / n


def triangle(stack: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(stack), mode="r")


def triangle_rows(batches: Iterator[pa.RecordBatch], n: int, total: np.ndarray
                  ) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    r = np.zeros((0, len(total)))
    for batch in batches:
        for _, x in vectors(batch):
            if x.shape[1] == len(total):
                r = triangle([r, centred(x, n, total)])
    if len(r):
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()),
             pa.array([r.tobytes()], pa.binary())], names=["part", "r"])


def reduced(embeddings: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """The triangle of all centred rows."""
    size = len(total)

    def joined(table: pa.Table) -> pa.Table:
        stack = [np.frombuffer(b, np.float64).reshape(-1, size) for b in table["r"].to_pylist()]
        return pa.table({"part": pa.array([table["part"][0].as_py() // FAN], pa.int32()),
                         "r": pa.array([triangle(stack).tobytes()], pa.binary())})

    parts = stored(embeddings.mapInArrow(lambda b: triangle_rows(b, n, total), "part int, r binary"),
                   "vector-triangles")
    while parts.count() > 1:
        parts = stored(parts.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(
            joined, "part int, r binary"), "vector-triangles")
    return np.frombuffer(parts.first()["r"], np.float64).reshape(-1, size)


def reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """v, beta and the new first entry: (1 - beta v v^T) x has nothing behind its first entry."""
    v = x.copy()
    norm = np.linalg.norm(x)
    if norm == 0 or len(x) == 1:
        return np.zeros_like(x), 0.0, x[0]
    first = -np.copysign(norm, x[0])
    v[0] -= first
    return v, 2.0 / (v @ v), first


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of U^T r V, and V, by reflections from both sides."""
    size = r.shape[1]
    a = np.zeros((size, size))
    a[:len(r)] = r
    v = np.eye(size)
    for i in range(size):
        w, beta, first = reflector(a[i:, i])
        a[i:, i + 1:] -= beta * np.outer(w, w @ a[i:, i + 1:])
        a[i, i], a[i + 1:, i] = first, 0
        if i + 2 < size:
            w, beta, first = reflector(a[i, i + 1:])
            a[i + 1:, i + 1:] -= beta * np.outer(a[i + 1:, i + 1:] @ w, w)
            v[:, i + 1:] -= beta * np.outer(v[:, i + 1:] @ w, w)
            a[i, i + 1], a[i, i + 2:] = first, 0
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list, list] | None:
    """One differential qd transform, or None if the shift is above the least value."""
    d = q[0] - shift
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None
        x = d + e[i]
        ratio = q[i + 1] / x if x > 0 else 0.0
        new_q.append(x)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    return [*new_q, d], new_e


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """All, falling: qd transforms with shifts below the least value, one value split off at a time.

    A shift that proves too large is made smaller, at last zero; nothing is ever subtracted but
    shifts, which is what keeps small values accurate."""
    found: list[float] = []
    todo = [((diagonal**2).tolist(), (upper**2).tolist(), 0.0)]
    small = EPS * EPS
    while todo:
        q, e, base = todo.pop()
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1)
                        if e[i] <= small * (base + min(q[i], q[i + 1]))
                        or e[i] <= 1e-300), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], base))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            # the least value of the last two rows is near the least of all, mostly above it
            a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
            half = (a + c) / 2
            root = np.hypot((a - c) / 2, np.sqrt(b))
            low = max(0.0, (a * c - b) / (half + root)) if half + root else 0.0
            step = None
            for part in (1 - 1e-8, 0.97, 0.7, 0.25, 0.03, 0.0):
                shift = part * low
                if base + shift == base:
                    shift = 0.0
                step = qd_step(q, e, shift)
                if step is not None:
                    break
            (q, e), base = step, base + shift
        found += [base + x for x in q]
    return np.sort(np.array(found))[::-1]


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B^T B = L D L^T for an eigenvalue, by a twisted factorisation.

    From the top the stationary, from the bottom the progressive qd transform; they meet where the
    twist element is least."""
    n = len(diagonal)
    least = EPS * max(np.abs(diagonal).max(), np.abs(upper).max() if n > 1 else 0.0)
    a = np.where(np.abs(diagonal) < least * EPS, least * EPS, diagonal)
    d, low = a * a, upper / a[:-1]
    tiny = least * least

    def safe(x):
        return x if abs(x) > tiny else (tiny if x >= 0 else -tiny)

    s, p = np.empty(n), np.empty(n)
    plus, minus = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):
        plus[i] = low[i] * d[i] / safe(d[i] + s[i])
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p[n - 1] = d[n - 1] - value
    for i in range(n - 2, -1, -1):
        t = d[i] / safe(d[i] * low[i] * low[i] + p[i + 1])
        minus[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    twist = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -minus[i] * z[i]
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of r^T r above rounding, and their unit eigenvectors as columns."""
    scale = np.abs(r).max()
    if not scale > 0:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    diagonal, upper, v = bidiagonal(r / scale)
    values = squared_singular_values(diagonal, upper)
    values = values[:components][np.sqrt(values[:components])
                                 > np.sqrt(values[0]) * len(diagonal) * 8 * EPS]
    tri = np.diag(diagonal**2) + np.diag(diagonal[:-1] * upper, 1) + np.diag(diagonal[:-1] * upper, -1)
    tri[1:, 1:] += np.diag(upper**2)
    z = np.zeros((len(diagonal), len(values)))
    random = np.random.default_rng(1)
    for j, value in enumerate(values):
        x = twisted_vector(diagonal, upper, value)
        for _ in range(4):
            near = z[:, :j] @ (z[:, :j].T @ x)
            off = np.linalg.norm(near)
            if np.isfinite(off) and off < 1e-13 and \
                    np.linalg.norm(tri @ x - value * x) < 1e-13 * len(diagonal) * values[0]:
                break
            # a value of several directions: inverse iteration beside those already found
            x = x - near if np.isfinite(off) and off < 0.9 else random.standard_normal(len(diagonal))
            x -= z[:, :j] @ (z[:, :j].T @ x)
            shifted = tri - (value + values[0] * EPS * (j + 1)) * np.eye(len(diagonal))
            x = np.linalg.solve(shifted, x)
            x /= np.linalg.norm(x)
            for _ in range(2):
                x -= z[:, :j] @ (z[:, :j].T @ x)
                x /= np.linalg.norm(x)
        z[:, j] = x
    return values * scale * scale, v @ z


def product_rows(batches: Iterator[pa.RecordBatch], n: int, total: np.ndarray, w: np.ndarray
                 ) -> Iterator[pa.RecordBatch]:
    """Sums over the task's rows of the whitened numbers and of their products, by place."""
    k = w.shape[1]
    sums = np.zeros((k + 1, k))
    for batch in batches:
        for _, x in vectors(batch):
            if x.shape[1] == len(total):
                z = centred(x, n, total) @ w
                sums[:k] += z.T @ z
                sums[k] += z.sum(axis=0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())], names=["place", "total"])


def identity_error(embeddings: DataFrame, n: int, total: np.ndarray, w: np.ndarray) -> float:
    """Largest entry of the whitened rows' covariance less the identity."""
    k = w.shape[1]
    sums = embeddings.mapInArrow(lambda b: product_rows(b, n, total, w), "place int, total double")
    rows = sums.groupBy("place").agg(F.sum("total").alias("total")).orderBy("place").collect()
    flat = np.array([r["total"] for r in rows]).reshape(k + 1, k) / n
    return float(np.abs(flat[:k] - np.outer(flat[k], flat[k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> pa.Array:
    """Exact sums of (n*x - S)^2 per row; null where a long cannot hold it."""
    d = n * x - total
    if d.size and float(np.abs(d).max())**2 * d.shape[1] >= 2.0**62:
        exact = [sum(int(v)**2 for v in row) for row in d]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
    return pa.array((d * d).sum(axis=1))


def whitened_rows(batches: Iterator[pa.RecordBatch], n: int, total: np.ndarray, w: np.ndarray,
                  explained: np.ndarray, error: float) -> Iterator[pa.RecordBatch]:
    k = w.shape[1]
    for batch in batches:
        for rows, x in vectors(batch):
            if x.shape[1] != len(total):
                continue
            m = len(rows)
            each = pa.array(np.repeat(np.arange(m), k))
            z = centred(x, n, total) @ w
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)).take(each),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), deviations(x, n, total).take(each),
                 pa.array(z.ravel()), pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = embeddings.select("vec_id", "embedding")
    vec_id = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {vec_id}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    n, total = fitted(rows.select("embedding"))
    values = np.zeros(0)
    if n:
        r = reduced(rows.select("embedding"), n, total)
        values, v = directions(r, components)
    if not len(values):
        return rows.sparkSession.createDataFrame([], schema)
    w = v / np.sqrt(values / n)
    explained = values / np.square(r).sum()
    error = identity_error(rows.select("embedding"), n, total, w)
    return rows.mapInArrow(lambda b: whitened_rows(b, n, total, w, explained, error), schema)
