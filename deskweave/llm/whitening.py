"""Embedding whitening by a bidiagonal qd solver.

Tasks centre their rows and reduce them block by block with QR to one triangle each; triangles
are stacked and reduced again in a tree until one is left, R, with R'R the scatter of all rows.
R is as large as a vector is long, so the rest runs on the driver: Householder reflections
bring it to an upper bidiagonal B, dqds finds the squares of its singular values one by one to
high relative accuracy, and twisted factorisations of B'B - lambda give their vectors, which
the reflections carry back to whitening directions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 1024.0, 100_000  # entries become the integers floor(SCALE * c) + SHIFT
LARGEST = 2.0**40  # absolute value of an entry, beyond which it is refused
BLOCK = 4_096  # rows reduced at once
FAN_IN = 64  # triangles stacked by one task of a level
COMPONENTS = 8
EPS = np.finfo(float).eps


# --- one triangle: numpy on matrices as large as a vector is long ----------------------------


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, W) with r = U B W' for an orthogonal U, by Householder."""
    a, size = np.array(r, float), len(r)
    w = np.eye(size)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        """Unit v such that x - 2 v (v'x) has zeros below its first entry."""
        scale = np.abs(x).max(initial=0.0)
        if scale == 0 or not np.abs(x[1:]).max(initial=0.0):
            return None
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(size):
        if (v := reflector(a[k:, k].copy())) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < size - 2 and (v := reflector(a[k, k + 1 :].copy())) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B, falling, from q and e, the squares of B's diagonal and superdiagonal.

    Each sweep is the differential qd transform with a shift below the smallest eigenvalue; a
    shift that makes a q negative is given up for a smaller one, so all quantities stay
    positive and small eigenvalues are as accurate as large ones.
    """
    found: list[float] = []
    stack = [(np.array(q, float), np.array(e, float), 0.0)]
    while stack:
        q, e, total = stack.pop()
        shift = 0.0
        while len(q):
            if len(q) == 1:
                found.append(q[0] + total)
                break
            small = e <= EPS * EPS * (q[1:] + total) if total else e <= EPS * EPS * np.minimum(q[:-1], q[1:])
            if small.any():
                at = int(np.flatnonzero(small)[-1]) + 1
                if at < len(q) - 1 or len(q) - at > 1:
                    stack.append((q[:at], e[: at - 1], total))
                    q, e = q[at:], e[at:]
                else:
                    found.append(q[-1] + total)
                    q, e = q[:-1], e[:-1]
                shift = 0.0
                continue
            while True:
                new_q, new_e, low = _sweep(q, e, shift)
                if low >= 0 or shift == 0:
                    break
                shift = 0.0 if shift < EPS * total or shift < 1e-300 else shift / 4
            q, e, total = new_q, new_e, total + shift
            # a share of the smallest d is a safe first guess at what is left
            shift = 0.75 * low if low < 0.5 * q[:-1].min(initial=np.inf) or len(q) < 3 else 0.25 * low
    return np.sort(np.maximum(found, 0.0))[::-1]


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One transform; the third value is the smallest d, negative if the shift was too large."""
    new_q, new_e = np.empty_like(q), np.empty_like(e)
    d = q[0] - shift
    low = d
    for k in range(len(e)):
        new_q[k] = d + e[k]
        if new_q[k] <= 0:
            if shift:
                return q, e, -1.0
            new_e[k], d = 0.0, q[k + 1]
        else:
            ratio = q[k + 1] / new_q[k]
            new_e[k], d = e[k] * ratio, d * ratio - shift
        low = min(low, d)
    new_q[-1] = d
    return new_q, new_e, low


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B at `value`, B with diagonal `a` and superdiagonal `b`.

    The stationary transform factorises B'B - value from the top, the progressive one from the
    bottom; they are joined where the twist is nearest to singular, and the vector follows from
    there both ways by products alone.
    """
    size = len(a)
    tiny = EPS * max(value, np.abs(a).max(initial=0) ** 2, 1e-300)
    d = np.where(a * a > 0, a * a, tiny * EPS)
    low = b * np.copysign(1 / np.sqrt(d[:-1]), a[:-1]) if size > 1 else np.empty(0)
    s, p = np.empty(size), np.empty(size)
    down, up = np.empty(max(size - 1, 0)), np.empty(max(size - 1, 0))
    s[0] = -value
    for k in range(size - 1):
        pivot = s[k] + d[k] or -tiny
        down[k] = d[k] * low[k] / pivot
        s[k + 1] = down[k] * low[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(size - 2, -1, -1):
        pivot = d[k] * low[k] ** 2 + p[k + 1] or -tiny
        ratio = d[k] / pivot
        up[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - value
    at = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(size)
    z[at] = 1.0
    for k in range(at - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(at, size - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def right_directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the largest `most` singular values of r, falling, and right vectors in columns.

    Vectors of values that lie close together are made orthogonal to those before them and
    refined against B'B, as twists alone do not keep them apart.
    """
    a, b, w = bidiagonalise(r)
    values = dqds(a * a, b * b)
    wanted = [v for v in values[:most] if v > len(r) * EPS * EPS * values[0]]
    gram = np.diag(a * a)
    gram[1:, 1:] += np.diag(b * b)
    gram += np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    rng, found = np.random.default_rng(0), []
    for i, value in enumerate(wanted):
        z = twisted_vector(a, b, value)
        near = [x for x, v in zip(found, wanted) if v - value <= 1e-3 * v]
        for _ in range(3 if near else 0):
            for x in near:
                z -= (x @ z) * x
            if np.linalg.norm(z) < 0.1:  # the twist met an earlier one: start anew within the rest
                z = rng.normal(size=len(z))
            for x in found:
                z -= (x @ z) * x
            z = np.linalg.lstsq(gram - value * (1 + 4 * EPS) * np.eye(len(z)), z, rcond=EPS * EPS)[0]
            for _ in range(2):
                for x in found:
                    z -= (x @ z) * x
            z /= np.linalg.norm(z)
        found.append(z)
    return np.array(wanted), w @ np.array(found).T if found else np.empty((len(r), 0))


# --- all rows --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fit: `rows` (_id, x of whole numbers), their number and sums, directions and values."""

    rows: DataFrame
    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues of the covariance, falling
    directions: np.ndarray  # unit vectors in columns
    trace: float


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n; whole parts first, so that nothing is lost to the shift."""
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def whole_numbers(embeddings: DataFrame, key: str, column: str) -> DataFrame:
    """(_id, x): vectors without null or non-finite entries, as whole numbers.

    Null and empty vectors are dropped, and vectors of another length than most have (of two
    lengths equally often met, the longer counts). Keys may be null or repeated. An entry
    beyond LARGEST is refused.
    """
    entries = F.col(f"`{column}`").cast("array<double>")
    finite = ~F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fits = F.coalesce((F.size(entries) > 0) & finite, F.lit(False))
    whole = F.transform(
        F.col("_v"),
        lambda c: F.when(F.abs(c) <= LARGEST, (F.floor(c * SCALE) + F.lit(SHIFT)).cast("long")).otherwise(
            F.raise_error(F.lit(f"an entry is larger than {LARGEST}")).cast("long")
        ),
    )
    rows = embeddings.select(F.col(f"`{key}`").alias("_id"), F.when(fits, entries).alias("_v"))
    rows = rows.where(F.col("_v").isNotNull())
    usual = rows.groupBy(F.size("_v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = usual["size"] if usual else 0
    return rows.where(F.size("_v") == size).select("_id", whole.alias("x"))


def triangle(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred rows, by blocks and then by a tree of stacked triangles."""
    size = len(sums)

    def reduced(held: np.ndarray | None, block: np.ndarray) -> np.ndarray:
        return np.linalg.qr(block if held is None else np.vstack([held, block]), mode="r")

    def packed(r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if r is not None:
            yield pa.record_batch([pa.array([r.astype("<f8").tobytes()], pa.binary())], ["r"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                held = reduced(held, _centred(_matrix(batch.column(0).slice(at, BLOCK), size), n, sums))
        yield from packed(held)

    def stacks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for r in batch.column(0).to_pylist():
                held = reduced(held, np.frombuffer(r, "<f8").reshape(-1, size))
        yield from packed(held)

    level = stored(rows.select("x").mapInArrow(blocks, "r binary"), "triangles")
    while (left := level.count()) > FAN_IN:
        level = stored(level.repartition(-(-left // FAN_IN)).mapInArrow(stacks, "r binary"), "triangles")
    held = None
    for row in level.collect():  # at most FAN_IN triangles
        held = reduced(held, np.frombuffer(bytes(row["r"]), "<f8").reshape(-1, size))
    full = np.zeros((size, size))
    full[: len(held)] = held
    return full


def fit(embeddings: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening of all usable vectors. Directions of no variance are left out."""
    rows = stored(whole_numbers(embeddings, key, column), "whole-vectors")
    number = rows.selectExpr("posexplode(x) AS (place, v)")
    sums = number.groupBy("place").agg(F.count("v").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    found = sums.orderBy("place").collect()  # one row a dimension
    if not found:
        return Whitening(rows, 0, (), np.empty(0), np.empty((0, 0)), 0.0)
    n, total = found[0]["n"], tuple(int(r["s"]) for r in found)
    r = triangle(rows, n, np.array(total, object if max(map(abs, total)) >= 2**62 else np.int64))
    squares, directions = right_directions(r, components)
    return Whitening(rows, n, total, squares / n, directions, float((r * r).sum() / n))


def whitened(model: Whitening) -> DataFrame:
    """Per vector `_id`, `deviation` (exact) and `w`, its whitened components.

    deviation is the sum over dimensions of (n * x - S)^2; it has to fit into 64 bits.
    """
    n, sums = model.n, model.sums
    scaled = model.directions / np.sqrt(model.values) if len(model.values) else model.directions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array([s // n for s in sums], np.int64)
        rest = [s % n for s in sums]
        part = np.array(rest, float) / n
        low, high = (np.array([f(r, 2**20) for r in rest], np.int64) for f in (lambda r, m: r % m, lambda r, m: r // m))
        square = sum(r * r for r in rest)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                ids, column = batch.column(0).slice(at, BLOCK), batch.column(1).slice(at, BLOCK)
                y = _matrix(column, len(sums)) - whole
                own = zip((y * y).sum(axis=1).tolist(), (y @ low).tolist(), (y @ high).tolist())
                deviation = [n * n * a - 2 * n * (b + c * 2**20) + square for a, b, c in own]
                w = (y - part) @ scaled
                offsets = np.arange(len(w) + 1, dtype=np.int32) * scaled.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))
                yield pa.record_batch([ids, pa.array(deviation, pa.int64()), lists], ["_id", "deviation", "w"])

    schema = model.rows.select("_id", F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("w")).schema
    if not n:
        return model.rows.sparkSession.createDataFrame([], schema)
    return model.rows.select("_id", "x").mapInArrow(run, schema)


def identity_error(rows: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of `w` minus the identity, centred first."""
    if not components:
        return 0.0
    w = [F.col("w")[i] for i in range(components)]
    means = rows.agg(*[F.avg(x) for x in w]).first()
    centred = [x - F.lit(float(m)) for x, m in zip(w, means)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    found = rows.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


def whiten(
    embeddings: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: key, component (from 1), n, deviation, whitened,
    explained, identity_error.

    Repeated rows are kept, null keys too; see `whole_numbers` for vectors left out. An empty
    table gives no rows; so do vectors that are all equal, as they have no direction.
    """
    model = fit(embeddings, key, column, components)
    rows = stored(whitened(model), "whitened")
    error = identity_error(rows, len(model.values))
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if len(model.values) else F.array(F.lit(0.0))
    out = rows.select("_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        F.col("_id").alias(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
