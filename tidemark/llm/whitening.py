"""Embedding whitening: blockwise QR, Householder bidiagonalisation, dqds, twisted
factorisations.

Each distinct vector counts once. Its centred rows are reduced to one triangle R by
QR decompositions of blocks: each task stacks a block of rows under its triangle and
decomposes again, and the tasks' triangles are joined ``FAN`` by ``FAN`` in a tree, so
the driver gets at most ``FAN`` triangles of d x d numbers, whatever the number of
rows. The covariance R'R / n is never formed: its condition is the square of R's.

Householder reflections turn R into a bidiagonal B = Q' R P. The differential qd
algorithm with shifts (dqds) finds the squares of B's singular values to high relative
accuracy. For each of them two qd transformations of B'B, from the top and from the
bottom, meet in the twisted factorisation whose middle pivot is least, and one back
substitution from there gives the direction, without iterating. Directions of values
that lie close together are made orthogonal. P takes them back to the vectors' space.

Results: components by falling variance, at most ``most``; those whose singular value
is rounding alone (constant or dependent coordinates, fewer distinct vectors than
coordinates) do not exist, so a table of equal vectors has none and gives no rows.
Every direction's largest coordinate is positive. Rows that repeat a vector, an id or
both are whitened one by one and count once in the fit; a null vec_id stays null.

Left out are the rows named in ``vectors.integer_vectors``; an empty table gives no
rows; other columns are ignored. Vectors of any length are taken whole; a component
beyond 1e17 after scaling and a deviation beyond a long are errors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, partition_id
from tidemark.llm.vectors import integer_vectors, matrix

SCALE, OFFSET = 64, 1_000_000
MOST = 16
FAN = 32
BLOCK = 4096
EPS = float(np.finfo(np.float64).eps)
#: relative gap under which directions are made orthogonal to each other
CLOSE = 1e-3


class Whitening(NamedTuple):
    n: int  # distinct vectors
    sums: np.ndarray  # of each coordinate
    axes: np.ndarray  # d x k, columns of length 1
    variances: np.ndarray  # k, falling
    trace: float


def differences(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact."""
    if n * float(np.abs(x).max(initial=0)) + float(np.abs(sums).max(initial=0)) >= 2**62:
        raise OverflowError("n times a component does not fit a long")
    return n * x - sums


def reflection(x: np.ndarray) -> np.ndarray:
    """v of length 1, or zero, with (1 - 2 v v') x along the first axis."""
    v = x.copy()
    v[0] += np.copysign(np.linalg.norm(x), x[0])
    size = np.linalg.norm(v)
    return v / size if size > 0 else v


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and the right transformation P of a square matrix."""
    a, right = r.copy(), np.eye(len(r))
    for k in range(len(a)):
        v = reflection(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < len(a) - 2:
            v = reflection(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def shifted(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds step; None if the shift is above the least value."""
    to_q, to_e, d = [], [], q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return None
        to_q.append(d + e[k])
        t = q[k + 1] / to_q[-1]
        to_e.append(e[k] * t)
        d = d * t - shift
    return (to_q + [d], to_e) if d >= 0 else None


def least_of_last_two(q: list[float], e: list[float]) -> float:
    """The lower value of the last two rows: no less than the least of all."""
    a, c, b2 = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    half = (a + c) / 2
    root = np.sqrt(((a - c) / 2) ** 2 + b2)
    return max(0.0, (a * c - b2) / (half + root)) if half + root > 0 else 0.0


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B from the squares of B's diagonal and superdiagonal, falling."""
    out: list[float] = []
    todo = [([float(x) for x in q], [float(x) for x in e], 0.0)]
    while todo:
        q, e, total = todo.pop()
        if len(q) == 1:
            out.append(total + q[0])
            continue
        cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * (total + min(q[k], q[k + 1])) or e[k] == 0), None)
        if cut is not None:
            todo += [(q[: cut + 1], e[:cut], total), (q[cut + 1 :], e[cut + 1 :], total)]
            continue
        if 1.5 * q[0] < q[-1]:  # large values at the top converge faster
            q, e = q[::-1], e[::-1]
        shift = least_of_last_two(q, e)
        for factor in (1 - 4 * EPS, 0.9, 0.5, 0.1, 0.0):
            stepped = shifted(q, e, shift * factor)
            if stepped is not None:
                todo.append((*stepped, total + shift * factor))
                break
        else:
            raise ArithmeticError("qd step without a shift failed")
    return np.sort(np.array(out))[::-1]


def twisted(d: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """The direction of ``value`` of L D L' (L: ones and ``low`` beside the diagonal)."""
    n, tiny = len(d), EPS * EPS * max(float(np.abs(d).max()), 1e-300)
    safe = lambda x: x if abs(x) > tiny else tiny
    s, down = np.empty(n), np.empty(n - 1)
    s[0] = -value
    for k in range(n - 1):
        down[k] = d[k] * low[k] / safe(s[k] + d[k])
        s[k + 1] = down[k] * low[k] * s[k] - value
    p, up = np.empty(n), np.empty(n - 1)
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        t = d[k] / safe(d[k] * low[k] ** 2 + p[k + 1])
        up[k] = low[k] * t
        p[k] = p[k + 1] * t - value
    middle = int(np.argmin(np.abs(s + p + value)))
    z = np.zeros(n)
    z[middle] = 1
    for k in range(middle - 1, -1, -1):
        z[k] = -down[k] * z[k + 1]
    for k in range(middle, n - 1):
        z[k + 1] = -up[k] * z[k]
    return z / np.linalg.norm(z)


def directions(diagonal: np.ndarray, beside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues of B'B, falling, and their directions as columns."""
    n, top = len(diagonal), float(max(np.abs(diagonal).max(initial=0), np.abs(beside).max(initial=0)))
    b = np.where(np.abs(diagonal) > EPS * EPS * top, diagonal, EPS * EPS * top)  # pivots are divided by
    cuts = [0, *(k + 1 for k in range(n - 1) if abs(beside[k]) <= EPS * top), n]
    values, vectors = np.zeros(n), np.zeros((n, n))
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        q, e = b[low:high], beside[low : high - 1]
        values[low:high] = own = dqds(q**2, e**2)
        held: list[np.ndarray] = []
        for i, value in enumerate(own):
            z = twisted(q**2, e / q[:-1], value) if high - low > 1 else np.ones(1)
            near = [held[j] for j in range(i) if own[j] - value <= CLOSE * own[j] or own[j] <= (4 * n * EPS * top) ** 2]
            held.append(apart(z, near, q, e, value))
        vectors[low:high, low:high] = np.stack(held, axis=1)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def apart(z: np.ndarray, near: list[np.ndarray], q: np.ndarray, e: np.ndarray, value: float) -> np.ndarray:
    """``z`` made orthogonal to the directions near it. If nothing of it is left (values
    equal to rounding), inverse iteration from what is orthogonal to them."""
    rng, b = np.random.default_rng(len(near)), np.diag(q) + np.diag(e, 1)
    t = b.T @ b
    for attempt in range(6):
        for _ in range(2):
            for other in near:
                z = z - (other @ z) * other
        size = np.linalg.norm(z)
        if size > 0.5:
            return z / size
        z = rng.standard_normal(len(q))
        for _ in range(3):
            for other in near:
                z = z - (other @ z) * other
            z = np.linalg.solve(t - (value + (8 << attempt) * EPS * np.abs(t).max()) * np.eye(len(q)), z)
            z /= np.linalg.norm(z)
    raise ArithmeticError("no direction orthogonal to those of equal values")


def triangle(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
    """R of the QR decomposition of all rows, block by block."""
    r = None
    for block in blocks:
        r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
    return r


def column_sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and the exact sum of each coordinate: one row each to the driver."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            if batch.num_rows:
                x = matrix(batch.column(0))
                if float(np.abs(x).max()) * len(x) >= 2**63:
                    x = x.astype(object)
                total = [int(v) for v in x.sum(axis=0)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([len(x)] * len(total), pa.int64()), pa.array([str(v) for v in total])], ["at", "n", "total"])

    sums = rows.select("x").mapInArrow(run, "at int, n long, total string").groupBy("at")
    found = sums.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("at").collect()
    return (int(found[0].n), np.array([int(r.total) for r in found], dtype=np.int64)) if found else (0, np.zeros(0, dtype=np.int64))


def reduced(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The triangle of all centred rows, by a tree of decompositions."""
    d = len(sums)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (differences(matrix(b.column(0).slice(at, BLOCK)), n, sums) / n for b in parts for at in range(0, b.num_rows, BLOCK))
        r = triangle(blocks)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([partition_id()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])

    def join(some: pd.DataFrame) -> pd.DataFrame:
        r = triangle(np.frombuffer(x).reshape(-1, d) for x in some.sort_values("part")["r"])
        return pd.DataFrame({"part": [int(some["part"].iloc[0]) // FAN], "r": [r.tobytes()]})

    triangles = materialize(rows.select("x").mapInArrow(run, "part long, r binary"), "whiten-triangles")
    while triangles.count() > FAN:
        joined = triangles.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(join, "part long, r binary")
        triangles = materialize(joined, "whiten-triangles")
    r = triangle(np.frombuffer(t.r).reshape(-1, d) for t in triangles.orderBy("part").collect())  # at most FAN rows
    return np.vstack([r, np.zeros((max(0, d - len(r)), d))])


def fit(distinct: DataFrame, most: int = MOST) -> Whitening | None:
    """Whitening of rows (x), each of which counts; None for an empty table."""
    n, sums = column_sums(distinct)
    if not n:
        return None
    r = reduced(distinct, n, sums)
    diagonal, beside, right = bidiagonal(r)
    values, vectors = directions(diagonal, beside)
    exist = values > (4 * len(sums) * EPS) ** 2 * values[0] if values[0] > 0 else np.zeros(len(values), dtype=bool)
    values, vectors = values[exist][:most], vectors[:, exist][:, :most]
    # T = B'B has the signs of B's products beside its diagonal; ``twisted`` keeps them.
    axes = right @ vectors
    if axes.size:
        axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    return Whitening(n, sums, axes, values / n, float((r**2).sum()) / n)


def projected(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n * x - sums and the whitened rows."""
    far = differences(x, model.n, model.sums)
    return far, (far / model.n) @ model.axes / np.sqrt(model.variances)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened covariance less the identity; a task's sums are one
    row per pair of components."""
    k = len(model.variances)
    if not k:
        return 0.0
    shared = distinct.sparkSession.sparkContext.broadcast(model)  # d x k numbers

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in parts:
            for at in range(0, batch.num_rows, BLOCK):
                w = projected(matrix(batch.column(0).slice(at, BLOCK)), shared.value)[1]
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["at", "value"])

    rows = distinct.select("x").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    total = np.zeros((k + 1) * k)
    for at, value in rows.collect():
        total[at] = value
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation (exact), whitened (one number a component) of rows (vec_id, x)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                far, w = projected(matrix(some.column(1)), shared.value)
                if float(np.abs(far).max()) ** 2 * far.shape[1] >= 2**63:
                    deviation = [sum(int(v) ** 2 for v in row) for row in far]
                else:
                    deviation = (far**2).sum(axis=1)
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(deviation, pa.int64()), values], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = materialize(integer_vectors(embeddings, SCALE, OFFSET), "whiten-rows")
    distinct = materialize(rows.select("x").distinct(), "whiten-distinct")
    model = fit(distinct)
    if model is None:
        model = Whitening(0, np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0)
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.variances)).cast("array<double>")
    out = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(identity_error(distinct, model)).alias("identity_error"),
    )
