"""Embedding whitening by the singular values of the centred rows.

1. Components become integers ``floor(scale * c) + shift``; tasks add them up,
   which gives exact means.
2. Blockwise QR: each task reduces its centred rows block by block to one
   triangular factor; the factors of several tasks are stacked and reduced
   again until one is left.  The covariance is never formed.
3. On the driver, which holds one triangular factor R of (components)^2
   entries: Householder reflections make R bidiagonal, the shifted quotient
   difference algorithm (dqds) finds the squared singular values, and twisted
   factorisations give the right singular vectors, the whitening directions.
4. Tasks project the centred rows; the covariance of what they get is added up
   and its distance from the identity reported with each row.

Results for edge cases: rows whose vector is null, empty, or holds null or
non-finite components are dropped; so are vectors of another length than the
one with the smallest key (null keys last, ties by components); scaled
components beyond 2**24 count as 2**24; directions without variance cannot be
whitened and have no rows (so one row, or equal rows only, give none); repeated
rows count and are returned each; a null key is kept; a deviation beyond 64 bits
is null; extra columns are not read, whatever their names; an empty table gives
no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .vectors import clean, matrix, smallest, whole

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Bytes of triangular factors that one task stacks.
_STACK = 64 << 20
#: Singular values below this share of the largest are directions without variance.
_RANK = 1e-10
_EPS = np.finfo(float).eps


# --- bidiagonal form -------------------------------------------------------

def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, beta): I - beta v v' sends x to a multiple of the first unit vector."""
    v = x.copy()
    norm = float(np.linalg.norm(x))
    if norm == 0 or not x[1:].any():
        return v, 0.0
    v[0] += math.copysign(norm, x[0])
    return v, 2.0 / float(v @ v)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, W) with r = U B W' for an orthogonal U."""
    a, n = r.astype(float), len(r)
    w = np.eye(n)
    for k in range(n):
        v, beta = _reflector(a[k:, k])
        if beta:
            a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, beta = _reflector(a[k, k + 1:])
            if beta:
                a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ v, v)
                w[:, k + 1:] -= beta * np.outer(w[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


# --- dqds ------------------------------------------------------------------

def _transform(q: list[float], e: list[float], shift: float):
    """One dqds step: new q and e, the intermediate values d; None if the shift is too large."""
    d, new_q, new_e, ds = q[0] - shift, [], [], []
    for k in range(len(e)):
        ds.append(d)
        if d < 0:
            return None
        total = d + e[k] or 1e-300
        new_q.append(total)
        ratio = q[k + 1] / total
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    ds.append(d)
    if d < 0:
        return None
    return [*new_q, d], new_e, ds


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling, by dqds.

    The shift is Newton's bound 1 / sum(1 / d) of the unshifted step, which
    never passes the smallest value, so every intermediate value stays positive
    and small values keep their relative accuracy.
    """
    tiny = 1e-200 + 1e-60 * float(max(np.max(diagonal ** 2), np.max(above ** 2, initial=0.0)))
    found: list[float] = []
    todo = [([max(float(x), tiny) for x in diagonal ** 2], [float(x) for x in above ** 2], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        if e and 1.5 * q[0] < q[-1]:
            q, e = q[::-1], e[::-1]
        for _ in range(200 * len(q) + 200):
            while e and e[-1] <= 1e-32 * (sigma + q[-1]):
                found.append(sigma + q.pop())
                e.pop()
            if not e:
                found.append(sigma + q[0])
                break
            cut = next((k for k in range(len(e)) if e[k] <= 1e-32 * max(sigma, min(q[k], q[k + 1]))), None)
            if cut is not None:
                todo += [(q[:cut + 1], e[:cut], sigma), (q[cut + 1:], e[cut + 1:], sigma)]
                break
            q0, e0, ds = _transform(q, e, 0.0)
            bound = 0.0 if min(ds) <= tiny else (1 - 8 * len(q) * _EPS) / sum(1 / x for x in ds)
            moved = _transform(q, e, bound) if bound > _EPS * sigma * 1e-3 else None
            if moved is None:
                q, e = [max(x, tiny) for x in q0], e0
            else:
                q, e, sigma = [max(x, tiny) for x in moved[0]], moved[1], sigma + bound
        else:
            raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(found))[::-1]


# --- twisted factorisations ------------------------------------------------

class _Twisted:
    """Twisted factorisation of B'B - value: one factor from the top, one from the bottom, joined where they agree best."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        least = _EPS * _EPS * max(value, 1e-300)
        self.down, self.up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        top, bottom = np.zeros(n), np.zeros(n)
        self.d_top, self.d_bottom = np.zeros(n), np.zeros(n)
        s = -value
        for i in range(n):
            top[i] = s
            d = s + a[i] * a[i]
            d = d if abs(d) > least else least
            self.d_top[i] = d
            if i < n - 1:
                self.down[i] = a[i] * b[i] / d
                s = b[i] * b[i] * s / d - value
        p = a[-1] * a[-1] - value
        for i in range(n - 1, -1, -1):
            bottom[i] = p
            if i:
                d = b[i - 1] * b[i - 1] + p
                d = d if abs(d) > least else least
                self.d_bottom[i] = d
                self.up[i - 1] = a[i - 1] * b[i - 1] / d
                p = p * a[i - 1] * a[i - 1] / d - value
        self.gamma = top + bottom + value
        self.at = int(np.argmin(np.abs(self.gamma)))

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.gamma))
        z[self.at] = 1
        for i in range(self.at - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z

    def solve(self, x: np.ndarray) -> np.ndarray:
        """(B'B - value)^-1 x."""
        x, r, n = x.copy(), self.at, len(self.gamma)
        for i in range(r):
            x[i + 1] -= self.down[i] * x[i]
        for i in range(n - 1, r, -1):
            x[i - 1] -= self.up[i - 1] * x[i]
        x[:r] /= self.d_top[:r]
        x[r + 1:] /= self.d_bottom[r + 1:]
        x[r] /= self.gamma[r] if self.gamma[r] else _EPS
        for i in range(r - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(r, n - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x


def right_vectors(a: np.ndarray, b: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Right singular vectors of the bidiagonal matrix for its squared singular values ``squares`` (falling), as columns.

    Vectors of values that lie close together are made orthogonal by inverse
    iteration with the same factorisation.
    """
    scale = math.sqrt(float(squares[0])) or 1.0
    a, b, squares = a / scale, b / scale, squares / scale ** 2
    rng = np.random.Generator(np.random.PCG64(13))
    out = np.zeros((len(a), len(squares)))
    first = 0
    for k, value in enumerate(squares):
        if k and squares[k - 1] - value > 1e-3 * squares[k - 1]:
            first = k
        factors = _Twisted(a, b, float(value))
        z = factors.vector()
        z /= np.linalg.norm(z)
        if first < k:
            close = out[:, first:k]
            for _ in range(4):
                z -= close @ (close.T @ z)
                if np.linalg.norm(z) < 1e-3:
                    z = rng.standard_normal(len(a))
                    z -= close @ (close.T @ z)
                z = factors.solve(z / np.linalg.norm(z))
                z /= np.linalg.norm(z)
                z -= close @ (close.T @ z)
                z -= close @ (close.T @ z)
                z /= np.linalg.norm(z)
        out[:, k] = z
    return out


def directions(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(vectors as columns, squared singular values, sum of all squares) of a triangular factor's first components."""
    total = float((r * r).sum())
    if not total:
        return np.zeros((len(r), 0)), np.zeros(0), 0.0
    a, b, w = bidiagonalise(r)
    squares = squared_singular_values(a, b)
    squares = squares[squares > _RANK ** 2 * squares[0]][:components]
    vectors = w @ right_vectors(a, b, squares)
    vectors /= np.linalg.norm(vectors, axis=0)
    # Either sign is right; the largest entry is positive.
    vectors *= np.where(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(squares))] < 0, -1.0, 1.0)
    return vectors, squares, total


# --- over the table --------------------------------------------------------

class _Centre:
    """Integer rows minus their exact mean, rounded once."""

    def __init__(self, n: int, sums: list[int], scale: int, shift: int):
        self.n, self.size, self.scale, self.shift = n, len(sums), scale, shift
        self.sums = np.array(sums, np.int64)
        self.floor = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def rows(self, column: pa.Array) -> np.ndarray:
        return whole(matrix(column, self.size), self.scale) + self.shift

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor) - self.rest

    def deviations(self, x: np.ndarray) -> pa.Array:
        apart = self.n * x - self.sums
        if not len(x) or int(np.abs(apart).max()) ** 2 * self.size < 1 << 63:
            return pa.array((apart ** 2).sum(1), pa.int64())
        exact = [sum(v * v for v in row) for row in apart.tolist()]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _sums(size: int, scale: int, shift: int):
    """(slot, total) of a task's rows: their number at -1, the sum of each component."""

    def run(batches):
        n, total = 0, np.zeros(size, np.int64)
        for batch in batches:
            x = whole(matrix(batch.column(0), size), scale) + shift
            n, total = n + len(x), total + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, size)), pa.array([n, *total.tolist()], pa.int64())], names=["slot", "total"])

    return run


def _reduced(stack: list[np.ndarray], size: int) -> np.ndarray:
    r = np.linalg.qr(np.vstack(stack), mode="r")
    return r if len(r) == size else np.vstack([r, np.zeros((size - len(r), size))])


def _factors(centre: _Centre):
    """(part, factor): the triangular factor of a task's centred rows."""
    block = 4 * centre.size

    def run(batches):
        r = None
        for batch in batches:
            x = centre.centred(centre.rows(batch.column(0)))
            for first in range(0, len(x), block):
                r = _reduced([*([r] if r is not None else []), x[first:first + block]], centre.size)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())],
                                             names=["part", "factor"])

    return run


def _stacked(size: int):
    def run(key, table):
        ordered = table.sort_by("part")
        r = _reduced([np.frombuffer(f.as_py()).reshape(size, size) for f in ordered.column("factor")], size)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "factor": pa.array([r.tobytes()], pa.binary())})

    return run


def _products(centre: _Centre, project: np.ndarray):
    """(slot, total): sums of the whitened values and of their products over a task's rows."""
    many = project.shape[1]

    def run(batches):
        total = np.zeros((many + 1, many))
        for batch in batches:
            y = centre.centred(centre.rows(batch.column(0))) @ project
            total[0] += y.sum(0)
            total[1:] += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["slot", "total"])

    return run


def _whitened(centre: _Centre, project: np.ndarray, explained: np.ndarray, error: float):
    many = project.shape[1]

    def run(batches):
        for batch in batches:
            x = centre.rows(batch.column(1))
            y = centre.centred(x) @ project
            rows = pa.array(np.repeat(np.arange(len(x)), many))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(rows), centre.n)), centre.deviations(x).take(rows), pa.array(y.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(rows), error))],
                names=["k", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def _one_factor(rows: DataFrame, centre: _Centre, scratch: Scratch) -> np.ndarray:
    """The triangular factor of all centred rows, by a tree over the tasks' factors."""
    fan = max(2, _STACK // (8 * centre.size ** 2))
    level, factors = 0, scratch.put(rows.select("v").mapInArrow(_factors(centre), "part long, factor binary"), "factors0")
    while factors.count() > 1:
        level += 1
        # Tasks are numbered in a row, so each level divides their number by the fan.
        groups = factors.select(F.floor(F.col("part") / fan).cast("long").alias("group"), "part", "factor").groupBy("group")
        factors = scratch.put(groups.applyInArrow(_stacked(centre.size), "part long, factor binary"), f"factors{level}")
    return np.frombuffer(factors.first().factor).reshape(centre.size, centre.size)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
           shift: int = SHIFT) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), a row for each clean row and component."""
    spark = df.sparkSession
    scratch = Scratch(spark, "whitening")
    kind = df.schema[key].dataType.simpleString()
    rest = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    empty = spark.createDataFrame([], f"`{key}` {kind}, {rest}")
    rows = clean(df, key, vector)
    size, _ = smallest(rows, 1)
    if not size:
        return empty
    rows = rows.where(F.size("v") == size)
    sums = rows.select("v").mapInArrow(_sums(size, scale, shift), "slot long, total long")
    totals = {r.slot: r.total for r in sums.groupBy("slot").agg(F.sum("total").alias("total")).collect()}  # a row a component
    centre = _Centre(totals[-1], [totals[i] for i in range(size)], scale, shift)
    vectors, squares, total = directions(_one_factor(rows, centre, scratch), components)
    if not len(squares):
        return empty
    project = vectors / np.sqrt(squares / centre.n)
    many = len(squares)
    found = rows.select("v").mapInArrow(_products(centre, project), "slot long, total double").groupBy("slot").agg(F.sum("total").alias("total"))
    products = np.zeros((many + 1) * many)
    for r in found.collect():  # a row a pair of components
        products[r.slot] = r.total
    products = products.reshape(many + 1, many) / centre.n
    error = float(np.abs(products[1:] - np.outer(products[0], products[0]) - np.eye(many)).max())
    out = rows.select("k", "v").mapInArrow(_whitened(centre, project, squares / total, error), f"k {kind}, {rest}")
    return out.withColumnRenamed("k", key)
