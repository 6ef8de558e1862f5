"""Vector code compression: product codes, nearest entries by Orchard's search.

1. A vector's components become integers, ``floor(scale * x)``, and are cut
   into equal parts.  Each part position has a codebook of its own, which
   starts as that part of the vectors with the smallest keys.
2. Nearest entries by Orchard's search: every entry has the list of all
   entries sorted by their distance from it.  A query walks the list of its
   best entry so far; an entry that improves becomes the best and its list is
   walked instead; entries met before are marked and not measured again; the
   walk ends where the list is farther than twice the current distance, as by
   the triangle inequality nothing nearer can follow.  The queries of a batch
   take their steps together.
3. A round assigns every part and replaces each entry by the componentwise
   floor of its parts' mean.  Each task sums its parts by entry; Spark adds
   the sums of the tasks; the driver gets one row an entry and component (the
   size of the codebooks, not of the data).
4. A last assignment writes code and error of each vector.

Distances are squared Euclidean and exact (64-bit integers), ties go to the
lower index, so every run and every partitioning gives the same codes.

Results for edge cases: rows whose vector is null, empty, or holds null or
non-finite components are dropped; so are vectors of another length than the
one with the smallest key (null keys last, ties by components); that length
must be a multiple of the parts, else ValueError; scaled components beyond
2**24 count as 2**24; fewer rows than entries give smaller codebooks; repeated
rows are kept, each with its code; a null key or label is kept; equal labels
include null with null; extra columns are not read, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .vectors import clean, matrix, smallest, whole

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Queries that take their steps together; bounds the marks (one byte a query and entry).
_BATCH = 8192
#: Label totals up to this many rows are broadcast.
_FEW_LABELS = 1 << 16


class Orchard:
    """Exact nearest entries of one codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)
        self.by_sum = np.argsort(entries.sum(1), kind="stable")
        self.sums = entries.sum(1)[self.by_sum]
        self.measured = 0

    def _distance(self, queries: np.ndarray, entry: np.ndarray) -> np.ndarray:
        self.measured += len(entry)
        return ((queries - self.entries[entry]) ** 2).sum(1)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (the lowest of several) and its squared distance."""
        n, size = len(queries), len(self.entries)
        # The walk may start anywhere: an entry with about the query's component sum.
        best = self.by_sum[np.minimum(np.searchsorted(self.sums, queries.sum(1)), size - 1)]
        least = self._distance(queries, best)
        marked = np.zeros((n, size), bool)
        marked[np.arange(n), best] = True
        step = np.zeros(n, np.int64)
        walking = np.arange(n)
        while len(walking):
            walking = walking[step[walking] < size]
            own, at = best[walking], step[walking]
            # Squares: beyond twice the distance; an entry at exactly twice may tie.
            near = self.apart[own, at] <= 4 * least[walking]
            walking, own, at = walking[near], own[near], at[near]
            entry = self.order[own, at]
            step[walking] += 1
            new = ~marked[walking, entry]
            query, entry = walking[new], entry[new]
            marked[query, entry] = True
            apart = self._distance(queries[query], entry)
            better = (apart < least[query]) | ((apart == least[query]) & (entry < best[query]))
            query, entry = query[better], entry[better]
            best[query], least[query], step[query] = entry, apart[better], 0
        return best, least


@dataclass
class Codebooks:
    """Integer entries as (part, entry, component), and the scale of components."""

    entries: np.ndarray
    scale: int = SCALE

    @property
    def size(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _assigned(vectors: np.ndarray, searches: list[Orchard], scale: int):
    """(rows, parts of the vectors, entry of each part, squared distance of each part) of each batch."""
    for first in range(0, len(vectors), _BATCH):
        rows = slice(first, min(first + _BATCH, len(vectors)))
        parts = whole(vectors[rows], scale).reshape(rows.stop - first, len(searches), -1)
        found = [s.nearest(parts[:, p]) for p, s in enumerate(searches)]
        yield rows, parts, np.stack([e for e, _ in found], 1), np.stack([d for _, d in found], 1)


def _sums(books: Codebooks):
    """(slot, n, total): of each (part, entry, component) that has rows in a task, its parts and their sum."""
    count, many, width = books.entries.shape

    def run(batches):
        searches = [Orchard(e) for e in books.entries]
        totals, n = np.zeros((count, many, width), np.int64), np.zeros((count, many), np.int64)
        for batch in batches:
            for _, parts, entry, _ in _assigned(matrix(batch.column(0), books.size), searches, books.scale):
                for p in range(count):
                    np.add.at(totals[p], entry[:, p], parts[:, p])
                    n[p] += np.bincount(entry[:, p], minlength=many)
        each = np.repeat(n.ravel(), width)
        some = np.flatnonzero(each)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(each[some]), pa.array(totals.ravel()[some])],
                                         names=["slot", "n", "total"])

    return run


def _coded(books: Codebooks):
    """(k, m0, ..., code, error) of rows (k, v, m0, ...)."""

    def run(batches):
        searches = [Orchard(e) for e in books.entries]
        for batch in batches:
            codes, errors = [], []
            for _, _, entry, apart in _assigned(matrix(batch.column(1), books.size), searches, books.scale):
                digits = entry.astype(np.uint8 if len(books.entries[0]) <= 256 else ">u2").tobytes().hex()
                step = len(digits) // len(entry)
                codes += [digits[i:i + step] for i in range(0, len(digits), step)]
                errors.append(apart.sum(1))
            rest = [batch.column(0), *batch.columns[2:]]
            error = np.concatenate(errors) if errors else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*rest, pa.array(codes, pa.string()), pa.array(error)],
                                             names=[batch.schema.names[0], *batch.schema.names[2:], "code", "error"])

    return run


def _trained(rows: DataFrame, length: int, first: list[list[float]], parts: int, rounds: int, scale: int) -> Codebooks:
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    start = whole(np.array(first, np.float64), scale).reshape(len(first), parts, -1)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)), scale)
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(_sums(books), "slot long, n long, total long")
        found = sums.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()  # a row a codebook component
        flat = books.entries.copy().ravel()
        for r in found:
            flat[r.slot] = r.total // r.n
        books = Codebooks(flat.reshape(books.entries.shape), scale)
    return books


def train(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
          rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks fitted on every clean row of ``df``; None if there is none."""
    Scratch(df.sparkSession, "codes")  # sends the code to the workers
    rows = clean(df, key, vector)
    length, first = smallest(rows, entries)
    return _trained(rows.where(F.size("v") == length), length, first, parts, rounds, scale) if length else None


def encode(df: DataFrame, books: Codebooks, key: str = "vec_id", vector: str = "embedding", more: tuple[str, ...] = ()) -> DataFrame:
    """(key, more..., code, error) of each clean row as long as the codebooks' vectors."""
    rows = clean(df, key, vector, *more).where(F.size("v") == books.size)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "v"]
    coded = rows.mapInArrow(_coded(books), ", ".join([*kinds, "code string", "error long"]))
    return coded.toDF(key, *more, "code", "error")


def decode(code: str, books: Codebooks) -> list[float]:
    """The vector that a code stands for."""
    parts = len(books.entries)
    step = len(code) // parts
    return [x / books.scale for p in range(parts) for x in books.entries[p][int(code[p * step:(p + 1) * step], 16)].tolist()]


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of each clean row.

    ``label_error`` adds the errors of all rows with the same label.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "codes")
    kind = df.schema[key].dataType.simpleString()
    books = train(df, key, vector, parts, entries, rounds, scale)
    if books is None:
        return spark.createDataFrame([], f"`{key}` {kind}, code string, error long, label_error long, codebooks_sha256 string")
    rows = df.select(F.col(key).alias("k"), F.col(vector).alias("v"), F.col(label).alias("l"))
    coded = scratch.put(encode(rows, books, "k", "v", ("l",)), "coded")
    totals = scratch.put(coded.groupBy("l").agg(F.sum("error").alias("label_error")).withColumnRenamed("l", "of"), "totals")
    # Beyond the bound a shuffle join, whose hot labels AQE splits on the side of the rows.
    side = F.broadcast(totals) if totals.count() <= _FEW_LABELS else totals
    return coded.join(side, F.col("l").eqNullSafe(F.col("of"))).select(
        F.col("k").alias(key), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
