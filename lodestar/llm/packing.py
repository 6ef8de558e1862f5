"""Best-fit packing by a length histogram.

1. Each document's token ids (with an end id) are cut into pieces of the
   sequence length; only the last piece of a document is shorter.  Pieces are
   written once, with length and checksum.
2. A histogram of piece lengths, one count for each possible length, goes to
   the driver (its size is the sequence length, not the data).  Best fit,
   longest first, runs over counts: all pieces of one length go in one step
   into the sequences with the least room that holds them, or into new ones.
   The plan is a list of runs: the pieces of one length with ranks a to b go to
   consecutive sequences at one offset.
3. A piece's rank within its length comes from a hash of its id: a count for
   each (length, part), running totals over these counts, and the row number
   inside a part.  No task gets a whole length, however common.
4. Pieces find their run by length and rank.

Results for edge cases: a null or empty text is one piece holding the end id;
a null id is kept (its piece has a null id); repeated rows are packed each; an
empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Scratch, partitions, row_slices, text_bytes
from .tokens import word_tokenizer

LENGTH = 4096
END_ID = 1
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_TEXT_BYTES = 1 << 20


def _pieces(tokenizer: str, length: int, end_id: int, with_ids: bool):
    """(doc_id, piece, start, length, ids_crc32[, ids]) of rows (doc_id, text)."""
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * length

    def run(batches):
        tokens = word_tokenizer(tokenizer)
        for batch in batches:
            raw, off = text_bytes(batch.column(1))
            for first, stop in row_slices(off, _TEXT_BYTES):
                doc, piece, start, size, crc, payload = [], [], [], [], [], []
                found, bounds = tokens.ids(raw[off[first]:off[stop]], off[first:stop + 1] - off[first])
                bounds = bounds.tolist()
                for i in range(stop - first):
                    ids = found[bounds[i]:bounds[i + 1]].tobytes() + end
                    for n, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        doc.append(first + i)
                        piece.append(n)
                        start.append(at // 4)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        payload.append(part if with_ids else None)
                columns = [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(payload, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def best_fit(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Runs (piece length, first rank, pieces, first sequence, offset) that place every piece.

    Longest first; each step fills the sequences with the least room left.
    A sequence takes several pieces of one length where they fit.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, sequences)
    rooms: list[int] = []
    runs, sequences = [], 0

    def leave(space: int, first: int, many: int) -> None:
        if space > 0:
            if space not in room:
                bisect.insort(rooms, space)
                room[space] = []
            room[space].append((first, many))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at < len(rooms):
                space = rooms[at]
                first, many = room[space].pop()
                if not room[space]:
                    del room[space], rooms[at]
            else:
                space, first, many = length, sequences, -(-left // (length // size))
                sequences += many
            take = min(left, many)
            runs.append((size, rank, take, first, length - space))
            leave(space - size, first, take)
            if many > take:
                leave(space, first + take, many - take)
            rank, left = rank + take, left - take
    return runs


def _place(runs: list[tuple[int, int, int, int, int]], width: int):
    """Appends (sequence_id, offset) to rows whose last two columns are length and rank."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    begins = {int(n): (int(a), int(b)) for n, a, b in zip(*_bounds(table[:, 0]))}

    def run(batches):
        for batch in batches:
            size, rank = (batch.column(i).to_numpy() for i in (width - 2, width - 1))
            at = np.empty(len(size), np.int64)
            for n in np.unique(size):
                lo, hi = begins[int(n)]
                own = size == n
                at[own] = lo + np.searchsorted(table[lo:hi, 1], rank[own], side="right") - 1
            found = table[at]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width - 1], pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])],
                names=[*batch.schema.names[:width - 1], "sequence_id", "offset"])

    return run


def _bounds(values: np.ndarray):
    keys, first = np.unique(values, return_index=True)
    return keys, first, np.append(first[1:], len(values))


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids], sequence_id, offset), a row for each piece.

    ``with_ids`` adds the piece's ids as little-endian unsigned 32-bit values:
    sequence_id and offset then order them into full training sequences.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = _PIECES + ", ids binary" * with_ids
    pieces = rows.mapInArrow(_pieces(tokenizer, length, end_id, with_ids), schema)
    # The random draw parts repeated rows as well; the written table fixes it.
    part = F.pmod(F.xxhash64("doc_id", "piece", F.rand(17)), F.lit(max(1, partitions(spark) // 8)))
    pieces = scratch.put(pieces.withColumn("part", part.cast("int")), "pieces")
    sums = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    # At most (sequence length) x (parts) counts.
    before = sums.select("length", "part", (F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    before = scratch.put(before, "before")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `length` rows
    inside = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("inside", inside).join(before, ["length", "part"])
    fields = [c for c in pieces.columns if c not in ("length", "part")]
    ranked = ranked.select(*fields, "length", (F.col("inside") + F.col("before")).cast("long").alias("rank"))
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    placed = ranked.mapInArrow(_place(best_fit(counts, length), len(ranked.columns)), f"{names}, sequence_id long, offset long")
    order = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", "offset"]
    return placed.select(*[F.col(c).alias(key if c == "doc_id" else c) for c in order])
