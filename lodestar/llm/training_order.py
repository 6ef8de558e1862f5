"""Training-order materialisation: a keyed permutation into fixed-stride shards.

1. Documents are tokenised (an end id each) and cut into sequences of
   ``LENGTH`` ids, the last one of a document padded.  Each scan task numbers
   its sequences; running totals over the tasks' counts make the numbers dense
   from 0 to N - 1.
2. A keyed Feistel network over the next even power of two, walked until the
   value lies below N, sends each number to its global slot: a permutation
   that needs no sort and no table, and that any reader can compute.
3. The ids go to the task of their slot range (equal ranges of whole shards;
   the permutation spreads any input evenly) and are written sorted, one
   file a shard.  A record is ``2 * LENGTH`` bytes of little-endian unsigned
   16-bit ids and a line feed, so record r of a shard starts at byte
   r * (2 * LENGTH + 1): reads are sequential and can resume at any slot.

The texts are tokenised once for the numbering and once for the writing;
both passes read the same splits of the stored table, so that no copy of the
ids is kept; the second fails if a split's count differs from the first's.

Results for edge cases: null or empty text is one sequence holding the end id
and padding; null ids are kept; repeated rows give sequences each; an empty
table gives no rows and no shard.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import Scratch, partitions, row_slices, text_bytes
from .tokens import word_tokenizer
from .words import U64, mix

LENGTH, END_ID, PAD_ID = 512, 1, 0
#: Sequences of one shard file (32 MB of ids).
SHARD_ROWS = 32_768
ROUNDS = 6


class Permutation:
    """A keyed permutation of 0 .. n - 1."""

    def __init__(self, n: int, key: str):
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        digest = hashlib.blake2b(key.encode(), digest_size=8 * ROUNDS).digest()
        self.keys = np.frombuffer(digest, "<u8")

    def _network(self, x: np.ndarray) -> np.ndarray:
        mask, h = U64((1 << self.half) - 1), U64(self.half)
        left, right = x >> h, x & mask
        for k in self.keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return left << h | right

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        """The slot of each number, by cycle-walking."""
        out = self._network(numbers.astype(np.uint64))
        while len(over := np.flatnonzero(out >= U64(self.n))):
            out[over] = self._network(out[over])
        return out.astype(np.int64)


def _sequences(tokenizer: str, batch: pa.RecordBatch):
    """(first row, ids, sequences of each row, start and size of each sequence in the ids) of slices of rows (doc_id, text)."""
    tokens = word_tokenizer(tokenizer)
    raw, off = text_bytes(batch.column(1))
    for first, stop in row_slices(off):
        own = off[first:stop + 1] - off[first]
        ids, bounds = tokens.ids(raw[off[first]:off[stop]], own)
        ids = np.insert(ids, bounds[1:], END_ID)
        bounds = bounds + np.arange(len(bounds))
        if ids.max() > 0xFFFF:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        many = -(-np.diff(bounds) // LENGTH)
        piece = _ranks(many)
        start = np.repeat(bounds[:-1], many) + piece * LENGTH
        yield first, ids.astype("<u2"), many, start, np.minimum(LENGTH, np.repeat(bounds[1:], many) - start)


def _ranks(many: np.ndarray) -> np.ndarray:
    """0 to many[i] - 1 for each i."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _numbered(tokenizer: str):
    """(split, inside, doc_id, piece, n_tokens, ids_crc32): the checksum covers the unpadded record."""

    def run(batches):
        split, inside = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, ids, many, start, size in _sequences(tokenizer, batch):
                n, data = len(start), memoryview(ids)
                sums = [zlib.crc32(data[a:b]) for a, b in zip(start.tolist(), (start + size).tolist())]
                rows = np.repeat(np.arange(first, first + len(many)), many)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, split, np.int32)), pa.array(np.arange(inside, inside + n)),
                     batch.column(0).take(pa.array(rows)), pa.array(_ranks(many).astype(np.int32)), pa.array(size.astype(np.int32)),
                     pa.array(sums, pa.int64())], names=["split", "inside", "doc_id", "piece", "n_tokens", "ids_crc32"])
                inside += n

    return run


def _records(tokenizer: str, base: dict[int, tuple[int, int]], order: Permutation):
    """(slot, record) of each sequence."""

    def run(batches):
        split = TaskContext.get().partitionId()
        first, count = base.get(split, (0, 0))
        done = 0
        for batch in batches:
            for _, ids, _, start, size in _sequences(tokenizer, batch):
                n = len(start)
                records = np.full((n, LENGTH), PAD_ID, "<u2")
                records[np.arange(LENGTH) < size[:, None]] = ids  # sequences take all ids in order
                slots = order.slots(np.arange(first + done, first + done + n))
                done += n
                offsets = np.arange(0, 2 * LENGTH * n + 1, 2 * LENGTH, dtype=np.int32)
                binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(records)])
                yield pa.RecordBatch.from_arrays([pa.array(slots), binary], names=["slot", "record"])
        if done != count:
            raise RuntimeError(f"split {split} held {count} sequences and now {done}: store the input first")

    return run


def _slots(order: Permutation):
    def run(batches):
        for batch in batches:
            slot = order.slots(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(slot), *batch.columns[1:]], names=["slot", *batch.schema.names[1:]])

    return run


def materialise(docs: DataFrame, path: str, tokenizer: str, seed: str, key: str = "doc_id", text: str = "text",
                shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Write the shards under ``path``; (key, piece, slot, shard, offset, n_tokens, ids_crc32) of each sequence.

    ``docs`` is a stored table (its splits must be the same when read again).
    ``path``/order holds length, count, rows a shard and seed, for readers.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "order")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    numbered = scratch.put(rows.mapInArrow(
        _numbered(tokenizer), "split int, inside long, doc_id long, piece int, n_tokens int, ids_crc32 long"), "numbered")
    counts = numbered.groupBy("split").agg(F.count("*").alias("n"))
    counts = scratch.put(counts.select("split", "n", (F.sum("n").over(W.orderBy("split")) - F.col("n")).alias("first")), "splits")
    base = {r.split: (r.first, r.n) for r in counts.select("split", "n", "first").toLocalIterator()}  # a row a scan task
    total = sum(n for _, n in base.values())
    spark.createDataFrame([(LENGTH, total, shard_rows, seed)], "length int, sequences long, shard_rows long, seed string") \
        .coalesce(1).write.json(f"{path}/order")
    order = Permutation(max(1, total), seed)
    if total:
        shards = -(-total // shard_rows)
        ranges = min(partitions(spark), shards)
        records = rows.mapInArrow(_records(tokenizer, base, order), "slot long, record binary")
        records = records.withColumn("shard", F.floor(F.col("slot") / shard_rows).cast("long"))
        dealt = records.repartitionById(ranges, F.floor(F.col("shard") * ranges / shards).cast("int"))
        dealt.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value")) \
            .write.partitionBy("shard").option("lineSep", "\n").text(f"{path}/shards")
    out = numbered.join(F.broadcast(counts.select("split", "first")), "split").select(  # a row a scan task
        (F.col("first") + F.col("inside")).alias("number"), "doc_id", "piece", "n_tokens", "ids_crc32").mapInArrow(
        _slots(order), "slot long, doc_id long, piece int, n_tokens int, ids_crc32 long")
    return out.select(F.col("doc_id").alias(key), "piece", "slot", F.floor(F.col("slot") / shard_rows).cast("long").alias("shard"),
                      (F.col("slot") % shard_rows * (2 * LENGTH + 1)).alias("offset"), "n_tokens", "ids_crc32")


def read_shard(data: bytes, first: int = 0) -> np.ndarray:
    """Records of a shard file's bytes, from record ``first`` on, as rows of ids."""
    stride = 2 * LENGTH + 1
    whole = np.frombuffer(data, np.uint8)[first * stride:].reshape(-1, stride)
    return np.ascontiguousarray(whole[:, :-1]).view("<u2")
