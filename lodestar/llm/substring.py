"""Repeated substrings: fixed-block anchors, rolling probes, extension to exact repeats.

A repeat is a run of at least ``words`` consecutive words that also starts in
a document with a smaller id.

1. Anchors.  Each document is cut into non-overlapping blocks of
   ``(words + 1) // 2`` words.  Wherever a repeat of ``words`` words lies, it
   holds one whole block of the earlier document.  An index keeps the smallest
   document of each block.
2. Probes.  Every rolling window of that block length, of every document, looks
   up the index.  Blocks and probes travel packed: a task sends one binary
   row for each slice of texts and key range, with 4 bytes a probe and the
   documents as small differences.
3. Extension.  Around each hit, in the probing and in the earlier document,
   the windows of ``words`` words that hold the anchor are looked up the same
   way by a full 64-bit key (plus the key range); the ones whose smallest
   document is another are repeats.  Overlapping and adjacent ones merge, which
   gives the maximal repeats.

A passage in very many documents costs each of them its own windows, never a
pair of documents.  Key ranges scale with the session's shuffle partitions.

Results for edge cases: null or empty text has no words, nothing is removed,
and the kept text is empty; a repeat within one document alone is not one; of
exact copies the smallest id stays whole; rows without an id, and rows that
repeat an id, neither remove nor lose anything by each other (a null id
is never earlier); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, partitions, row_slices, text_bytes
from .words import U64, Words, mix, words_of

WORDS = 13
#: Text bytes of one packed row group; larger means better packed probes.
_PACK_BYTES = 8 << 20
_PACKED = pa.schema([("range", pa.int32()), ("blocks", pa.binary()), ("block_docs", pa.binary()),
                     ("probes", pa.binary()), ("probe_docs", pa.binary())])
_PACKED_DDL = "range int, blocks binary, block_docs binary, probes binary, probe_docs binary"
_HITS = pa.schema([("part", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary())])
_HITS_DDL = "part int, docs binary, counts binary, keys binary"


def _small(values: np.ndarray) -> bytes:
    """Ascending integers as a first value and differences of the least width that holds them."""
    if not len(values):
        return b""
    step = np.diff(values)
    most = int(step.max(initial=0))
    kind = next(k for k in (1, 2, 4, 8) if most < 1 << (8 * k - 1))
    return bytes([kind]) + np.int64(values[0]).tobytes() + step.astype(f"<i{kind}").tobytes()


def _large(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int64)
    step = np.frombuffer(packed, f"<i{packed[0]}", offset=9).astype(np.int64)
    return np.cumsum(np.concatenate([np.frombuffer(packed, np.int64, 1, 1), step]))


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


def _packed(docs_of_blocks, blocks, docs_of_probes, probes, ranges, width):
    """A row for each key range; documents ascend within it."""

    def sides(docs, keys):
        if len(docs) and (docs[1:] < docs[:-1]).any():
            order = np.argsort(docs, kind="stable")
            docs, keys = docs[order], keys[order]
        where = _range_of(keys, ranges).astype(np.uint16 if ranges < 1 << 16 else np.int64)
        order = np.argsort(where, kind="stable")
        return docs[order], keys[order], np.searchsorted(where[order], np.arange(ranges + 1))

    bd, bk, bc = sides(docs_of_blocks, blocks)
    pd, pk, pc = sides(docs_of_probes, probes)
    rows = [r for r in range(ranges) if bc[r] < bc[r + 1] or pc[r] < pc[r + 1]]
    take = lambda d, k, c: ([k[c[r]:c[r + 1]].astype(width).tobytes() for r in rows],
                            [_small(d[c[r]:c[r + 1]]) for r in rows])
    b, bdocs = take(bd, bk, bc)
    p, pdocs = take(pd, pk, pc)
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *(pa.array(x, pa.binary()) for x in (b, bdocs, p, pdocs))],
                                      schema=_PACKED)


def _sliced_words(column: pa.Array, limit: int):
    raw, off = text_bytes(column)
    for first, end in row_slices(off, limit):
        yield words_of(raw[off[first]:off[end]], off[first:end + 1] - off[first]), slice(first, end)


def _texts(batch: pa.RecordBatch, limit: int):
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for words, rows in _sliced_words(batch.column(1), limit):
        yield ids[rows], words, rows


def _anchors(size: int, ranges: int):
    """Packed blocks and probes of the rows (doc_id, text)."""

    def run(batches):
        for batch in batches:
            for ids, words, _ in _texts(batch, _PACK_BYTES):
                keys, at = words.windows(words.hashes(), size, seed=41)
                if not len(keys):
                    continue
                doc = words.doc()[at]
                docs = ids[doc]
                aligned = (at - words.first[doc]) % size == 0
                yield _packed(docs[aligned], keys[aligned], docs, keys, ranges, "<u4")

    return run


def _matched(width: str, parts: int):
    """Of one key range: documents with their keys that another shares, of which one has it as a block."""

    def run(key, table):
        blocks, block_docs, probes, probe_docs = ([x.as_py() for x in table.column(c)] for c in
                                                  ("blocks", "block_docs", "probes", "probe_docs"))
        k = np.concatenate([np.frombuffer(x, width) for x in blocks])
        d = np.concatenate([_large(x) for x in block_docs])
        p = np.concatenate([np.frombuffer(x, width) for x in probes])
        pd = np.concatenate([_large(x) for x in probe_docs])
        order = np.lexsort((d, k))
        k, d = k[order], d[order]
        head = np.ones(len(k), bool)
        head[1:] = k[1:] != k[:-1]
        k, d = k[head], d[head]  # the smallest document of each block
        hit_docs, hit_keys = np.zeros(0, np.int64), np.zeros(0, p.dtype)
        if len(k) and len(p):
            at = np.minimum(np.searchsorted(k, p), len(k) - 1)
            some = (k[at] == p) & (pd >= d[at])
            at, hit_docs, hit_keys = at[some], pd[some], p[some]
            shared = np.zeros(len(k), bool)
            shared[at[hit_docs > d[at]]] = True
            hit_docs, hit_keys = hit_docs[shared[at]], hit_keys[shared[at]]
        return _by_part(hit_docs, hit_keys, key[0].as_py(), parts)

    return run


def _repeated(parts: int):
    """Of one key range: documents with their windows that also start in a smaller one."""

    def run(key, table):
        p = np.concatenate([np.frombuffer(x.as_py(), "<u8") for x in table.column("probes")])
        d = np.concatenate([_large(x.as_py()) for x in table.column("probe_docs")])
        order = np.lexsort((d, p))
        p, d = p[order], d[order]
        head = np.ones(len(p), bool)
        head[1:] = p[1:] != p[:-1]
        least = d[head][np.cumsum(head) - 1]
        later = d > least
        return _by_part(d[later], p[later], 0, parts)

    return run


def _by_part(docs: np.ndarray, keys: np.ndarray, where: int, parts: int) -> pa.Table:
    """The distinct keys of each document, a row for each part of the documents; 4-byte keys with the key range above them."""
    if keys.dtype.itemsize == 4:
        keys = keys.astype(np.uint64) | U64(where << 32)
    part = (mix(docs.astype(np.uint64)) % U64(parts)).astype(np.int32)
    order = np.lexsort((keys, docs, part))
    docs, keys, part = docs[order], keys[order], part[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1])
    docs, keys, part = docs[new], keys[new], part[new]
    found = np.unique(part)
    cut = np.append(np.searchsorted(part, found), len(part))
    rows: list[tuple] = []
    for lo, hi in zip(cut[:-1], cut[1:]):
        own, counts = np.unique(docs[lo:hi], return_counts=True)
        rows.append((_small(own), counts.astype("<u4").tobytes(), keys[lo:hi].tobytes()))
    return pa.Table.from_arrays([pa.array(found, pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(3))], schema=_HITS)


def _collated(key, table):
    """(doc_id, keys): all keys of each document of one part."""
    docs, counts = [], []
    for d, c in zip(table.column("docs").to_pylist(), table.column("counts").to_pylist()):
        docs.append(_large(d))
        counts.append(np.frombuffer(c, "<u4"))
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()])
    docs = np.repeat(np.concatenate(docs), np.concatenate(counts))
    order = np.argsort(docs, kind="stable")
    docs, keys = docs[order], keys[order]
    own, first = np.unique(docs, return_index=True)
    return pa.table({"doc_id": pa.array(own, pa.int64()), "keys": pa.array([k.tobytes() for k in np.split(keys, first[1:])], pa.binary())})


def _keys_of(column) -> list[np.ndarray]:
    return [np.frombuffer(x or b"", np.uint64) for x in column.to_pylist()]


def _around(size: int, words_least: int, ranges: int):
    """Packed windows that hold an anchor hit, of rows (doc_id, text, keys)."""

    def run(batches):
        for batch in batches:
            hits = _keys_of(batch.column(2))
            for ids, words, rows in _texts(batch, _PACK_BYTES):
                h = words.hashes()
                keys, at = words.windows(h, size, seed=41)
                short = (keys & U64(0xFFFFFFFF)) | (_range_of(keys, ranges).astype(np.uint64) << U64(32))
                first = np.searchsorted(at, words.first)
                near = np.zeros(len(words.start) + 1, np.int64)
                for i, own in enumerate(hits[rows]):
                    lo, hi = first[i], first[i + 1]
                    found = at[lo:hi][np.isin(short[lo:hi], own)]
                    np.add.at(near, np.maximum(found - (words_least - size), words.first[i]), 1)
                    near[found + 1] -= 1
                near = np.cumsum(near) > 0
                long, starts = words.windows(h, words_least, seed=42)
                some = near[starts]
                none = np.zeros(0, np.uint64)
                docs = ids[words.doc()[starts[some]]]
                if len(docs):
                    yield _packed(none.astype(np.int64), none, docs, long[some], ranges, "<u8")

    return run


def covered_words(words: Words, found: list[np.ndarray], least: int) -> np.ndarray:
    """Which words lie in a window whose key is among the text's ``found`` keys."""
    if not any(len(own) for own in found):
        return np.zeros(len(words.start), bool)
    keys, at = words.windows(words.hashes(), least, seed=42)
    first = np.searchsorted(at, words.first)
    cover = np.zeros(len(words.start) + 1, np.int64)
    for i, own in enumerate(found):
        if len(own):
            hit = at[first[i]:first[i + 1]][np.isin(keys[first[i]:first[i + 1]], own)]
            cover[hit] += 1
            cover[hit + least] -= 1
    return np.cumsum(cover)[:-1] > 0


def repeat_keys(docs: DataFrame, scratch: Scratch, key: str, text: str, least: int = WORDS) -> DataFrame:
    """(doc_id, keys): the documents with repeats, and the keys of their repeated windows."""
    spark, size = docs.sparkSession, (least + 1) // 2
    ranges, parts = 2 * partitions(spark), max(1, partitions(spark) // 2)
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def by_doc(packed: DataFrame, lookup, name: str) -> DataFrame:
        hits = packed.groupBy("range").applyInArrow(lookup, _HITS_DDL)
        # A document's keys are no more than its own windows.
        found = scratch.put(hits.groupBy("part").applyInArrow(_collated, "doc_id long, keys binary"), name)
        scratch.settle()
        return found

    anchored = by_doc(rows.mapInArrow(_anchors(size, ranges), _PACKED_DDL), _matched("<u4", parts), "anchored")
    near = rows.join(anchored, "doc_id").select("doc_id", "text", "keys")
    return by_doc(near.mapInArrow(_around(size, least, ranges), _PACKED_DDL), _repeated(parts), "repeats")


def _kept(words: Words, gone: np.ndarray, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts without the ``gone`` words.

    ``spaced``: the kept words joined by one space; else each gone word goes
    with the white space after it and the rest of the text stays as it is.
    """
    raw = words.raw
    ends = np.cumsum(np.concatenate([[0], np.diff(words.bounds)]))
    if spaced:
        marks = np.zeros(len(raw) + 1, np.int8)
        kept = np.flatnonzero(~gone)
        marks[words.start[kept]] += 1
        doc = words.doc()[kept]
        last = np.ones(len(kept), bool)
        last[:-1] = doc[1:] != doc[:-1]
        raw = raw.copy()
        raw[words.end[kept[~last]]] = 0x20
        stop = words.end[kept] + ~last
        marks[stop] -= 1
        keep = np.cumsum(marks[:-1], dtype=np.int32) > 0
    else:
        marks = np.zeros(len(raw) + 1, np.int32)
        at = np.flatnonzero(gone)
        doc = words.doc()[at]
        following = np.append(words.start, len(raw))[at + 1] if len(at) else at
        np.add.at(marks, words.start[at], 1)
        np.add.at(marks, np.minimum(following, words.bounds[doc + 1]), -1)
        keep = np.cumsum(marks[:-1]) == 0
    total = np.concatenate([[0], np.cumsum(keep)])
    return raw[keep], total[ends]


def _digests(least: int):
    """(key, n_words, n_removed, kept_sha256) of rows (key, text, keys)."""

    def run(batches):
        for batch in batches:
            found = _keys_of(batch.column(2))
            for words, rows in _sliced_words(batch.column(1), 1 << 20):
                gone = covered_words(words, found[rows], least)
                total = np.concatenate([[0], np.cumsum(gone)])
                text, off = _kept(words, gone, spaced=True)
                text = memoryview(text)
                sha = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(rows.start, rows.stop - rows.start), pa.array(words.counts),
                     pa.array(total[words.first[1:]] - total[words.first[:-1]]), pa.array(sha, pa.string())],
                    names=[batch.schema.names[0], "n_words", "n_removed", "kept_sha256"])

    return run


def _spans(least: int):
    """(key, first_word, n_words): maximal repeats of rows (key, text, keys)."""

    def run(batches):
        for batch in batches:
            found = _keys_of(batch.column(2))
            for ids, words, rows in _texts(batch, 1 << 20):
                gone = covered_words(words, found[rows], least)
                doc = words.doc()
                edge = np.ones(len(gone), bool)
                edge[1:] = (gone[1:] != gone[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(edge)
                length = np.diff(np.append(at, len(gone)))
                some = gone[at]
                at, length = at[some], length[some]
                yield pa.RecordBatch.from_arrays([pa.array(ids[doc[at]]), pa.array(at - words.first[doc[at]]), pa.array(length)],
                                                 names=[batch.schema.names[0], "first_word", "n_words"])

    return run


def _cutting(least: int, place: int):
    """Rows of all columns and, last, their keys: the repeats are cut from the text in column ``place``."""

    def run(batches):
        for batch in batches:
            found = _keys_of(batch.column(batch.num_columns - 1))
            texts = []
            for words, rows in _sliced_words(batch.column(place), 1 << 20):
                text, off = _kept(words, covered_words(words, found[rows], least), spaced=False)
                text = text.tobytes()
                texts += [text[a:b].decode() for a, b in zip(off[:-1], off[1:])]
            there = batch.column(place).is_valid().to_pylist()
            changed = pa.array([new if known else None for known, new in zip(there, texts)], pa.string())
            columns = [changed if i == place else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return run


def _with_keys(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """The rows and columns of ``docs`` and, last, the keys of their repeats."""
    found = repeat_keys(docs, Scratch(docs.sparkSession, "substring"), key, text, least)
    found = found.select(F.col("doc_id").alias("__doc_of_keys"), F.col("keys").alias("__keys_of_doc"))
    return docs.join(found, docs[key].cast("long") == F.col("__doc_of_keys"), "left").select(*docs.columns, "__keys_of_doc")


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = WORDS) -> DataFrame:
    """``docs`` with the repeated words (and the white space after each) cut from the text."""
    return _with_keys(docs, key, text, least).mapInArrow(_cutting(least, docs.columns.index(text)), docs.schema)


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = WORDS) -> DataFrame:
    """(key, first_word, n_words): the maximal repeats, by word position; a row without an id has none."""
    rows = _with_keys(docs.select(F.col(key).cast("long").alias(key), text), key, text, least)
    return rows.where("__keys_of_doc IS NOT NULL").mapInArrow(_spans(least), f"`{key}` long, first_word long, n_words long")


def substring_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = WORDS) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256), a row for each input row."""
    rows = _with_keys(docs.select(F.col(key).cast("long").alias(key), text), key, text, least)
    return rows.mapInArrow(_digests(least), f"`{key}` long, n_words long, n_removed long, kept_sha256 string")
