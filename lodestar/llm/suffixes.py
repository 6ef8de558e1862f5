"""Suffix-array deduplication: a distributed merge sort of suffixes that never compares a known prefix twice.

A string of ``least`` bytes that also starts in a document with a smaller id
is a repeat; every byte of it goes.

1. Synchronising suffixes.  Of the ``least``-byte window at every byte, one
   position is picked by its content alone: the smallest hash of the k-byte
   strings inside.  Equal windows pick the same place, so comparing what lies
   around picked positions compares all windows, at about one suffix for every
   16 bytes.  A suffix stands for the windows that picked it: some bytes to its
   left, the rest to its right.
2. Suffixes whose first k bytes occur in one document only cannot repeat and
   do not travel: tasks exchange a hash of each (document, hash), one document
   a task and hash, and documents get back the hashes that others share.
3. Sorted runs.  Each task sorts the remaining suffixes of its slice, drops
   the ones whose smaller copy it holds, cuts the run at splitters that come
   from a sample, and sends each piece front-coded: the length of the prefix
   shared with the suffix before, and only the bytes after it.
4. Merge.  A range's runs meet in a loser tree that keeps, for every loser, the
   prefix it shares with the one that beat it: it compares these lengths, and
   bytes beyond them only where they are equal.  Its output is the sorted order
   with the common prefix of all neighbours (an LCP array).
5. In it, the windows at one distance left of their suffix are equal where the
   common prefixes are long enough and the bytes to the left, ranked the same
   way, agree.  The ones that a smaller document has too are sent to their
   documents as byte spans; these merge to the maximal removed runs.

Skew: a hash that holds more than an eighth of its range of step 2 (a line in
very many documents) is hot.  The windows of hot suffixes travel one by one,
sorted by all their bytes and dealt by a hash of them, so that what surrounds
a common passage spreads over all tasks; of equal ones a task sends one
document's.  The hot list is at most eight hashes a range.

A text is worked on in pieces of a few megabytes that overlap, however long.

Results for edge cases: a null or empty text has no bytes and nothing is
removed; a repeat within one document alone is not one; of exact copies the
smallest id stays whole; a row without an id neither removes nor loses; rows
that repeat an id do not remove from each other; extra columns are not read,
or kept as they are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, partitions, row_slices, text_bytes
from .substring import _large, _small
from .words import _POWERS, U64, mix

LEAST = 50
#: Text bytes of one sorted run; bounds the memory of a task.
RUN_BYTES = 4 << 20
#: One document in so many is in the splitters' sample.
_SAMPLED = 32
_SPANS_DDL = "part int, docs binary, tags binary, first binary, stop binary"
_RUNS_DDL = "range int, shared binary, right binary, reach binary, left binary, tails binary, lefts binary, docs binary, tags binary, at binary"
_FOUND_DDL = "part int, docs binary, counts binary, keys binary"


# --- windows and their suffixes --------------------------------------------

@dataclass
class Shape:
    """Lengths: a repeat's least bytes, the windows a suffix may stand for, the bytes that a hash covers."""

    least: int

    @property
    def windows(self) -> int:
        return max(1, min(32, self.least * 2 // 3))

    @property
    def k(self) -> int:
        return self.least - self.windows + 1

    @property
    def right(self) -> int:
        """Bytes kept right of a suffix, in whole 8-byte words."""
        return -(-self.least // 8) * 8

    @property
    def left(self) -> int:
        return 32


def _pieces(column: pa.Array, least: int):
    """(bytes, offsets, rows, first byte): texts, or overlapping pieces of a long one."""
    raw, off = text_bytes(column)
    for first, end in row_slices(off, RUN_BYTES):
        if end - first == 1 and off[end] - off[first] > RUN_BYTES:
            for at in range(0, int(off[end] - off[first]) - least + 1, RUN_BYTES):
                part = raw[off[first] + at:min(off[first] + at + RUN_BYTES + least - 1, off[end])]
                yield part, np.array([0, len(part)]), slice(first, end), at
        else:
            yield raw[off[first]:off[end]], off[first:end + 1] - off[first], slice(first, end), 0


def _string_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes at each place where there are k."""
    n = len(raw)
    up, down = _POWERS.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + U64(1)) * up[:n], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n - k + 1])


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost smallest of ``width`` values, for each place where there are so many."""
    least, place, have = values, np.arange(len(values), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        later = least[step:] < least[:len(least) - step]
        place = np.where(later, place[step:], place[:len(place) - step])
        least = np.where(later, least[step:], least[:len(least) - step])
        have += step
    return place


def suffixes_of(raw: np.ndarray, offsets: np.ndarray, shape: Shape):
    """(at, doc, nearest, farthest, hash) of each suffix that windows pick: they start that many bytes to its left."""
    none = np.zeros(0, np.int64)
    if len(raw) < shape.least:
        return none, none, none, none, np.zeros(0, np.uint64)
    hashes = _string_hashes(raw, shape.k)
    place = _least_places(hashes, shape.windows)
    stop = np.repeat(offsets[1:], np.diff(offsets))[:len(place)]
    start = np.flatnonzero(np.arange(len(place)) + shape.least <= stop)  # a window must not cross the end of its text
    if not len(start):
        return none, none, none, none, np.zeros(0, np.uint64)
    place = place[start].astype(np.int64)
    head = np.ones(len(start), bool)
    head[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(start)) - 1
    at = place[first]
    return at, np.searchsorted(offsets, start[first], side="right") - 1, at - start[last], at - start[first], hashes[at]


# --- step 2: hashes that several documents share ---------------------------

def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)


def _short(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Range and lower half of a hash: what travels of it."""
    return (_range_of(keys, ranges).astype(np.uint64) << U64(32)) | (keys & U64(0xFFFFFFFF))


def _runs_of(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    head = np.zeros(len(columns[0]), bool)
    head[:1] = True
    for c in columns:
        head[1:] |= c[1:] != c[:-1]
    return head


def _part_of(docs: np.ndarray, parts: int) -> np.ndarray:
    return (mix(docs.astype(np.uint64)) % U64(parts)).astype(np.int64)


def _grouped(where: np.ndarray, docs: np.ndarray, columns: dict[str, np.ndarray]):
    """(value, packed documents in order, bytes of each column) for each value of ``where``."""
    order = np.lexsort((docs, where))
    found, first = np.unique(where[order], return_index=True)
    cut = [*first.tolist(), len(order)]
    docs, columns = docs[order], {name: c[order] for name, c in columns.items()}
    for i, value in enumerate(found.tolist()):
        own = slice(cut[i], cut[i + 1])
        yield value, {"docs": _small(docs[own]), **{name: c[own].tobytes() for name, c in columns.items()}}


def _documents(table: pa.Table) -> np.ndarray:
    return np.concatenate([_large(x or b"") for x in table.column("docs").to_pylist()])


def _table(rows: list[dict], schema: str) -> pa.Table:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in fields})


def _occurrences(shape: Shape, ranges: int, parts: int):
    """Of each slice: one document of each hash to its range, with the number it stands for, and, below zero, hashes that documents here share to their parts."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for raw, off, rows, _ in _pieces(batch.column(1), shape.least):
                _, doc, _, _, keys = suffixes_of(raw, off, shape)
                if not len(keys):
                    continue
                docs, keys = ids[rows][doc], _short(keys, ranges)
                order = np.lexsort((docs, keys))
                docs, keys = docs[order], keys[order]
                new = _runs_of(docs, keys)
                docs, keys = docs[new], keys[new]
                head = np.flatnonzero(_runs_of(keys))
                many = np.diff(np.append(head, len(keys)))
                shared = np.repeat(many > 1, many)
                rows_out = [{"part": r, **x} for r, x in _grouped((keys[head] >> U64(32)).astype(np.int64), docs[head], {
                    "counts": many.astype("<u4"), "keys": (keys[head] & U64(0xFFFFFFFF)).astype("<u4")})]
                rows_out += [{"part": -1 - p, **x} for p, x in _grouped(_part_of(docs[shared], parts), docs[shared], {"keys": keys[shared]})]
                yield from _table(rows_out, _FOUND_DDL).to_batches()

    return run


def _column(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(x or b"", kind) for x in table.column(name).to_pylist()])


def _shared(parts: int):
    """Of one range: the hashes that documents of several slices have, to the documents' parts, and the hot ones, to part ``parts``."""

    def run(key, table):
        where = key[0].as_py()
        if where < 0:
            return _table([{"part": -1 - where, "docs": d, "keys": k}
                           for d, k in zip(table.column("docs").to_pylist(), table.column("keys").to_pylist())], _FOUND_DDL)
        docs, many, keys = _documents(table), _column(table, "counts", "<u4").astype(np.int64), _column(table, "keys", "<u4")
        order = np.argsort(keys, kind="stable")
        docs, many, keys = docs[order], many[order], keys[order].astype(np.uint64) | U64(where << 32)
        head = np.flatnonzero(_runs_of(keys))
        size = np.diff(np.append(head, len(keys)))
        some = np.repeat((np.maximum.reduceat(docs, head) > np.minimum.reduceat(docs, head)), size)
        rows = [{"part": p, **x} for p, x in _grouped(_part_of(docs[some], parts), docs[some], {"keys": keys[some]})]
        total = np.add.reduceat(many, head)
        hot = keys[head[(total > total.sum() // 8) & (total > 64)]]
        if len(hot):
            rows.append({"part": parts, "keys": hot.tobytes()})
        return _table(rows, _FOUND_DDL)

    return run


def _by_document(parts: int):
    """(doc_id, keys): the hashes of each document of one part that others have too; with a null id the hot ones."""

    def run(key, table):
        docs, keys = _documents(table), _column(table, "keys", "<u8")
        if key[0].as_py() == parts:
            return pa.table({"doc_id": pa.array([None], pa.int64()), "keys": pa.array([keys.tobytes()], pa.binary())})
        order = np.lexsort((keys, docs))
        docs, keys = docs[order], keys[order]
        new = _runs_of(docs, keys)
        docs, keys = docs[new], keys[new]
        own, first = np.unique(docs, return_index=True)
        return pa.table({"doc_id": pa.array(own, pa.int64()), "keys": pa.array([k.tobytes() for k in np.split(keys, first[1:])], pa.binary())})

    return run


# --- step 3: sorted, front-coded runs --------------------------------------

@dataclass
class Suffixes:
    """Rows of one run: bytes to the right and, reversed, to the left; windows start ``near`` to ``far`` bytes to the left."""

    right: np.ndarray
    left: np.ndarray
    near: np.ndarray
    far: np.ndarray
    docs: np.ndarray
    tags: np.ndarray
    at: np.ndarray

    def take(self, rows: np.ndarray) -> Suffixes:
        return Suffixes(*(getattr(self, f)[rows] for f in self.__dataclass_fields__))

    def __len__(self) -> int:
        return len(self.docs)


def _cells(raw: np.ndarray, at: np.ndarray, length: np.ndarray, width: int, step: int) -> np.ndarray:
    """A row of ``length`` bytes for each place, going ``step`` from it, then zeros."""
    cells = np.zeros((len(at), width), np.uint8)
    for i in range(width):
        some = np.flatnonzero(length > i)
        cells[some, i] = raw[at[some] + step * i]
    return cells


def _big(cells: np.ndarray) -> np.ndarray:
    """The rows' bytes as columns of big-endian words: same order, fewer comparisons."""
    return np.ascontiguousarray(cells).view(">u8").astype(np.uint64).T


def _prefix(cells: np.ndarray, shape: Shape) -> np.ndarray:
    """The first bytes that all equal windows share, as a number that sorts like them."""
    cells = cells[:, :8].copy()
    cells[:, shape.k:] = 0
    return _big(cells)[0]


def _suffixes(raw, off, ids, tags, base, keep, shape: Shape, found, one_by_one: bool) -> Suffixes:
    at, doc, near, far, _ = (x[keep] for x in found)
    if one_by_one:  # a row for each window, with nothing to its left
        many = far - near + 1
        row = np.repeat(np.arange(len(at)), many)
        at = at[row] - near[row] - (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
        doc, near, far = doc[row], np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
    return Suffixes(_cells(raw, at, shape.least - near, shape.right, 1), _cells(raw, at - 1, far, shape.left, -1),
                    near, far, ids[doc], tags[doc], at - off[doc] + base)


def _common(cells: np.ndarray) -> np.ndarray:
    """The number of leading bytes that each row shares with the one before (0 for the first)."""
    shared = np.zeros(len(cells), np.int64)
    if len(cells) > 1:
        differ = cells[1:] != cells[:-1]
        shared[1:] = np.where(differ.any(1), differ.argmax(1), cells.shape[1])
    return shared


def _sorted_run(run: Suffixes, where: np.ndarray):
    """(run, ranges, whole duplicates): rows by range and bytes; of equal ones the smallest document's stay."""
    order = np.lexsort((run.docs, run.far, run.near, *_big(run.left)[::-1], *_big(run.right)[::-1], where))
    run, where = run.take(order), where[order]
    new = _runs_of(where, run.near, run.far, *_big(run.right), *_big(run.left))
    least = run.docs[new][np.cumsum(new) - 1]
    later = run.docs > least
    kept = np.flatnonzero(~later)
    return run.take(kept), where[kept], run.take(np.flatnonzero(later))


def _front_coded(run: Suffixes, where: np.ndarray):
    """A row for each range: shared prefix lengths, the bytes after them, and what belongs to each suffix."""
    found, first = np.unique(where, return_index=True)
    cut = [*first.tolist(), len(where)]
    for i, value in enumerate(found.tolist()):
        part = run.take(slice(cut[i], cut[i + 1]))
        shared = _common(part.right)
        column = np.arange(part.right.shape[1])
        length = part.right.shape[1] - (part.right[:, ::-1] != 0).argmax(1)
        length[~part.right.any(1)] = 0
        tail = (column >= shared[:, None]) & (column < length[:, None])
        yield {"range": value, "shared": shared.astype(np.uint8).tobytes(), "right": length.astype(np.uint8).tobytes(),
               "reach": part.near.astype(np.uint8).tobytes(), "left": part.far.astype(np.uint8).tobytes(), "tails": part.right[tail].tobytes(),
               "lefts": part.left[np.arange(part.left.shape[1]) < part.far[:, None]].tobytes(),
               "docs": part.docs.astype("<i8").tobytes(), "tags": part.tags.astype("<u4").tobytes(), "at": part.at.astype("<i8").tobytes()}


def _decoded(row: dict, shape: Shape) -> tuple[Suffixes, np.ndarray]:
    """A piece of a run, and the prefix lengths that its neighbours share."""
    shared, length, near, far = (np.frombuffer(row[c], np.uint8).astype(np.int64) for c in ("shared", "right", "reach", "left"))
    n, column = len(shared), np.arange(shape.right)
    tail = (column >= shared[:, None]) & (column < length[:, None])
    cells = np.zeros((n, shape.right), np.uint8)
    cells[tail] = np.frombuffer(row["tails"], np.uint8)
    # A byte within the shared prefix is that of the last row which brought its own.
    source = np.maximum.accumulate(np.where(column >= shared[:, None], np.arange(n)[:, None], 0), axis=0)
    left = np.zeros((n, shape.left), np.uint8)
    left[np.arange(shape.left) < far[:, None]] = np.frombuffer(row["lefts"], np.uint8)
    return Suffixes(cells[source, column], left, near, far, np.frombuffer(row["docs"], "<i8"),
                    np.frombuffer(row["tags"], "<u4"), np.frombuffer(row["at"], "<i8")), shared


def _spans(starts: np.ndarray, docs: np.ndarray, tags: np.ndarray, least: int, parts: int) -> list[dict]:
    """Byte spans of the windows that start at ``starts``, merged, a row for each part of the documents."""
    if not len(starts):
        return []
    order = np.lexsort((starts, tags, docs))
    starts, docs, tags = starts[order], docs[order], tags[order]
    head = _runs_of(docs, tags)
    head[1:] |= starts[1:] > starts[:-1] + least
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(starts)) - 1
    columns = {"tags": tags[first].astype("<u4"), "first": starts[first].astype("<i8"), "stop": (starts[last] + least).astype("<i8")}
    return [{"part": p, **x} for p, x in _grouped(_part_of(docs[first], parts), docs[first], columns)]


def _runs(shape: Shape, ranges: int, parts: int, splitters: np.ndarray, hot: np.ndarray):
    """Pieces of sorted runs of the rows (doc_id, tag, text, keys); below zero, spans that are repeats within the slice."""

    def run(batches):
        for batch in batches:
            ids, tags = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            own = [np.frombuffer(k, np.uint64) for k in batch.column(3).to_pylist()]
            for raw, off, rows, base in _pieces(batch.column(2), shape.least):
                found = suffixes_of(raw, off, shape)
                doc, short = found[1], _short(found[4], ranges)
                cut = np.searchsorted(doc, np.arange(rows.stop - rows.start + 1))
                keep = np.zeros(len(doc), bool)
                for i, keys in enumerate(own[rows]):
                    keep[cut[i]:cut[i + 1]] = np.isin(short[cut[i]:cut[i + 1]], keys)
                common = np.isin(short, hot)
                rows_out: list[dict] = []
                for one_by_one in (False, True):
                    some = _suffixes(raw, off, ids[rows], tags[rows], base, keep & (common if one_by_one else ~common), shape, found, one_by_one)
                    if not len(some):
                        continue
                    if one_by_one:
                        total = np.zeros(len(some), np.uint64)
                        for word in _big(some.right):
                            total = mix(total ^ word)
                        where = ranges + (total % U64(ranges)).astype(np.int64)
                    else:
                        where = np.searchsorted(splitters, _prefix(some.right, shape), side="right")
                    kept, where, later = _sorted_run(some, where)
                    rows_out += _front_coded(kept, where)
                    many = later.far - later.near + 1
                    row = np.repeat(np.arange(len(later)), many)
                    start = later.at[row] - later.near[row] - (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
                    rows_out += [{"range": -1 - x["part"], "docs": x["docs"], "tags": x["tags"], "at": x["first"], "tails": x["stop"]}
                                 for x in _spans(start, later.docs[row], later.tags[row], shape.least, parts)]
                yield from _table(rows_out, _RUNS_DDL).to_batches()

    return run


# --- step 4: the merge -----------------------------------------------------

def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Loser tree over sorted runs of (strings of one length, prefix each shares with the one before).

    Returns the strings' numbers (counted through all runs) in sorted order and
    the prefix that each shares with the one before it there.  A run's next
    string shares a known prefix with the last output if it comes from the
    same run, and every loser on its path one with that output, so lengths
    decide; where they are equal, comparing starts after them.
    """
    width = 1
    while width < len(runs):
        width *= 2
    strings = [s for r, _ in runs for s in r]
    prefix = [p for _, r in runs for p in r]
    place, stop, at = [0] * width, [0] * width, 0
    for i, (r, _) in enumerate(runs):
        place[i], at = at, at + len(r)
        stop[i] = at
    known = [0 if place[i] < stop[i] else -1 for i in range(width)]  # prefix shared with the last output; -1: run at its end
    loser = [0] * width

    def beats(a: int, b: int) -> bool:
        """Whether run a's string wins; the loser's known prefix is then the one it shares with the winner."""
        if known[a] != known[b]:
            return known[a] > known[b]
        h = known[a]
        if h < 0:
            return True
        x, y = strings[place[a]][h:], strings[place[b]][h:]
        if x == y:
            known[b] = h + len(x)
            return True
        differ = int.from_bytes(x) ^ int.from_bytes(y)
        shared = h + len(x) - 1 - ((differ.bit_length() - 1) >> 3)
        if x < y:
            known[b] = shared
            return True
        known[a] = shared
        return False

    top = [0] * width + list(range(width))
    for node in range(width - 1, 0, -1):
        a, b = top[2 * node], top[2 * node + 1]
        top[node], loser[node] = (a, b) if beats(a, b) else (b, a)
    winner = top[1] if width > 1 else 0
    out, shared = [], []
    while known[winner] >= 0:
        i = place[winner]
        out.append(i)
        shared.append(known[winner])
        i += 1
        place[winner] = i
        have = known[winner] = prefix[i] if i < stop[winner] else -1
        node = (width + winner) >> 1
        while node:
            other = loser[node]
            if have <= known[other] and (have < known[other] or not beats(winner, other)):
                loser[node], winner = winner, other
                have = known[other]
            node >>= 1
    return out, shared


# --- step 5: repeats -------------------------------------------------------

def repeated_windows(run: Suffixes, shared: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(row, distance to the left) of each window that a smaller document has too; rows sorted, with their common prefixes."""
    chain = shared >= shape.k  # goes on with the k bytes of the row before
    chain[:1] = False
    group = np.cumsum(~chain) - 1
    least, most = (np.full(int(group[-1]) + 1 if len(group) else 0, v, np.int64) for v in (np.iinfo(np.int64).max, np.iinfo(np.int64).min))
    np.minimum.at(least, group, run.docs)
    np.maximum.at(most, group, run.docs)
    some = np.flatnonzero((least < most)[group])
    rows, run, shared = some, run.take(some), shared[some]
    none = np.zeros(0, np.int64)
    if not len(rows):
        return none, none
    words = _big(run.left)
    by_left = np.lexsort(words[::-1])
    left_shared = _common(run.left[by_left])
    rank = np.empty(len(rows), np.int64)
    found_rows, found_far = [], []
    for j in range(int(run.far.max()) + 1):
        own = np.flatnonzero((run.near <= j) & (j <= run.far))
        if len(own) < 2:
            continue
        rank[by_left] = np.cumsum(left_shared < j)
        same = np.cumsum(shared < shape.least - j)[own] * (len(rows) + 1) + rank[own]
        order = np.lexsort((run.docs[own], same))
        head = _runs_of(same[order])
        docs = run.docs[own[order]]
        later = docs > docs[head][np.cumsum(head) - 1]
        found_rows.append(rows[own[order[later]]])
        found_far.append(np.full(len(found_rows[-1]), j, np.int64))
    return (np.concatenate(found_rows), np.concatenate(found_far)) if found_rows else (none, none)


def _merged(shape: Shape, parts: int):
    """Of one range: the byte spans that a smaller document has too, for each part of the documents."""

    def run(key, table):
        if key[0].as_py() < 0:
            return _table([{"part": -1 - key[0].as_py(), "docs": r["docs"], "tags": r["tags"], "first": r["at"], "stop": r["tails"]}
                           for r in table.to_pylist()], _SPANS_DDL)
        pieces = [_decoded(r, shape) for r in table.to_pylist()]
        strings, width = [], shape.right
        for piece, shared in pieces:
            data = piece.right.tobytes()
            strings.append(([data[i:i + width] for i in range(0, len(data), width)], shared.tolist()))
        order, shared = merge(strings)
        every = Suffixes(*(np.concatenate([getattr(p, f) for p, _ in pieces]) for f in Suffixes.__dataclass_fields__))
        every = every.take(np.array(order, np.int64))
        row, far = repeated_windows(every, np.array(shared, np.int64), shape)
        return _table(_spans(every.at[row] - far, every.docs[row], every.tags[row], shape.least, parts), _SPANS_DDL)

    return run


def _united(key, table):
    """(doc_id, tag, spans): the maximal spans of each document of one part, first and stop bytes alternating."""
    docs, tags, first, stop = _documents(table), *(_column(table, c, k) for c, k in (("tags", "<u4"), ("first", "<i8"), ("stop", "<i8")))
    order = np.lexsort((first, tags, docs))
    docs, tags, first, stop = docs[order], tags[order], first[order], stop[order]
    text = np.cumsum(_runs_of(docs, tags)) - 1
    # The farthest stop so far within each text: texts are lifted above one another.
    lift = text * (int(stop.max(initial=0)) + 1)
    reached = np.maximum.accumulate(stop + lift) - lift
    head = _runs_of(text)
    head[1:] |= first[1:] > reached[:-1]
    begin = np.flatnonzero(head)
    end = np.append(begin[1:], len(first)) - 1
    spans = np.stack([first[begin], reached[end]], 1).astype("<i8")
    own, at = np.unique(text[begin], return_index=True)
    return pa.table({"doc_id": pa.array(docs[begin[at]], pa.int64()), "tag": pa.array(tags[begin[at]].astype(np.int64), pa.int64()),
                     "spans": pa.array([s.tobytes() for s in np.split(spans, at[1:])], pa.binary())})


def _prefixes(shape: Shape):
    """(prefix): the first bytes of each suffix as a number that sorts like them."""

    def run(batches):
        for batch in batches:
            for raw, off, _, _ in _pieces(batch.column(0), shape.least):
                at, _, near, _, _ = suffixes_of(raw, off, shape)
                word = _prefix(_cells(raw, at, np.minimum(shape.least - near, 8), 8, 1), shape)
                yield pa.RecordBatch.from_arrays([pa.array((word ^ U64(1 << 63)).view(np.int64))], names=["prefix"])

    return run


def repeat_spans(docs: DataFrame, scratch: Scratch, key: str, text: str, least: int = LEAST) -> DataFrame:
    """(doc_id, tag, spans) of the documents with repeats; ``tag`` tells texts of one id apart."""
    spark, shape = docs.sparkSession, Shape(least)
    if least > 248:
        raise ValueError("repeats of at most 248 bytes: lengths travel as single bytes")
    ranges, parts = 2 * partitions(spark), max(1, partitions(spark) // 2)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= least))
    rows = rows.select("doc_id", _tag("text").alias("tag"), "text")
    counted = rows.select("doc_id", "text").mapInArrow(_occurrences(shape, ranges, parts), _FOUND_DDL)
    hits = counted.groupBy("part").applyInArrow(_shared(parts), _FOUND_DDL)
    hits = scratch.put(hits.groupBy("part").applyInArrow(_by_document(parts), "doc_id long, keys binary"), "shared")
    scratch.settle()
    hot = [np.frombuffer(r.keys, np.uint64) for r in hits.where("doc_id IS NULL").select("keys").collect()]  # eight hashes a range at most
    sample = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(_SAMPLED)) == 0).select("text").mapInArrow(_prefixes(shape), "prefix long")
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sample.agg(F.percentile_approx("prefix", shares, 20 * ranges)).first()[0] or []  # a number a range
    splitters = np.unique(np.array(cuts, np.int64)).view(np.uint64) ^ U64(1 << 63)
    near = rows.join(hits, "doc_id").select("doc_id", "tag", "text", "keys")
    runs = near.mapInArrow(_runs(shape, ranges, parts, splitters, np.concatenate([np.zeros(0, np.uint64), *hot])), _RUNS_DDL)
    spans = runs.groupBy("range").applyInArrow(_merged(shape, parts), _SPANS_DDL)
    found = scratch.put(spans.groupBy("part").applyInArrow(_united, "doc_id long, tag long, spans binary"), "spans")
    scratch.drop("shared")
    return found


def _tag(text: str):
    return F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))


def _with_spans(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """The rows and columns of ``docs`` and, last, the spans of their repeats (null: none)."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    found = repeat_spans(docs, scratch, key, text, least)
    scratch.settle()  # here, as nothing refers to the texts' shuffle and the runs any more
    found = found.select(F.col("doc_id").alias("__id_of_spans"), F.col("tag").alias("__tag_of_spans"), F.col("spans").alias("__spans_of_doc"))
    same = (docs[key].cast("long") == F.col("__id_of_spans")) & (_tag(docs[text]) == F.col("__tag_of_spans"))
    return docs.join(found, same, "left").select(*[docs[c] for c in docs.columns], "__spans_of_doc")


def _kept(column: pa.Array, spans: pa.Array):
    """(bytes, spans, kept slices) of each text."""
    raw, off = text_bytes(column)
    raw = memoryview(np.ascontiguousarray(raw))
    for i, packed in enumerate(spans.to_pylist()):
        own = raw[off[i]:off[i + 1]]
        cut = np.frombuffer(packed or b"", "<i8").reshape(-1, 2)
        edges = [0, *cut.ravel().tolist(), len(own)]
        yield own, cut, [own[a:b] for a, b in zip(edges[::2], edges[1::2])]


def _digests(batches):
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of rows (key, text, spans)."""
    for batch in batches:
        size, gone, many, sha = [], [], [], []
        for own, cut, kept in _kept(batch.column(1), batch.column(2)):
            digest = hashlib.sha256()
            for part in kept:
                digest.update(part)
            size.append(len(own))
            gone.append(int((cut[:, 1] - cut[:, 0]).sum()))
            many.append(len(cut))
            sha.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (size, gone, many)), pa.array(sha, pa.string())],
                                         names=[batch.schema.names[0], "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cutting(place: int):
    def run(batches):
        for batch in batches:
            kept = [b"".join(k) for _, _, k in _kept(batch.column(place), batch.column(batch.num_columns - 1))]
            there = batch.column(place).is_valid().to_pylist()
            changed = pa.array([k if known else None for known, k in zip(there, kept)], pa.binary())
            yield pa.RecordBatch.from_arrays([changed if i == place else batch.column(i) for i in range(batch.num_columns - 1)],
                                             names=batch.schema.names[:-1])

    return run


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with the repeated bytes cut from the text, which becomes binary: a cut may part a character."""
    rows = _with_spans(docs, key, text, least)
    kinds = ", ".join(f"`{f.name}` {'binary' if f.name == text else f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(_cutting(docs.columns.index(text)), kinds)


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(key, first_byte, n_bytes): the maximal runs of repeated bytes; a row without an id has none."""
    rows = _with_spans(docs.select(F.col(key).cast("long").alias(key), text), key, text, least).where("__spans_of_doc IS NOT NULL")

    def run(batches):
        for batch in batches:
            spans = [np.frombuffer(s, "<i8").reshape(-1, 2) for s in batch.column(1).to_pylist()]
            each = np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)
            row = np.repeat(np.arange(len(spans)), [len(s) for s in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(each[:, 0]), pa.array(each[:, 1] - each[:, 0])],
                                             names=[batch.schema.names[0], "first_byte", "n_bytes"])

    return rows.select(key, "__spans_of_doc").mapInArrow(run, f"`{key}` long, first_byte long, n_bytes long")


def suffix_digest(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256), a row for each input row."""
    rows = _with_spans(docs.select(F.col(key).cast("long").alias(key), text), key, text, least)
    return rows.mapInArrow(_digests, f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
