"""Benchmark decontamination by greedy string tiling.

Texts are compared as words without case and punctuation.  A document and a
benchmark item that share a seed (``SEED`` words in a row) are tiled: the
longest common runs of unmarked words are found by running Karp-Rabin hashes,
marked, and the search goes on with shorter runs down to ``SEED`` words.  Tiles
do not overlap and may come in any order, so a passage whose parts are moved
about is still covered.  An item is leaked by a document whose tiles cover at
least ``COVER`` of its words.  Items with fewer words than a seed cannot be
told from chance and are leaked by nothing.

The benchmark is the stated query set: its items are read in blocks of at
most ``BLOCK_WORDS`` words, each block goes to the tasks once, and every
document is held against it.  Nothing is shuffled.  In a long document only
the words around seeds are tiled.

Results for edge cases: null or empty texts hold nothing and null or empty
items are leaked by nothing; an item text that repeats is reported under each
of its ids; null ids are reported as null; repeated rows are each judged; an
empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import row_slices, ship_code, text_bytes
from .words import words_of

SEED = 5
COVER = 0.5
#: Words of one block of items; bounds what a task holds of the benchmark.
BLOCK_WORDS = 2_000_000
_MODULUS = (1 << 61) - 1
_BASE = 1_000_003

# Bytes of words: ASCII letters (lower-cased) and digits, and all of non-ASCII characters.
_PLAIN = np.full(256, 0x20, np.uint8)
for _c in [*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]:
    _PLAIN[_c] = _c
for _c in range(ord("A"), ord("Z") + 1):
    _PLAIN[_c] = _c + 32


def _plain_words(raw: np.ndarray, offsets: np.ndarray):
    return words_of(_PLAIN[raw], offsets)


def _runs(a: list, b: list, free_a: list[bool], free_b: list[bool], size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of free words of at least ``size``, found through windows of ``size``."""

    def rolled(x: list, free: list[bool]):
        """(start, hash) of each window of free words."""
        top = pow(_BASE, size - 1, _MODULUS)
        value = held = 0
        for i, word in enumerate(x):
            if not free[i]:
                value = held = 0
                continue
            if held == size:
                value -= x[i - size] * top
                held -= 1
            value = (value * _BASE + word) % _MODULUS
            held += 1
            if held == size:
                yield i - size + 1, value

    where = defaultdict(list)
    for start, value in rolled(b, free_b):
        where[value].append(start)
    found, seen = [], set()
    for i, value in rolled(a, free_a):
        for j in where.get(value, ()):
            if (i, j) in seen or a[i:i + size] != b[j:j + size]:
                continue
            n = size
            while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                n += 1
            seen.update((i + k, j + k) for k in range(n - size + 1))
            found.append((n, i, j))
    return found


def tile(text: list, item: list, least: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles (words, start in text, start in item), the longest first; ties by earliest place."""
    free_a, free_b = [True] * len(text), [True] * len(item)
    tiles = []
    size = max((n for n, _, _ in _runs(text, item, free_a, free_b, least)), default=0)
    while size >= least:
        for n, i, j in sorted(_runs(text, item, free_a, free_b, size), key=lambda r: (-r[0], r[1], r[2])):
            if n == size and all(free_a[i:i + n]) and all(free_b[j:j + n]):
                free_a[i:i + n] = free_b[j:j + n] = [False] * n
                tiles.append((n, i, j))
        size = max((n for n, _, _ in _runs(text, item, free_a, free_b, least)), default=0)
    return tiles


class _Items:
    """One block of benchmark items and the seeds that lead to them."""

    def __init__(self, ids: list, texts: list[str], least: int):
        raw, off = text_bytes(pa.array(texts, pa.string()))
        words = _plain_words(raw, off)
        h = words.hashes()
        self.ids, self.least = ids, least
        self.words = [h[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        keys, at = words.windows(h, least, seed=71)
        order = np.argsort(keys, kind="stable")
        self.seeds, self.seed_item = keys[order], words.doc()[at][order]

    def leaks(self, words):
        """(text, item, covered words, tiles) of all texts and items that share a seed."""
        h = words.hashes()
        own, at = words.windows(h, self.least, seed=71)
        if not len(own) or not len(self.seeds):
            return
        lo = np.searchsorted(self.seeds, own)
        hit = np.flatnonzero(self.seeds[np.minimum(lo, len(self.seeds) - 1)] == own)
        hi = np.searchsorted(self.seeds, own[hit], side="right")
        doc = words.doc()[at[hit]]
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        for k, d, first, end in zip(at[hit].tolist(), doc.tolist(), lo[hit].tolist(), hi.tolist()):
            for item in set(self.seed_item[first:end].tolist()):
                places[d, item].append(k)
        for (d, item), found in sorted(places.items()):
            target = self.words[item]
            text = _neighbourhood(h, found, len(target), int(words.first[d]), int(words.first[d + 1]))
            tiles = tile(text, target.tolist(), self.least)
            yield d, item, sum(n for n, _, _ in tiles), len(tiles)


def _slices(column: pa.Array):
    raw, off = text_bytes(column)
    for first, end in row_slices(off):
        yield first, _plain_words(raw[off[first]:off[end]], off[first:end + 1] - off[first])


def _judged(items: _Items):
    """(key, item_id, item_words, covered, n_tiles) of rows (key, text)."""

    def run(batches):
        for batch in batches:
            rows, out = [], []
            for first, words in _slices(batch.column(1)):
                for d, item, covered, tiles in items.leaks(words):
                    rows.append(first + d)
                    out.append((items.ids[item], len(items.words[item]), covered, tiles))
            cut = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(x, k) for x, k in zip(cut, kinds)]],
                names=[batch.schema.names[0], "item_id", "item_words", "covered", "n_tiles"])

    return run


def _clean(items: _Items, place: int, cover: float):
    """The rows whose text, in column ``place``, leaks no item."""

    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for first, words in _slices(batch.column(place)):
                for d, item, covered, _ in items.leaks(words):
                    if covered >= cover * len(items.words[item]):
                        keep[first + d] = False
            yield batch.filter(pa.array(keep))

    return run


def _neighbourhood(h: np.ndarray, places: list[int], reach: int, first: int, end: int) -> list:
    """The words within ``reach`` of the places, parts set apart by a word that is in no item."""
    out, stop = [], first
    for at in places:
        lo, hi = max(at - reach, stop), min(at + reach, end)
        if hi <= stop:
            continue
        if out and lo > stop:
            out.append(-1)
        out += h[lo:hi].tolist()
        stop = hi
    return out


def _blocks(benchmark: DataFrame, item_key: str, item_text: str, limit: int):
    """Lists of (id, text), read one block after the other."""
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_key).cast("long").alias("item"), F.col(item_text).alias("text"))
    ids, texts, held = [], [], 0
    for row in items.toLocalIterator():
        n = len(row.text) // 2 + 1  # words at most
        if held and held + n > limit:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(row.item)
        texts.append(row.text)
        held += n
    if ids:
        yield ids, texts


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text", least: int = SEED, cover: float = COVER, limit: int = BLOCK_WORDS) -> DataFrame:
    """(key, item_id, item_words, covered, n_tiles, coverage), a row for each document and item that it leaks."""
    ship_code(docs.sparkSession)
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, item_id long, item_words long, covered long, n_tiles int"
    rows = docs.select(key, text)
    found = docs.sparkSession.createDataFrame([], schema)
    for ids, texts in _blocks(benchmark, item_key, item_text, limit):
        found = found.unionAll(rows.mapInArrow(_judged(_Items(ids, texts, least)), schema))
    return found.where(F.col("covered") >= cover * F.col("item_words")).withColumn("coverage", F.col("covered") / F.col("item_words"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
               least: int = SEED, cover: float = COVER, limit: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that leak an item."""
    ship_code(docs.sparkSession)
    for ids, texts in _blocks(benchmark, item_key, item_text, limit):
        docs = docs.mapInArrow(_clean(_Items(ids, texts, least), docs.columns.index(text), cover), docs.schema)
    return docs
