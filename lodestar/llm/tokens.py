"""Token ids of whole texts, with each distinct unit tokenised once a worker.

For a tokenizer whose pieces never span white space (it lower-cases, splits
letters from other characters and drops the space), the ids of a text are those
of its units in a row.  A unit is a word, cut further where a letter and an
ASCII character that is none meet; only an apostrophe stays with the letters
behind it ('s and 't are pieces).  Texts are full of repeated units, so a worker
keeps the ids of the units it has met lately.

All steps on known units are array operations over the bytes of many texts.  A
unit of up to 16 bytes is its own key, as two integers, in a table with open
addressing; longer ones are kept in a dictionary.

Lower-casing a text of Latin-1 characters, which such a tokenizer does anyway,
makes more units equal.  A text with ``<|`` is neither lower-cased nor cut below
words, as its words might hold special tokens or become some.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from .words import _LOWER, U64, mix, solid_bytes

_LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
#: Slots of a worker's table and the units it remembers, about 100 MB.
SLOTS, REMEMBERED = 1 << 21, 1_300_000
#: Bytes of long units that a worker remembers.
LONG_BYTES = 16 << 20
#: Units that are looked up at a time.
_UNITS = 1 << 17
#: New units that go through the tokenizer at a time.
_BATCH = 500
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _byte_letters() -> dict[int, str]:
    """Byte -> the printable character that byte-level vocabularies write for it."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_BYTE_LETTERS = _byte_letters()


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which texts hold a flagged byte."""
    at = np.flatnonzero(flags)
    return np.searchsorted(at, off[1:]) > np.searchsorted(at, off[:-1])


def _units(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, lower-cased where that is safe; start and end of each unit)."""
    n, sizes = len(raw), np.diff(off)
    before = np.zeros(n, np.uint8)
    before[1:] = raw[:-1]
    first = np.zeros(n, bool)
    first[off[:-1][sizes > 0]] = True
    special = _per_text((raw == ord("|")) & (before == ord("<")) & ~first, off)
    plain = ~(special | _per_text(raw >= 0xC4, off))  # UTF-8 of Latin-1 starts with 0xC2 or 0xC3
    lower = _LOWER[raw]
    inner = (before == 0xC3) & (raw != 0x97) & (raw != 0xB7)  # À to ÿ, but for the signs × and ÷
    lower[inner & (raw < 0x9F) & (raw >= 0x80)] += 0x20
    if not plain.all():
        lower = np.where(np.repeat(plain, sizes), lower, raw)
    letter = _ASCII_LETTER[raw] | inner
    lead = inner[1:] & (raw[:-1] == 0xC3)
    letter[:-1] |= lead
    solid = solid_bytes(raw)
    other = solid & ~letter & (raw < 0x80)
    cut = np.zeros(n, bool)
    cut[1:] = (letter[:-1] & other[1:]) | (other[:-1] & letter[1:] & (raw[:-1] != ord("'")))
    if special.any():
        cut &= ~np.repeat(special, sizes)
    left = np.zeros(n, bool)
    left[1:] = solid[:-1]
    begin = solid & (~left | first | cut)
    start = np.flatnonzero(begin)
    # A unit ends where the next begins or at white space.
    stop = np.ones(n, bool)
    stop[:-1] = ~solid[1:] | begin[1:]
    return lower, start, np.flatnonzero(solid & stop) + 1


class WordTokenizer:
    """Ids of texts, as unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        probes = ["the", "thblein", "é", "straße", "ñandú", "x", "zzzzzzzzzz", "çãõ"]
        # A run of plain letters needs no normalising or splitting: the model alone gives its ids, if these agree.
        self.direct = self._direct(probes) == self._general(probes)
        self._forget()

    def _forget(self) -> None:
        self.low, self.high = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.uint64)
        self.number = np.zeros(SLOTS, np.int32)
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.count, self.used = 0, 0
        self.first, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.known = np.zeros(1 << 18, np.uint32)

    def _general(self, words: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _direct(self, words: list[str]) -> list[bytes]:
        tokenize = self.model.tokenize
        letters = [w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_LETTERS) for w in words]
        return [array("I", [t.id for t in tokenize(w)]).tobytes() for w in letters]

    def _learn(self, words: list[bytes]) -> None:
        """Append the ids of new units, in the order of their numbers."""
        texts = [w.decode() for w in words]
        plain = [self.direct and _LETTERS.fullmatch(t) is not None for t in texts]
        rest = [t for t, p in zip(texts, plain) if not p]
        one = iter(self._direct([t for t, p in zip(texts, plain) if p]))
        two = (ids for at in range(0, len(rest), _BATCH) for ids in self._general(rest[at:at + _BATCH]))
        found = [next(one) if p else next(two) for p in plain]
        size = np.array([len(ids) // 4 for ids in found], np.int64)
        n, total = len(found), int(size.sum())
        while self.count + n > len(self.first):
            self.first, self.size = np.resize(self.first, 2 * len(self.first)), np.resize(self.size, 2 * len(self.size))
        while self.used + total > len(self.known):
            self.known = np.resize(self.known, 2 * len(self.known))
        self.first[self.count:self.count + n] = self.used + np.cumsum(size) - size
        self.size[self.count:self.count + n] = size
        self.known[self.used:self.used + total] = np.frombuffer(b"".join(found), np.uint32)
        self.count, self.used = self.count + n, self.used + total

    def _short(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each key, and the rows of the first of each new one in the order of their numbers."""
        out, new, count = np.empty(len(low), np.int64), [], self.count
        row = np.arange(len(low))
        at = (mix(low ^ mix(high)) & U64(SLOTS - 1)).astype(np.int64)
        while len(row):
            free = self.low[at] == 0  # no unit has a first byte 0
            if free.any():
                slot, own = at[free], row[free]
                self.number[slot] = own
                mine = self.number[slot] == own  # one row a slot
                slot, own = slot[mine], own[mine]
                self.low[slot], self.high[slot] = low[own], high[own]
                self.number[slot] = np.arange(count, count + len(own))
                count += len(own)
                new.append(own)
            same = (self.low[at] == low[row]) & (self.high[at] == high[row])
            out[row[same]] = self.number[at[same]]
            row, at = row[~same], (at[~same] + 1) & (SLOTS - 1)
        return out, np.concatenate(new) if new else np.zeros(0, np.int64)

    def _numbers(self, raw: np.ndarray, data: memoryview, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The numbers of units, new ones learnt; ``raw`` has 16 bytes more than the texts."""
        size = end - start
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        low = eight[start] & _MASKS[np.minimum(size, 8)]
        high = eight[start + 8] & _MASKS[np.clip(size - 8, 0, 8)]
        # A zero byte could not be told from the padding.
        long = size > 16
        zeros = np.flatnonzero(raw[start[0]:end[-1]] == 0) + start[0] if len(start) else []
        if len(zeros):
            long |= np.searchsorted(zeros, end) > np.searchsorted(zeros, start)
        short = np.flatnonzero(~long)
        out = np.empty(len(start), np.int64)
        out[short], new = self._short(low[short], high[short])
        new = short[new]
        self._learn([bytes(data[s:e]) for s, e in zip(start[new].tolist(), end[new].tolist())])
        at = np.flatnonzero(long)
        if len(at):
            words = [bytes(data[s:e]) for s, e in zip(start[at].tolist(), end[at].tolist())]
            fresh = [w for w in dict.fromkeys(words) if w not in self.long]
            self.long.update(zip(fresh, range(self.count, self.count + len(fresh))))
            self.long_bytes += sum(map(len, fresh))
            self._learn(fresh)
            out[at] = [self.long[w] for w in words]
        return out

    def ids(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts with bytes ``raw[off[i]:off[i + 1]]``, one after the other, and the bounds of each text's ids."""
        lower, start, end = _units(raw, off)
        padded = np.zeros(len(raw) + 16, np.uint8)
        padded[:len(raw)] = lower
        data = memoryview(padded)
        parts, sizes = [], np.zeros(len(start) + 1, np.int64)
        for at in range(0, len(start), _UNITS):
            stop = min(at + _UNITS, len(start))
            if self.count + stop - at > REMEMBERED or self.long_bytes > LONG_BYTES:
                self._forget()
            number = self._numbers(padded, data, start[at:stop], end[at:stop])
            size = self.size[number]
            where = np.repeat(self.first[number] - np.cumsum(size, dtype=np.int64) + size, size)
            parts.append(self.known[where + np.arange(len(where))])
            sizes[at + 1:stop + 1] = size
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return ids, np.cumsum(sizes)[np.searchsorted(start, off)]


_made: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for ``path``; it stays for later tasks."""
    if path not in _made:
        _made[path] = WordTokenizer(path)
    return _made[path]
