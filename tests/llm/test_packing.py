import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from lodestar.llm import packing
from tokenizers import Tokenizer

from .common import awkward, frame, prose

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_plan(counts, length):
    runs = packing.best_fit(counts, length)
    room = Counter()
    seen = Counter()
    for size, rank, many, first, offset in runs:
        assert rank == seen[size]
        seen[size] += many
        for s in range(first, first + many):
            assert room[s] == offset  # gapless
            room[s] += size
    assert seen == Counter({k: v for k, v in counts.items() if v}) and max(room.values(), default=0) <= length
    return len(room)


def test_plan_is_whole_gapless_and_near_the_bound():
    rng = random.Random(2)
    assert packing.best_fit({}, 10) == []
    for length in (1, 7, 64, 4096):
        counts = Counter(rng.randint(1, length) for _ in range(3000))
        used = check_plan(counts, length)
        least = -(-sum(k * v for k, v in counts.items()) // length)
        assert used <= 1.05 * least + 2
    assert check_plan({3: 10**6, 7: 10**6}, 10) == 10**6  # counts, not pieces
    assert len(packing.best_fit({3: 10**9, 7: 10**9}, 10)) == 2


def brute(text):
    t = Tokenizer.from_file(PATH)
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces_equal_the_tokenizer_and_fill_sequences(spark):
    rows = awkward() + [(20, "It's 2024; naïve Σας x <|endoftext|>é́ DON'T"), (21, prose(3, 3000))]
    for length in (4096, 50):
        got = packing.pack(frame(spark, rows), PATH, length=length, with_ids=True).collect()
        want = Counter()
        for i, t in rows:
            ids = brute(t)
            for n, at in enumerate(range(0, len(ids), length)):
                part = np.array(ids[at:at + length], "<u4").tobytes()
                want[i, n, at, len(part) // 4, zlib.crc32(part), part] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
        full = {}
        for r in got:
            full.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in full.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= length


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), PATH).count() == 0
