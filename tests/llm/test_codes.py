import hashlib
import math
import random

import numpy as np
import pytest

from lodestar.llm import codes

VECTORS = "vec_id long, embedding array<float>, label int, k string, v string, code string, l string, `a b` string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", "v", "c", "l", "x") for i, v, label in rows], VECTORS)


def vectors(seed, n, size=32):
    rng = random.Random(seed)
    return [(i, [rng.gauss(i % 3, 0.5) for _ in range(size)], i % 4 if i % 5 else None) for i in range(n)]


def awkward():
    rows = vectors(1, 90)
    rows += [(200, None, 1), (201, [], 1), (202, [1.0] * 31 + [float("nan")], 1), (203, [1.0] * 31 + [float("inf")], 2),
             (204, [None] + [1.0] * 31, 2), (205, [1.0] * 16, 3), (None, [0.25] * 32, None), (206, [1e30] + [-1e30] * 31, 9)]
    return rows + [rows[7], rows[7], (300, rows[8][1], rows[8][2])]


def brute(rows, parts=16, entries=64, rounds=2):
    good = [(i, [int(max(-2**24, min(2**24, math.floor(256 * float(np.float32(x)))))) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    width = len(good[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(r[1], p) for r in good[:entries]] for p in range(parts)]
    near = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in good:
                held.setdefault(near(p, cut(v, p))[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(held[k]) for c in zip(*held[k])] if k in held else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for i, v, label in good:
        found = [near(p, cut(v, p)) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    totals = {}
    for r in out:
        totals[r[3]] = totals.get(r[3], 0) + r[2]
    return [(i, code, error, totals[label], sha) for i, code, error, label in out]


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def test_awkward_rows_against_brute_force(spark):
    got = [tuple(r) for r in codes.compress(frame(spark, awkward())).collect()]
    assert sorted(got, key=key) == sorted(brute(awkward()), key=key)


def test_fewer_rows_than_entries_and_empty_table(spark):
    rows = vectors(2, 5)
    got = [tuple(r) for r in codes.compress(frame(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))
    empty = codes.compress(frame(spark, [(1, None, 1)]))
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        codes.compress(frame(spark, [(1, [1.0] * 17, 1)]))


def test_result_does_not_depend_on_partitions_or_label_join(spark, monkeypatch):
    rows = awkward()
    want = sorted(map(tuple, codes.compress(frame(spark, rows)).collect()), key=key)
    monkeypatch.setattr(codes, "_FEW_LABELS", 1)
    got = codes.compress(frame(spark, rows).repartition(7, "label")).collect()
    assert sorted(map(tuple, got), key=key) == want


@pytest.mark.parametrize("spread", [3, 40, 2000])
def test_orchard_finds_the_lowest_nearest_entry(spread):
    rng = np.random.default_rng(spread)
    entries, queries = rng.integers(-spread, spread, (50, 4)), rng.integers(-spread, spread, (3000, 4))
    entries[7] = entries[3]  # equal entries, and with a small spread many ties
    search = codes.Orchard(entries)
    found, apart = search.nearest(queries)
    every = ((queries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
    assert (found == every.argmin(1)).all() and (apart == every.min(1)).all()
    assert search.measured < every.size  # the walk ends early


def test_decode_is_near(spark):
    df = frame(spark, vectors(3, 200))
    books = codes.train(df)
    coded = {r.vec_id: r for r in codes.encode(df, books).collect()}
    for i, v, _ in vectors(3, 200):
        back = codes.decode(coded[i].code, books)
        apart = sum((math.floor(256 * float(np.float32(a))) - 256 * b) ** 2 for a, b in zip(v, back))
        assert round(apart) == coded[i].error
