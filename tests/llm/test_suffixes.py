import hashlib
import random

import numpy as np
import pytest

from lodestar.llm import suffixes

from .common import awkward, frame, prose


def brute(rows, least=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - least + 1):
            if i is not None:
                s = b[k:k + least]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - least + 1):
            if i is not None and first[b[k:k + least]] < i:
                gone[k] += 1
                gone[k + least] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]]))).reshape(-1, 2)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), len(edges), hashlib.sha256(kept).hexdigest(), edges.tolist(), kept))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def check(spark, rows, least=50):
    got = [tuple(r) for r in suffixes.suffix_digest(frame(spark, rows).repartition(5), least=least).collect()]
    assert sorted(got, key=key) == sorted([r[:5] for r in brute(rows, least)], key=key)


def shared_passages():
    """Passages of all lengths around the bound, at any place, with common prefixes and in nested forms."""
    rng, base = random.Random(3), prose(0, 400)
    rows = [(0, base)]
    for i in range(1, 120):
        at, n = rng.randrange(len(base) - 200), 40 + i
        rows.append((i, prose(100 + i, i % 5) + base[at:at + n] + prose(300 + i, 2) + base[at:at + n - 7][::-1]))
    hot = prose(7, 14)  # a passage of about 60 bytes that most documents hold
    rows += [(1000 - i, prose(900 + i, i % 4) + hot + prose(2000 + i, 3)) for i in range(250)]
    return rows + [(2000, "again " * 60), (2001, "a" * 500), (2002, "b" + "a" * 300 + "b"), (2003, "again " * 30), (2004, "\0" * 120), (2005, "\0" * 70 + "x")]


def test_awkward_rows(spark):
    check(spark, [(i, t) for i, t in awkward() if i != 10])
    assert suffixes.suffix_digest(frame(spark, [])).count() == 0


def test_one_id_with_different_texts(spark):
    text = prose(1, 60)
    check(spark, [(1, text), (2, text), (2, "other start " + text), (2, text), (3, text[20:]), (None, text)])


@pytest.mark.parametrize("least", [7, 20, 50, 64])
def test_shared_passages_at_all_places(spark, least):
    check(spark, shared_passages(), least)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "RUN_BYTES", 700)  # the driver's tasks inherit it only in local mode
    rows = shared_passages()[:60] + [(5000, prose(0, 400) * 3), (5001, "start" + prose(0, 400))]
    shape = suffixes.Shape(50)
    whole, parts = set(), set()
    for _, t in rows:
        raw = np.frombuffer(t.encode(), np.uint8)
        at, _, near, far, _ = suffixes.suffixes_of(raw, np.array([0, len(raw)]), shape)
        whole |= {(t, int(a), j) for a, n, f in zip(at, near, far) for j in range(n, f + 1)}
        import pyarrow as pa
        for piece, off, _, base in suffixes._pieces(pa.array([t]), 50):
            at, _, near, far, _ = suffixes.suffixes_of(piece, off, shape)
            parts |= {(t, int(a) + base, j) for a, n, f in zip(at, near, far) for j in range(n, f + 1)}
    assert whole == parts


def test_maximal_runs_and_cut_text(spark):
    rows = [(i, t) for i, t in awkward() if i != 10]
    docs = frame(spark, rows)
    got = sorted((r.doc_id, r.first_byte, r.n_bytes) for r in suffixes.repeats(docs).collect())
    assert got == sorted((r[0], a, b - a) for r in brute(rows) for a, b in r[5])
    cut = suffixes.cut_repeats(docs)
    assert cut.columns == docs.columns
    want = sorted((str(r[0]), None if t is None else r[6]) for r, (_, t) in zip(brute(rows), rows) if t is not None)
    assert sorted((str(r.doc_id), bytes(r.text)) for r in cut.where("text IS NOT NULL").collect()) == want
    assert cut.where("text IS NULL").count() == sum(t is None for _, t in rows)


@pytest.mark.parametrize("runs", [1, 2, 3, 8, 13])
def test_loser_tree_sorts_and_keeps_common_prefixes(runs):
    rng = random.Random(runs)
    made, every = [], []
    for _ in range(runs):
        strings = sorted(bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randrange(0, 80)))
        common = [0] + [next((k for k in range(12) if x[k] != y[k]), 12) for x, y in zip(strings, strings[1:])]
        made.append((strings, common[:len(strings)]))
        every += strings
    order, shared = suffixes.merge(made)
    out = [every[i] for i in order]
    assert out == sorted(every) and sorted(order) == list(range(len(every)))
    assert shared[1:] == [next((k for k in range(12) if x[k] != y[k]), 12) for x, y in zip(out, out[1:])]


def test_front_coding_round_trip():
    rng = np.random.default_rng(1)
    shape, n = suffixes.Shape(50), 400
    near, far = rng.integers(0, 5, n), rng.integers(5, 30, n)
    right, left = rng.integers(0, 3, (n, 56)).astype(np.uint8), rng.integers(97, 99, (n, 32)).astype(np.uint8)
    right[np.arange(56) >= 50 - near[:, None]] = 0
    left[np.arange(32) >= far[:, None]] = 0
    run = suffixes.Suffixes(right, left, near, far, rng.integers(0, 1 << 60, n), rng.integers(0, 1 << 32, n), rng.integers(0, 1 << 40, n))
    kept, where, later = suffixes._sorted_run(run, rng.integers(0, 3, n))
    assert len(kept) + len(later) == n
    for value, row in enumerate(suffixes._front_coded(kept, where)):
        back, shared = suffixes._decoded({**row, "docs": row["docs"]}, shape)
        own = kept.take(where == row["range"])
        for f in suffixes.Suffixes.__dataclass_fields__:
            assert (getattr(back, f) == getattr(own, f)).all(), f
        assert (shared == suffixes._common(own.right)).all()
