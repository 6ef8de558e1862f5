import random

from lodestar.llm import decontamination
from lodestar.llm.decontamination import tile

from .common import awkward, frame, prose


def brute_tiles(a, b, least):
    """Greedy string tiling by comparing every pair of places."""
    free_a, free_b, covered, count = [True] * len(a), [True] * len(b), 0, 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered, count
        free_a[i:i + n] = free_b[j:j + n] = [False] * n
        covered, count = covered + n, count + 1


def test_tiling_equals_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        b = [rng.randrange(6) for _ in range(rng.randint(1, 25))]
        a = [rng.randrange(6) for _ in range(rng.randint(0, 30))]
        at = rng.randrange(len(a) + 1)
        a[at:at] = b[len(b) // 2:] + [9] + b[:len(b) // 2]
        tiles = tile(a, b, 3)
        assert (sum(n for n, _, _ in tiles), len(tiles)) == brute_tiles(a, b, 3)
        assert all(a[i:i + n] == b[j:j + n] for n, i, j in tiles)


def test_plain_reordered_and_partial_passages(spark):
    items = [(i, prose(500 + i, 30)) for i in range(20)] + [(50, None), (51, ""), (52, "tiny item"), (None, prose(900, 30)), (0, prose(500, 30))]
    w = items[3][1].split()
    quarter = [w[:8], w[8:16], w[16:24], w[24:]]
    rows = awkward() + [
        (100, prose(1, 50) + " " + items[0][1].upper() + "! " + prose(2, 9)),
        (101, "\n".join(", ".join(q) for q in reversed(quarter)) + " " + prose(4, 10_000)),
        (102, prose(5, 100) + " " + " ".join(items[4][1].split()[:9])),
        (103, " ".join(items[5][1].split()[:20])), (104, items[5][1]), (104, items[5][1]), (105, prose(900, 30)),
        (106, "tiny item tiny item")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    for limit in (10**6, 40):  # one block, many blocks
        got = decontamination.leaks(docs, bench, limit=limit).collect()
        assert sorted((r.doc_id, r.item_id is None, r.item_id or 0) for r in got) == [
            (100, False, 0), (100, False, 0), (101, False, 3), (103, False, 5), (104, False, 5), (104, False, 5), (105, True, 0)]
        assert {r.doc_id: r.n_tiles for r in got}[101] == 4
    out = decontamination.drop_leaks(docs, bench)
    assert out.schema == docs.schema
    left = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
    assert left == sorted((i is None, i or 0) for i, _ in rows if i not in (100, 101, 103, 104, 105))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(frame(spark, awkward()), none).count() == 0
    assert decontamination.drop_leaks(frame(spark, awkward()), none).count() == len(awkward())
    assert decontamination.leaks(frame(spark, []), spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")).count() == 0
