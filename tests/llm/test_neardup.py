import itertools

from lodestar.llm import neardup
from lodestar.llm.shared import Scratch

from .common import LOWER, awkward, frame, prose, words


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            a, b = sorted((top(a), top(b)))
            up[b] = a
    return {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


def check(spark, rows):
    got = neardup.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == want[r.doc_id]


def test_awkward_rows(spark):
    check(spark, awkward())
    assert neardup.near_duplicates(frame(spark, [])).count() == 0


def test_chain_of_copies_and_hot_passage(spark):
    base, rows = prose(1, 120).split(), []
    for i in range(40):  # each changes a little more: links along the chain only
        base = base[:3 * i] + [f"w{i}"] + base[3 * i + 1:]
        rows.append((i, " ".join(base)))
    passage = prose(9, 60)
    rows += [(100 + i, passage + " " + prose(50 + i, 25 + i % 7)) for i in range(150)]
    rows += [(300 + i, prose(200, 30)) for i in range(100)]
    check(spark, rows)


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 620)] + [(619, 200), (7, 7)]
    links = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in neardup.components(links, Scratch(spark, "test")).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, **{i: 200 for i in range(500, 620)}}


def test_filter_keeps_columns(spark):
    docs = frame(spark, awkward())
    out = neardup.drop_near_duplicates(docs)
    assert out.schema == docs.schema
    kept = {i for i, (_, _, k) in brute(awkward()).items() if k}
    assert {r.doc_id for r in out.collect()} == kept | {None}


def test_few_tables_are_written(spark, monkeypatch):
    """Short-lived tables cost no file for each task; every held block is let go."""
    base = prose(1, 120).split()
    rows = [(i, " ".join([*base[:3 * i], *(f"w{i}x{j}" for j in range(2)), *base[3 * i + 2:]])) for i in range(30)]
    written, put = [], Scratch.put
    monkeypatch.setattr(Scratch, "put", lambda self, df, name: written.append(name) or put(self, df, name))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    check(spark, rows)
    assert "more" in written
    steps = [n for n in written if n.startswith(("stars", "again"))]
    assert all(n.endswith("small") for n in steps)
    assert len(written) - len(steps) <= 12
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_repeated_ids_reach_the_differences(spark):
    """A doc_id with two texts links through either; members of one head are compared among themselves."""
    base = prose(3, 200).split()
    rows = [(i, " ".join([*base[:6 * i], f"w{i}", *base[6 * i + 1:]])) for i in range(20)]
    got = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(frame(spark, [*rows, (5, prose(77, 80)), (40, prose(77, 80))])).collect()}
    assert got == {(i, 0) for i in [*range(20), 40]}
