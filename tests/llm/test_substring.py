import hashlib

from lodestar.llm import substring

from .common import awkward, frame, prose, words


def brute(rows, least=13):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - least + 1):
            key = tuple(w[k:k + least])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - least + 1):
            if i is not None and first[tuple(w[k:k + least])] < i:
                gone[k:k + least] = [True] * least
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), gone))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2], r[3])


def check(spark, rows):
    got = [tuple(r) for r in substring.substring_digest(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted([r[:4] for r in brute(rows)], key=key)


def test_awkward_rows(spark):
    check(spark, awkward())
    assert substring.substring_digest(frame(spark, [])).count() == 0


def test_shared_passages_at_all_offsets(spark):
    rows = [(0, prose(0, 200))]
    w = rows[0][1].split()
    for i in range(1, 60):  # pieces of 11 to 17 words at any place, in front of, inside and after other text
        n = 11 + i % 7
        rows.append((i, " ".join(prose(100 + i, i % 9).split() + w[2 * i:2 * i + n] + prose(300 + i, 3).split())))
    rows += [(100 + i, prose(5, 40) + " " + prose(600 + i, 10)) for i in range(50)]
    rows += [(200, "again " * 40), (201, "again " * 30)]
    check(spark, rows)


def test_spans_are_maximal(spark):
    rows = awkward()
    got = sorted((r.doc_id, r.first_word, r.n_words) for r in substring.repeats(frame(spark, rows)).collect())
    want = []
    for i, _, _, _, gone in brute(rows):
        at = 0
        while at < len(gone):
            end = at
            while end < len(gone) and gone[end]:
                end += 1
            if end > at:
                want.append((i, at, end - at))
            at = end + 1
    assert got == sorted(want)


def test_cut_keeps_columns_and_layout(spark):
    docs = frame(spark, awkward())
    out = substring.cut_repeats(docs)
    assert out.schema == docs.schema
    want = {i: [w for w, g in zip(words(t), gone) if not g] for (i, t), (_, _, _, _, gone) in zip(awkward(), brute(awkward())) if i is not None}
    for r in out.collect():
        if r.doc_id is not None:
            assert words(r.text) == want[r.doc_id]
    by_id = {r.doc_id: r.text for r in out.collect()}
    assert by_id[3] is None and by_id[5] == " \t\n " and by_id[15] == dict(awkward())[15]
