import collections

import numpy as np
from lodestar.llm import quality

from .common import awkward, frame, prose, words


def base(text):
    w = words(text)
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    count = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    cover = [False] * len(w)
    for i in range(len(w) - 4):
        if count[tuple(w[i:i + 5])] > 1:
            cover[i:i + 5] = [True] * 5
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, sum(cover),
            len(w) < 10 or 100 * sum(cover) > 20 * len(w))


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus():
    good = [(1000 + i, prose(i, 80)) for i in range(60)]
    junk = [(2000 + i, " ".join(f"{w}$$" for w in prose(70 + i % 5, 80).split()) + " #buy#") for i in range(40)]
    return good, junk


def test_base_counts(spark):
    rows = awkward() + [(20, "a b c d e a b c d e f"), (21, "# x\n# x\r\n# x\n\x0b\n"), (22, "éé <é>")]
    got = quality.judge(frame(spark, rows), labels(spark, [])).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted([tuple(r)[:7] for r in got], key=key) == sorted([(i, *base(t)) for i, t in rows], key=key)
    assert all(r.kept == (not r.base_failed) for r in got)  # no labels: the base rule decides
    assert quality.judge(frame(spark, []), labels(spark, [])).count() == 0


def test_ratio_parts_junk_from_trusted_text_and_is_repeatable(spark):
    good, junk = corpus()
    docs = frame(spark, good + junk)
    known = labels(spark, [(i, 1, 0) for i, _ in good[::2]] + [(i, 0, 0) for i, _ in junk[::2]] + [(None, 1, 0), (1001, None, 0)])
    first = {r.doc_id: r.kept for r in quality.judge(docs, known).collect()}
    assert all(first[i] for i, _ in good) and not any(first[i] for i, _ in junk)
    assert first == {r.doc_id: r.kept for r in quality.judge(docs.repartition(7), known).collect()}
    out = quality.keep_good(docs, known)
    assert out.schema == docs.schema and {r.doc_id for r in out.collect()} == {i for i, _ in good}


def test_threshold_spares_trusted_text():
    trusted, rejected = np.linspace(0, 1, 1000), np.linspace(-1, 0.5, 1000)
    at = quality._threshold(trusted, rejected)
    assert (trusted < at).mean() <= quality.LOSS and (rejected < at).mean() > 0.6
    assert quality._threshold(trusted, rejected[:0]) == -np.inf


def test_all_trusted_labels_are_counted(spark, monkeypatch):
    good, junk = corpus()
    docs, known = frame(spark, good + junk), labels(spark, [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk])
    full, _ = quality.fit(docs, known)
    monkeypatch.setattr(quality, "LABELLED", 20)
    assert (quality.fit(docs, known)[0] == full).all()


def test_threshold_scores_leave_the_own_text_out():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 50, rng.integers(1, 30)) for _ in range(20)]
    count = lambda rows: np.bincount(np.concatenate(rows), minlength=quality.BUCKETS).astype(float)
    log = lambda t: np.log((t + quality.SMOOTHING) / (t.sum() + quality.SMOOTHING * quality.BUCKETS))
    doc = np.repeat(np.arange(20), [len(t) for t in texts])
    got = quality._own_share(count(texts), np.concatenate(texts), doc, 20)
    for i, t in enumerate(texts):
        assert np.isclose(got[i], (log(count(texts)) - log(count(texts[:i] + texts[i + 1:])))[t].mean())


def test_threshold_comes_from_every_labelled_document(spark, monkeypatch):
    seen = []
    real = quality._threshold

    def spy(trusted, rejected, n_trusted, n_rejected):
        seen.append((int(n_trusted.sum()), int(n_rejected.sum())))
        return real(trusted, rejected, n_trusted, n_rejected)

    good, junk = corpus()
    monkeypatch.setattr(quality, "_threshold", spy)
    monkeypatch.setattr(quality, "LABELLED", 5, raising=False)  # the bound that once cut the labels
    quality.fit(frame(spark, good + junk), labels(spark, [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk]))
    assert seen == [(60, 40)]


def test_threshold_of_counted_scores_is_that_of_single_ones():
    rng = np.random.default_rng(2)
    trusted, rejected = rng.integers(-3, 40, 900) / 16, rng.integers(-40, 10, 700) / 16
    counted = [x for y in (trusted, rejected) for x in np.unique(y, return_counts=True)]
    assert quality._threshold(trusted, rejected) == quality._threshold(counted[0], counted[2], counted[1], counted[3])
