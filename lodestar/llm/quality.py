"""Quality rules: a base rule, and a hashed n-gram likelihood ratio against trusted text.

Word unigrams and bigrams of lower-cased words are hashed into ``BUCKETS``
cells.  Two multinomials are estimated with additive smoothing: one over
trusted documents (labelled quality 1), one over the whole corpus, every
document counted.  A document's score is the log-likelihood ratio of its
n-grams, target over raw, divided by their number.  Documents below a fixed
threshold of that score are rejected; the decision depends on the document
and the two tables alone, never on a random draw.

The threshold is fitted on all labelled documents: the lowest one that tells
nearly as many trusted and rejected ones apart as the best, and never so high
that more than ``LOSS`` of the trusted ones go, each scored as if its own n-grams
were not among the trusted counts.  Scores are counted in steps of 1 / ``STEPS``,
which are also the thresholds to choose from, so the driver holds a table whose
size is bounded by the range of the scores.  Trusted counts use all labelled rows,
found by a shuffle join, and corpus counts all documents.

Results for edge cases: null or empty text has no words, so the base rule
fails; without usable labels (an empty table, or one class only) the method
keeps what the base rule keeps; labels with a null id or null quality count
for nothing, an id labelled both ways counts as not trusted; repeated rows
are each judged; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, row_slices, text_bytes
from .words import U64, Words, mix, odd_constants, solid_bytes, span_hashes, words_of

BUCKETS = 1 << 16
#: Bound on the labelled rows that fit the threshold: none, all of them do.
LABELLED = None
#: Steps of a score that the threshold is chosen from.
STEPS = 4096
#: Share of trusted documents that the threshold may reject at most.
LOSS = 0.002
#: Loss of separation that a lower threshold, which keeps more, may cost.
CLOSE = 0.01
SMOOTHING = 1.0
MIN_WORDS, REPEAT_WORDS, REPEAT_PERCENT = 10, 5, 20
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_PAIR = odd_constants(51, 2)
_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, score double"
#: With trusted counts, also the score of a text whose own n-grams are among them.
_OWN = f"{_COUNTS}, own_score double"


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(words: Words, size: int = REPEAT_WORDS) -> np.ndarray:
    """Words of each text in windows of ``size`` words found twice or more in it."""
    keys, at = words.windows(words.hashes(), size, seed=52)
    if not len(keys):
        return np.zeros(len(words.first) - 1, np.int64)
    keys = mix(keys + words.doc()[at].astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words.start) + 1, np.int64)
    cover[at[twice]] += 1
    cover[at[twice] + size] -= 1
    return _per_text(np.cumsum(cover)[:-1] > 0, words.first)


def duplicate_lines(words: Words) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line."""
    raw, bounds = words.raw, words.bounds
    n = len(bounds) - 1
    breaks = np.flatnonzero(raw == 0x0A)
    start = np.unique(np.concatenate([bounds[:-1][bounds[:-1] < bounds[1:]], breaks + 1]))
    start = start[start < len(raw)]
    if not len(start):
        return np.zeros(n, np.int64)
    doc = np.searchsorted(bounds, start, side="right") - 1
    end = np.minimum(bounds[doc + 1], np.append(breaks, len(raw))[np.searchsorted(breaks, start)])
    total = np.concatenate([[0], np.cumsum(solid_bytes(raw))])
    some = total[end] > total[start]
    start, end, doc = start[some], end[some], doc[some]
    keys = mix(span_hashes(raw, start, end) + doc.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    distinct = np.unique(keys, return_index=True)[1]
    return np.bincount(doc, minlength=n) - np.bincount(doc[distinct], minlength=n)


def gram_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all unigrams and bigrams, and the text's number of each."""
    h = words.hashes(lower=True)
    doc = words.doc()
    pair = mix(h[:-1] * _PAIR[0] + h[1:] * _PAIR[1])
    inside = doc[:-1] == doc[1:]
    keys = np.concatenate([h, pair[inside]])
    return (keys >> U64(64 - 16)).astype(np.int64), np.concatenate([doc, doc[:-1][inside]])


def _slices(column: pa.Array):
    raw, off = text_bytes(column)
    for first, end in row_slices(off):
        yield slice(first, end), words_of(raw[off[first]:off[end]], off[first:end + 1] - off[first])


def _gram_counts(batches):
    """(bucket, raw, target) of one task's rows (text, trusted)."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        trusted = np.array(batch.column(1).fill_null(False))
        for rows, words in _slices(batch.column(0)):
            buckets, doc = gram_buckets(words)
            raw += np.bincount(buckets, minlength=BUCKETS)
            target += np.bincount(buckets[trusted[rows][doc]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])


def _own_share(target: np.ndarray, buckets: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """What each text's score gains by its own n-grams being among the target counts."""
    keys, own = np.unique(doc * BUCKETS + buckets, return_counts=True)
    all_of = target[keys % BUCKETS]
    gain = own * (np.log(all_of + SMOOTHING) - np.log(np.maximum(all_of - own, 0) + SMOOTHING))
    grams, total = np.bincount(doc, minlength=n), target.sum() + SMOOTHING * BUCKETS
    return np.bincount(keys // BUCKETS, weights=gain, minlength=n) / np.maximum(grams, 1) \
        + np.log(total - np.minimum(grams, target.sum())) - np.log(total)


def _measures(ratio: np.ndarray, place: int, keep_text: bool = False, target: np.ndarray | None = None):
    """The input columns (the text in column ``place`` only if kept), then the base counts and the score.

    With ``target``, also the score as if the text were not counted in it.
    """
    fields = [f.split()[0] for f in (_COUNTS if target is None else _OWN).split(", ")]

    def run(batches):
        for batch in batches:
            parts = []
            for _, words in _slices(batch.column(place)):
                n = len(words.first) - 1
                buckets, doc = gram_buckets(words)
                grams = np.bincount(doc, minlength=n)
                score = np.bincount(doc, weights=ratio[buckets], minlength=n) / np.maximum(grams, 1)
                own = [] if target is None else [score - _own_share(target, buckets, doc, n)]
                lead = solid_bytes(words.raw) & ((words.raw & 0xC0) != 0x80)
                parts.append((words.counts, _per_text(lead, words.bounds), _per_text(_SYMBOL[words.raw], words.bounds),
                              duplicate_lines(words), repeated_words(words), grams, score, *own))
            columns = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)] if parts else \
                [pa.array([], pa.int64())] * 6 + [pa.array([], pa.float64())] * (len(fields) - 6)
            kept = [i for i in range(batch.num_columns) if keep_text or i != place]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *columns], names=[*[batch.schema.names[i] for i in kept], *fields])

    return run


def _labelled(labels: DataFrame) -> DataFrame:
    """(labelled, quality) of all labelled ids."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.min("quality").alias("quality"))


def _threshold(trusted: np.ndarray, rejected: np.ndarray, n_trusted: np.ndarray | None = None, n_rejected: np.ndarray | None = None) -> float:
    """Where most of the two are told apart, and at most ``LOSS`` of the trusted lie below; values may come with their numbers."""
    if not len(trusted) or not len(rejected):
        return -np.inf
    n_trusted = np.ones(len(trusted), np.int64) if n_trusted is None else n_trusted
    n_rejected = np.ones(len(rejected), np.int64) if n_rejected is None else n_rejected
    edges, at = np.unique(np.concatenate([trusted, rejected]), return_inverse=True)

    def upto(at, n):  # rows at the edge or below
        return np.cumsum(np.bincount(at, weights=n, minlength=len(edges))).astype(np.int64)

    good, bad = upto(at[:len(trusted)], n_trusted), upto(at[len(trusted):], n_rejected)
    most = int(np.searchsorted(good, min(good[-1] - 1, int(LOSS * good[-1])), side="right"))
    below = np.concatenate([[0], bad])[:most + 1] / bad[-1] - np.concatenate([[0], good])[:most + 1] / good[-1]
    best = int(np.flatnonzero(below >= below.max() - CLOSE)[0])  # the lowest that does nearly as well
    return float((edges[best] + edges[max(best - 1, 0)]) / 2)


def _base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def _ratio(docs: DataFrame, labels: DataFrame, scratch: Scratch, key: str, text: str) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """The log ratio of each bucket, the trusted count of each, and the labelled ids."""
    own = scratch.put(_labelled(labels), "labelled")
    rows = docs.select(F.col(key).cast("long").alias("labelled"), F.col(text).alias("text"))
    # Every row counts as raw where it lies; the rows of all trusted ids are found by a join and count as target.
    trusted = rows.join(own.where("quality = 1"), "labelled").select("text", F.lit(True).alias("trusted"))
    every, trusted = (x.mapInArrow(_gram_counts, "bucket long, raw long, target long")
                      for x in (rows.select("text", F.lit(False).alias("trusted")), trusted))
    counts = every.union(trusted.withColumn("raw", F.lit(0).cast("long")))
    counts = counts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).toPandas().to_numpy(np.int64)  # ``BUCKETS`` rows at most
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[counts[:, 0]], target[counts[:, 0]] = counts[:, 1], counts[:, 2]
    if not target.any():
        return np.zeros(BUCKETS), target, own
    ratio = np.log((target + SMOOTHING) / (target.sum() + SMOOTHING * BUCKETS)) - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS))
    return ratio, target, own


def _fitted(docs: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[np.ndarray, float, DataFrame]:
    """The log ratio of each bucket, the threshold, and (key, counts and scores) of all rows, stored."""
    scratch = Scratch(docs.sparkSession, "quality")
    ratio, target, own = _ratio(docs, labels, scratch, key, text)
    rows = docs.select(F.col(key), F.col(text))
    name = rows.schema[0].dataType.simpleString()
    scored = scratch.put(rows.mapInArrow(_measures(ratio, 1, target=target), f"`{key}` {name}, {_OWN}"), "scored")
    if not target.any():
        return ratio, -np.inf, scored
    known = scored.where(~_base_failed()).select(F.col(f"`{key}`").cast("long").alias("labelled"), "score", "own_score").join(own, "labelled")
    step = F.floor(F.when(F.col("quality") == 1, F.col("own_score")).otherwise(F.col("score")) * STEPS)
    steps = known.groupBy(step.alias("step")).agg(  # a row a step: scores lie between the smallest and the largest log ratio
        F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad")).toPandas().to_numpy(np.int64)
    at, good, bad = (steps[:, 0] + 0.5) / STEPS, steps[:, 1], steps[:, 2]  # the middle of a step, so that no step is cut
    threshold = _threshold(at[good > 0], at[bad > 0], good[good > 0], bad[bad > 0])
    return ratio, threshold, scored


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, float]:
    """The log ratio of each bucket, and the threshold."""
    return _fitted(docs, labels, key, text)[:2]


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score)."""
    _, threshold, scored = _fitted(docs, labels, key, text)
    out = scored.withColumn("base_failed", _base_failed())
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))
    return out.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      kept.alias("kept"), "score")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    ratio, threshold = fit(docs, labels, key, text)
    names = docs.columns
    every = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    judged = every.mapInArrow(_measures(ratio, names.index(text), keep_text=True), f"{fields}, {_COUNTS}")
    return judged.where(~_base_failed() & (F.col("score") >= F.lit(threshold))).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
