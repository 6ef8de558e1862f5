"""Toxicity: a learned lexicon matched by Levenshtein automata, scored in context.

1. Lexicon.  Labelled training texts (rows with near-equal sketches count once)
   give each word's number of toxic and of clean texts.  Words, and common
   beginnings of several words, that a likelihood-ratio test ties to toxic
   texts become terms and stems.
2. Matching.  Every word of every text runs through the automaton of
   ``lexicon.Matcher``: terms also match with one edit from 4 letters on and
   with two from 8 on (two neighbours swapped are one edit), unless the word is
   known from clean texts.  Words with other characters inside (``st.upid``,
   ``id*ot``) match in the same way, as written and with those left out.
3. Context.  A match between two paired quotation marks of its line, or
   directly after a reporting word, counts as quoted.  Unquoted matches near one another weigh as abuse.
4. A logistic model over these counts, fitted on the training rows, gives the
   score.

At most ``LABELLED`` labelled rows (the smallest hashes of their ids) take part
in learning, and the lexicon holds at most ``TERMS`` terms; both are bounds of
the model, not of what is scored.  Only rows with crc32(id) mod 3 other than 1
are used, the others are held out.  Language, source and id are no inputs.

Results for edge cases: null or empty text has no matches and scores the
model's intercept; without both classes among the labels every score is 0;
labels with a null id or null value count for nothing, an id labelled both
ways counts as toxic; a null id is scored and never held out; repeated rows
are each scored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lexicon import Matcher
from .shared import Scratch
from .words import mix, odd_constants

#: Bounds on the labelled rows and on the lexicon.
LABELLED, TERMS = 20_000, 2_000
#: Least likelihood-ratio statistic, and least ratio of the shares of toxic and clean texts.
EVIDENCE, LIFT = 30.0, 3.0
#: Evidence from which a term counts in full, and the most that one counts (a log ratio).
FULL, MOST = 60.0, 8.0
STEM_LETTERS = (4, 12)
#: Words to either side that make a match's context.
NEAR = 6
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")
# Letters and digits with other characters inside, and the pieces of these.
_MASKED = re.compile(r"(?<![^\W_])[^\W_]++(?:(?:[^\w\s]|_)++[^\W_]++)++")
_PIECE = re.compile(r"[^\W_]+")
#: Characters of the longest masked form: of the longest term, with two more.
LONGEST = 42
_KNOWN = 300_000
# Quotation marks and reporting words.
_MARK = re.compile("[\"“”„«»\n]")
_CLOSED_BY = {"\"": "\"", "“": "”", "”": "”", "„": "“”", "«": "»", "»": "«"}
_KIND = {"\"": 0, "“": 1, "”": 1, "„": 1, "«": 2, "»": 2}
_REPORTS = frozenset("said says called word words quote quoted term wrote dit disait mot sagte sagt wort dijo dice palabra".split())
FEATURES = ("strong", "weight", "quoted", "share", "cluster")
#: Weight (log ratio) from which a term is strong.
STRONG = 5.0
#: Most edits of a match.
EDITS = 2
#: What a match with an edit counts of its term's weight.
MISSPELT = 0.7


def held_out(key: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def _quotations(text: str) -> tuple[list[int], list[int]]:
    """First characters of the quotations, ascending, and the furthest end of those up to each.

    Marks of a kind pair off from left to right within a line; one that follows
    a letter or digit opens nothing, one that no other closes is none.
    """
    spans: list[tuple[int, int]] = []
    opened: dict[int, tuple[int, str]] = {}
    for m in _MARK.finditer(text):
        mark, at = m[0], m.start()
        if mark == "\n":
            opened.clear()
            continue
        kind = _KIND[mark]
        if kind in opened and mark in opened[kind][1]:
            spans.append((opened.pop(kind)[0], at))
        elif kind not in opened and not (at and text[at - 1].isalnum()):
            opened[kind] = at, _CLOSED_BY[mark]
    spans.sort()
    return [first for first, _ in spans], list(itertools.accumulate((last for _, last in spans), max))


def _runs(token: str, free=lambda piece: True):
    """(first, last, forms) of neighbouring ``free`` pieces of a masked token: as written and without what stands between.

    By first piece, the shorter ones first; none of more than ``LONGEST`` letters.
    """
    pieces = [(m.start(), m.end(), m[0]) for m in _PIECE.finditer(token)]
    usable = [free(p) for *_, p in pieces]
    for i, (first, _, joined) in enumerate(pieces):
        for j in range(i + 1, len(pieces)):
            joined += pieces[j][2]
            if not usable[i] or not usable[j] or len(joined) > LONGEST:
                break
            last = pieces[j][1]
            yield first, last, (token[first:min(last, first + 2 * LONGEST)], joined)


class Scorer:
    """Matches and context counts of whole texts."""

    def __init__(self, matcher: Matcher):
        self.matcher, self.known, self.known_masked = matcher, {}, {}

    def masked(self, token: str) -> list[tuple[int, int, float, int]]:
        """(first, last character, weight, edits) of the matches of a masked token that no piece of it gives by itself."""
        best: dict[int, tuple] = {}
        for first, last, (written, joined) in _runs(token, lambda piece: self.matcher.match(piece) is None):
            if written in self.matcher.clean:
                continue
            for found in (self.matcher.match(written), self.matcher.match(joined)):
                if found is not None and (first not in best or max(1, found[1]) < best[first][3]):
                    best[first] = first, last, found[0], max(1, found[1])
        out: list[tuple] = []
        for _, own in sorted(best.items()):
            if not out or out[-1][1] <= own[0]:
                out.append(own)
        return out

    def matches(self, text: str) -> list[tuple[int, int, float, int, bool]]:
        """(character of the lower-cased text, word number, weight, edits, quoted) of each match."""
        lower = text.lower()
        words = _WORD.findall(lower)
        known, hits, found = self.known, [], []
        if len(known) > _KNOWN:
            known.clear()
        for i, word in enumerate(words):
            if word not in known:
                known[word] = self.matcher.match(word)
            if known[word] is not None:
                hits.append((i, *known[word]))
        covered = []
        if len(self.known_masked) > _KNOWN:
            self.known_masked.clear()
        for m in _MASKED.finditer(lower):
            if m[0] not in self.known_masked:
                self.known_masked[m[0]] = self.masked(m[0])
            covered += [(m.start() + first, m.start() + last, w, e) for first, last, w, e in self.known_masked[m[0]]]
        if hits or covered:
            spans = [m.span() for m in _WORD.finditer(lower)]
            opening, furthest = _quotations(lower)
            taken = [spans[i] for i, *_ in hits]
            at = [first for first, _ in spans]
            places = [first for first, _ in taken]
            spots = [(*spans[i], i, w, e) for i, w, e in hits]
            for first, last, w, e in covered:
                before = bisect.bisect_left(places, last) - 1
                if before < 0 or taken[before][1] <= first:
                    spots.append((first, last, bisect.bisect_right(at, first) - 1, w, e))
            for first, last, i, w, e in sorted(spots):
                before = bisect.bisect_left(opening, first) - 1
                quoted = before >= 0 and furthest[before] >= last or i > 0 and words[i - 1] in _REPORTS
                found.append((first, i, w, e, quoted))
        return found

    def features(self, text: str) -> tuple[list[float], int, int]:
        found = self.matches(text)
        words = len(_WORD.findall(text)) if found else 1
        plain = [(i, w * MISSPELT if e else w) for _, i, w, e, q in found if not q]
        quoted = sum(1 for *_, q in found if q)
        top = max((w for _, w in plain), default=0.0)
        places = [i for i, _ in plain]
        most = max((bisect.bisect_right(places, i + NEAR) - at for at, i in enumerate(places)), default=0)
        share = 100 * len(plain) / max(1, words)
        return [float(top >= STRONG), math.log1p(sum(w for _, w in plain)), math.log1p(quoted),
                math.log1p(share), math.log1p(most)], len(found), quoted


def _vocabulary(batches):
    """(sketch1, sketch2, toxic, words, masked) of labelled rows (toxic, text).

    Two minima of five-word shingles, the distinct words, and the forms of the masked ones.
    """
    salt, place = odd_constants(61, 2), odd_constants(62, 5)
    for batch in batches:
        one, two, out, masked = [], [], [], []
        for text in batch.column(1).to_pylist():
            lower = (text or "").lower()
            words = _WORD.findall(lower)
            h = np.array([hash_of(w) for w in words] or [0], np.uint64)
            n = max(1, len(h) - 4)
            h = mix(sum(h[j:j + n] * c for j, c in enumerate(place) if j < len(h)))
            one.append(int(mix(h * salt[0]).min().view(np.int64)))
            two.append(int(mix(h * salt[1]).min().view(np.int64)))
            out.append(sorted(set(words)))
            masked.append(sorted({form for token in set(_MASKED.findall(lower)) for *_, forms in _runs(token) for form in forms}))
        yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), batch.column(0),
                                          pa.array(out, pa.list_(pa.string())), pa.array(masked, pa.list_(pa.string()))],
                                         names=["one", "two", "toxic", "words", "masked"])


def hash_of(word: str) -> int:
    """The same 64-bit number for a word in every process."""
    import xxhash

    return xxhash.xxh64_intdigest(word.encode())


def _evidence(toxic, clean, all_toxic: int, all_clean: int) -> F.Column:
    """Log-likelihood ratio of two binomials against one."""
    n = toxic + clean
    p = F.lit(all_toxic / (all_toxic + all_clean))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (part(toxic, n * p) + part(clean, n * (1 - p)))


def _tied(table: DataFrame, all_toxic: int, all_clean: int) -> DataFrame:
    lift = ((F.col("toxic") + 0.5) / (all_toxic + 1)) / ((F.col("clean") + 0.5) / (all_clean + 1))
    return table.withColumn("evidence", _evidence(F.col("toxic"), F.col("clean"), all_toxic, all_clean)) \
        .withColumn("lift", lift).where((F.col("evidence") >= EVIDENCE) & (F.col("lift") >= LIFT))


def _weight(evidence: float, lift: float) -> float:
    return min(1.0, evidence / FULL) * min(MOST, math.log(lift))


def learn_lexicon(texts: DataFrame, scratch: Scratch) -> Matcher:
    """The matcher of training rows (toxic, text)."""
    rows = texts.mapInArrow(_vocabulary, "one long, two long, toxic int, words array<string>, masked array<string>")
    rows = scratch.put(rows.dropDuplicates(["toxic", "one"]).dropDuplicates(["toxic", "two"]), "vocabulary")
    sums = rows.agg(F.count_if(F.expr("toxic = 1")), F.count_if(F.expr("toxic = 0"))).first()
    words = rows.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if(F.expr("toxic = 1")).alias("toxic"), F.count_if(F.expr("toxic = 0")).alias("clean"))
    words = scratch.put(words.where(F.length("word").between(3, 40)), "words")
    best = _tied(words, *sums).orderBy(F.desc("evidence"), "word").limit(TERMS).toPandas()
    terms = {w: _weight(x, lift) for w, x, lift in zip(best["word"], best["evidence"], best["lift"])}
    # Beginnings shared by several words, counted where one of them is seen.
    stems = words.select("toxic", "clean", "word", F.explode(F.expr(
        f"transform(sequence({STEM_LETTERS[0]}, greatest({STEM_LETTERS[0]}, least(length(word) - 1, {STEM_LETTERS[1]}))), n -> left(word, n))")).alias("stem")) \
        .where(F.length("word") > F.length("stem")).groupBy("stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.max("toxic").alias("most"), F.count_if(F.expr("toxic > 0")).alias("kinds"))
    stems = _tied(stems.where("kinds >= 4 AND toxic >= 2 * most"), *sums).orderBy(F.desc("evidence"), "stem").limit(TERMS).toPandas()
    found: dict[str, tuple[float, int]] = {}
    for stem, evidence, lift, toxic in sorted(zip(stems["stem"], stems["evidence"], stems["lift"], stems["toxic"])):
        # The longest stem that keeps nearly all of a shorter one's texts, and none below another.
        up = next((s for s in found if stem.startswith(s)), None)
        if up is not None and toxic < 0.9 * found[up][1]:
            continue
        if up is not None:
            del found[up]
        found[stem] = (_weight(evidence, lift), int(toxic))
    terms = {w: v for w, v in terms.items() if not any(w.startswith(s) for s in found)}
    probe = Matcher(terms, {}, edits=EDITS, swaps=True)
    clean = words.where("clean > 0").select("word").union(rows.where("toxic = 0").select(F.explode("masked")).distinct())
    known = sorted(_known_neighbours(clean, probe))
    return Matcher(terms, {s: v[0] for s, v in found.items()}, known, edits=EDITS, swaps=True)


def _known_neighbours(words: DataFrame, probe: Matcher) -> set[str]:
    """Words of clean texts within the edits of a term: few, as each term has few neighbours."""

    def near(batches):
        for batch in batches:
            keep = [bool((m := probe.match(w)) and m[1]) for w in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return {r[0] for r in words.mapInArrow(near, "word string").collect()}


def _counted(matcher: Matcher, kept: int):
    """The first ``kept`` columns of rows (..., text), then the features and counts."""

    def run(batches):
        scorer = Scorer(matcher)
        for batch in batches:
            found = [scorer.features(t.as_py() or "") for t in batch.column(kept)]
            columns = [pa.array([f[0] for f in found], pa.list_(pa.float64())), pa.array([f[1] for f in found], pa.int32()),
                       pa.array([f[2] for f in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *columns],
                                             names=[*batch.schema.names[:kept], "features", "n_matches", "n_quoted"])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights with the intercept first, by Newton's method with a ridge on the rest.

    More of a feature never makes a text less toxic, but for quotation: other
    features whose weight would be negative are left out.
    """
    x = np.column_stack([np.ones(len(x)), x])
    used = np.ones(x.shape[1], bool)
    free = {0, 1 + FEATURES.index("quoted")}
    while True:
        own = x[:, used]
        w, penalty = np.zeros(own.shape[1]), np.diag([1e-6, *[ridge] * (own.shape[1] - 1)])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            step = np.linalg.solve((own * (p * (1 - p))[:, None]).T @ own + penalty, own.T @ (p - y) + penalty @ w)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        out = np.zeros(x.shape[1])
        out[used] = w
        worst = min((i for i in np.flatnonzero(used) if i not in free), key=lambda i: out[i], default=None)
        if worst is None or out[worst] >= 0:
            return out
        used[worst] = False


class Model:
    """A matcher and the logistic weights over its features (None: every score is 0)."""

    def __init__(self, matcher: Matcher, weights: np.ndarray | None):
        self.matcher, self.weights = matcher, weights


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """The model learnt from the labelled rows that are not held out."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    own = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id")).groupBy(
        F.col("doc_id").cast("long").alias("labelled")).agg(F.max("toxic").cast("int").alias("toxic"))
    own = scratch.put(own.orderBy(F.xxhash64("labelled"), "labelled").limit(LABELLED), "labelled")
    rows = docs.select(F.col(key).cast("long").alias("labelled"), F.col(text).alias("text"))
    texts = scratch.put(rows.join(F.broadcast(own), "labelled").select("toxic", "text"), "texts")  # ``LABELLED`` ids at most
    seen = {r[0] for r in texts.select("toxic").distinct().collect()}
    if not {0, 1} <= seen:
        return Model(Matcher({}, {}), None)
    matcher = learn_lexicon(texts, scratch)
    rows = texts.mapInArrow(_counted(matcher, 1), "toxic int, features array<double>, n_matches int, n_quoted int")
    known = rows.select("toxic", "features").toPandas()
    return Model(matcher, fit_logistic(np.array(known["features"].tolist()), known["toxic"].to_numpy(float)))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted, n_matches, n_quoted), a row for each input row."""
    rows = docs.select(F.col(key), F.col(text))
    kind = rows.schema[0].dataType.simpleString()
    out = rows.mapInArrow(_counted(model.matcher, 1), f"`{key}` {kind}, features array<double>, n_matches int, n_quoted int")
    if model.weights is None:
        value = F.lit(0.0)
    else:
        first, *rest = [float(w) for w in model.weights]
        total = F.lit(first)
        for i, w in enumerate(rest):
            total = total + F.lit(w) * F.col("features")[i]
        value = 1 / (1 + F.exp(-total))
    return out.select(key, value.alias("score"), (value >= THRESHOLD).cast("int").alias("predicted"), "n_matches", "n_quoted")


def match_spans(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, first_char, word, weight, edits, quoted), a row for each match."""
    rows = docs.select(F.col(key), F.col(text))
    kind = rows.schema[0].dataType.simpleString()
    matcher = model.matcher

    def run(batches):
        scorer = Scorer(matcher)
        for batch in batches:
            keys, found = [], []
            for i, t in enumerate(batch.column(1)):
                spans = scorer.matches(t.as_py() or "")
                keys += [i] * len(spans)
                found += spans
            cut = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys, pa.int64())), pa.array(cut[0], pa.int64()), pa.array(cut[1], pa.int64()),
                 pa.array(cut[2], pa.float64()), pa.array(cut[3], pa.int32()), pa.array(cut[4], pa.bool_())],
                names=[key, "first_char", "word", "weight", "edits", "quoted"])

    return rows.mapInArrow(run, f"`{key}` {kind}, first_char long, word long, weight double, edits int, quoted boolean")
