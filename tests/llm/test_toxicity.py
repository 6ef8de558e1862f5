import random

from lodestar.llm import toxicity
from lodestar.llm.lexicon import FUZZY_LENGTH, Matcher

from .common import awkward, frame, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    terms = {word(rng.randint(3, 8)): i for i in range(25)}
    stems = {"cccb": "stem"}
    clean = {word(6) for _ in range(50)}
    m = Matcher(terms, stems, clean)
    for _ in range(4000):
        w = word(rng.randint(0, 10))
        best = min(((distance(w, t), t) for t in terms if w == t or len(t) >= FUZZY_LENGTH), default=None)
        want = (terms[best[1]], best[0]) if best and best[0] <= 1 else None
        if w.startswith("cccb") and (want is None or want[1] > 0):
            want = ("stem", 0)
        elif want and want[1] and w in clean:
            want = None
        assert m.match(w) == want, w


def corpus(spark):
    rng, rows, known = random.Random(1), [], []
    for i in range(600):
        text = prose(i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["scoundrel", "villain", "wretch", "zorkum", "zorkal", "zorkin", "zorkus", "zorkette"]))
        elif i % 60 == 1:
            text[5:5] = ["he", "said", "\"you", "villain\""]
        rows.append((i, " ".join(text)))
        known.append((i, 1, int(toxic)))
    return rows, known


def test_learns_terms_misspellings_and_quotation(spark):
    rows, known = corpus(spark)
    extra = [(9001, prose(9001, 50) + " vilain vilain scoundrell " + prose(9002, 30)), (9003, ""), (9004, None), (None, prose(4, 40)),
             (9005, prose(9005, 60)), (9006, prose(9006, 40) + " zorkolino zorkett " + prose(9007, 20))]
    docs = frame(spark, rows + extra + awkward())
    labels = spark.createDataFrame([*known, (None, 1, 1), (9005, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = {}
    for r in toxicity.score(docs, model).collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        got[r.doc_id] = r
    held = {r.doc_id for r in docs.where(toxicity.held_out("doc_id")).select("doc_id").collect()}
    wrong = [i for i, _, t in known if i in held and got[i].predicted != t]
    assert len(wrong) <= 0.02 * len(held)
    assert got[9001].predicted == 1 and got[9006].predicted == 1 and got[9001].n_matches == 3
    assert got[9003].predicted == got[9004].predicted == got[None].predicted == got[9005].predicted == 0
    spans = toxicity.match_spans(frame(spark, [(1, "the \"villain\" and a scoundrell"), (2, None)]), model).collect()
    assert sorted((r.first_char, r.edits, r.quoted) for r in spans) == [(5, 0, True), (20, 1, False)]


def test_held_out_labels_do_not_matter(spark):
    rows, known = corpus(spark)
    docs = frame(spark, rows)
    held = {r.doc_id for r in docs.where(toxicity.held_out("doc_id")).select("doc_id").collect()}
    scores = []
    for flip in (False, True):
        labels = spark.createDataFrame([(i, 1, 1 - t if flip and i in held else t) for i, _, t in known], "doc_id long, quality int, toxic int")
        scores.append({r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()})
    assert scores[0] == scores[1]


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(frame(spark, awkward()), none)
    assert {(r.score, r.predicted) for r in toxicity.score(frame(spark, awkward()), model).collect()} == {(0.0, 0)}
    assert toxicity.score(frame(spark, []), model).count() == 0


def swap_distance(a, b):
    """Edits with swapped neighbours as one."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a):
        rows.append([i + 1])
        for j, y in enumerate(b):
            least = min(rows[i][j + 1] + 1, rows[i + 1][j] + 1, rows[i][j] + (x != y))
            if i and j and x == b[j - 1] and y == a[i - 1]:
                least = min(least, rows[i - 1][j - 1] + 1)
            rows[i + 1].append(least)
    return rows[-1][-1]


def test_two_edits_and_swaps_by_length():
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abc") for _ in range(n))
    terms = {word(rng.randint(3, 10)): i for i in range(12)}
    m = Matcher(terms, {}, edits=2, swaps=True)
    for _ in range(4000):
        w = list(rng.choice(sorted(terms)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randint(0, 2)] = rng.choice([[rng.choice("abc")], w[at:at + 2][::-1]])
        w = "".join(w)
        near = [(swap_distance(w, t), t) for t in terms]
        best = min(((d, t) for d, t in near if d <= (len(t) >= 4) + (len(t) >= 8)), default=None)
        assert m.match(w) == (best and (terms[best[1]], best[0])), w


def test_masked_swapped_and_short_forms_match():
    m = Matcher({"idiot": 3.0, "stupid": 2.0, "scum": 1.0, "disgusting": 4.0}, {"moro": 5.0}, {"sum", "co.st"}, edits=2, swaps=True)
    scorer = toxicity.Scorer(m)
    for text, want in {"an idoit": [(3, 1, 3.0, 1)], "stpuid": [(0, 0, 2.0, 1)], "scun": [(0, 0, 1.0, 1)], "disgustngg": [(0, 0, 4.0, 2)],
                       "the id*ot,st.upid": [(4, 1, 3.0, 1), (10, 3, 2.0, 1)], "m0-ron mor.on": [(7, 2, 5.0, 1)], "i_d_i_o_t!": [(0, 0, 3.0, 1)],
                       "s*um sum co.st": [(0, 0, 1.0, 1)], "idiot-id.iot": [(0, 0, 3.0, 0), (6, 1, 3.0, 1)], "by-nc 4.0 a...": []}.items():
        assert [x[:4] for x in scorer.matches(text)] == want, text
    assert scorer.matches("a." * 50_000 + "x" * 50_000) == []


def test_quotation_marks_pair_within_a_line():
    scorer = toxicity.Scorer(Matcher({"idiot": 3.0}, {}))
    for text, want in {"he said \"hi\" you idiot \"bye\"": False, "\"you idiot\"": True, "\"" + "x " * 90 + "idiot" + " x" * 90 + "\"": True,
                       "he said that you are an idiot": False, "the word idiot": True, "a 5\" pipe, \"idiot\" here": True, "\"a\nidiot\"": False,
                       "„idiot“ da": True, "«a» idiot «b»": False, "“a «idiot» b”": True, "“a «b» idiot” b": True, "\"a idiot": False}.items():
        assert [x[4] for x in scorer.matches(text)] == [want], text
