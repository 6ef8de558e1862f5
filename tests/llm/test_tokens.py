import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from lodestar.llm import tokens
from lodestar.llm.shared import text_bytes
from tokenizers import Tokenizer

from .common import awkward, prose

PATH = public_tokenizers.path("word_bpe_49k.json")
#: Characters at which lower-casing, composing, cutting or splitting might go wrong.
ODD = ["a", "B", "z", "é", "É", "×", "÷", "ß", "ÿ", "ª", "µ", "'", "'s", "'T", "'re", "’", ".", ",", "|", "<", "<|", "<|endoftext|>",
       "<|ENDOFTEXT|>", "1", "22", " ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "́", "̇", "̸", "I", "K", "=", ";", "İ",
       "Σ", "ς", "中", "😀", "\x00", "\x7f", "hello", "World", "abcdefghijklmnop", "q" * 17, "-", "가", "ﬁ"]


def check(worker, texts):
    whole = Tokenizer.from_file(PATH)
    ids, bounds = worker.ids(*text_bytes(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids, text


def odd(n, seed=1):
    rng = random.Random(seed)
    latin = [c for c in ODD if ord(max(c)) < 256]
    return ["".join(rng.choice(ODD if i % 2 else latin) for _ in range(rng.randint(0, 25))) for i in range(n)]


def test_ids_equal_the_tokenizer():
    worker = tokens.WordTokenizer(PATH)
    assert worker.direct
    check(worker, [])
    check(worker, [t for _, t in awkward()] + odd(6000))
    check(worker, odd(500))  # again, known by now


def test_forgotten_units_and_full_slots(monkeypatch):
    monkeypatch.setattr(tokens, "SLOTS", 64)  # neighbours collide
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    monkeypatch.setattr(tokens, "LONG_BYTES", 50)
    monkeypatch.setattr(tokens, "_UNITS", 20)
    check(tokens.WordTokenizer(PATH), [prose(1, 400), *odd(300, 2), "x" * 70, "y" * 70 + " z"])


def test_a_known_unit_costs_no_call():
    """Units shared by words that differ as wholes are tokenised once; 965 CPU s a GB were spent on words before."""
    worker, met = tokens.WordTokenizer(PATH), []
    learn = worker._learn
    worker._learn = lambda words: (met.extend(words), learn(words))
    check(worker, ["alpha|beta(gamma) Alpha ALPHA, beta. gamma;1"])
    check(worker, ["alpha beta|gamma", "(beta) ALPHA|", "gamma;1"])
    assert len(met) == len(set(met)) and not any(re.search(rb"[a-z][^a-z]|[^a-z][a-z]", w) for w in met)
    assert np.diff(worker.first[:worker.count]).min() >= 0
