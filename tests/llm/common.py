"""Shared helpers: small tables with the awkward rows, and brute-force words."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def frame(spark, rows, extra=""):
    """Documents of (doc_id, text), with columns whose names operators use inside as well."""
    full = SCHEMA + ", kept boolean, component string, slot string, `a b` string, length string"
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, None, "c", "x", "y", "z") for i, t in rows], full)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def awkward():
    """Nulls, empty and very long texts, ties, repeated rows, shared passages, copies."""
    base, passage = prose(1, 60), prose(2, 30)
    near = base.split()
    near[30] = "other"
    rows = [(0, base), (1, base), (2, " ".join(near)), (3, None), (4, ""), (5, " \t\n "), (6, "one two"), (7, "One\ttwo"),
            (8, prose(3, 20) + " " + passage + " " + prose(4, 5)), (9, passage + "\n" + prose(5, 40)), (9, passage + "\n" + prose(5, 40)),
            (10, prose(6, 8000)), (11, "x" * 200_000), (12, "é à ü " * 30), (None, base), (None, None), (13, passage)]
    return rows + [(14, " ".join(near[:40]) + " " + prose(7, 3)), (15, "same line\nsame line\nother\n\n\nsame line")]
