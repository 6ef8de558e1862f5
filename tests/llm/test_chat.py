import duckdb
from lodestar.llm import chat
from pyspark.sql import functions as F

COLUMNS = ["pair_id", "chosen_id", "rejected_id", "prompt_turns", "prompt", "chosen", "rejected", "chosen_mask", "rejected_mask"]
SCHEMA = "conv_id long, turn int, role string, text string, n string, a string, pair_id string"
ROWS = [
    (0, 0, "system", "be kind"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"),
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "no"), (1, 3, "user", "why"), (1, 4, "assistant", "so"),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"), (3, 0, "user", "same"), (3, 1, "assistant", "same"),
    (4, 0, "user", "alone"), (6, 0, None, None), (6, None, "user", ""), (7, 0, None, None), (7, 0, None, None),
    (None, 0, "user", "nobody"), (9, 0, "assistant", "é\n" * 50_000), (8, 5, "user", "x")]


def brute(rows):
    convs = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    for p in sorted({c // 2 for c in convs}):
        ids = sorted((c for c in convs if c // 2 == p), key=lambda c: (-len(convs[c]), c))
        turns = [[(r, x) for _, _, r, x in sorted(convs[c])] for c in ids] + [[]]
        n = 0
        while n < min(len(turns[0]), len(turns[1])) and turns[0][n] == turns[1][n]:
            n += 1
        text = lambda ts: "".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in ts)
        mask = lambda ts: ",".join(f"{len(r) + 5}:0,{len(x) + 8}:{int(r == 'assistant')}" for r, x in ts)
        c, r = turns[0][n:], turns[1][n:]
        out.append((p, ids[0], ids[1] if len(ids) > 1 else None, n, text(turns[0][:n]), text(c), text(r), mask(c), mask(r)))
    return out


def test_pairs_equal_brute_force_and_sql(spark):
    docs = spark.createDataFrame([(*r, "n", "a", "p") for r in ROWS], SCHEMA)
    got = chat.preference_pairs(docs, F.floor(F.col("conv_id") / 2).cast("long"))
    assert got.columns == COLUMNS
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == brute(ROWS)
    conversations = docs.toArrow()  # noqa: F841
    sql = duckdb.sql(f"SELECT {', '.join(COLUMNS)} FROM ({chat.ORACLE}) q").fetchall()
    assert sorted(tuple(r) for r in sql) == rows
    for _, _, _, _, _, chosen, rejected, *masks in rows:
        for text, mask in zip((chosen, rejected), masks):
            runs = [x.split(":") for x in mask.split(",") if x]
            assert sum(int(n) for n, _ in runs) == len(text)


def test_empty_table(spark):
    assert chat.preference_pairs(spark.createDataFrame([], SCHEMA), F.floor(F.col("conv_id") / 2).cast("long")).count() == 0


def test_every_further_conversation_of_a_key_is_rejected_against_the_chosen_one(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "hi" if t == 0 else f"{c}")
            for c, n in [("k", 2), ("m", 4), ("a", 4), ("z", 1)] for t in range(n)]
    docs = spark.createDataFrame([(*r, k) for r in rows for k in (None, "key")], "conv_id string, turn int, role string, text string, pair_id string")
    got = chat.preference_pairs(docs.where("pair_id IS NULL"), F.col("pair_id")).collect()
    assert {(r.pair_id, r.chosen_id, r.rejected_id, r.prompt_turns) for r in got} == {
        (None, "a", "k", 1), (None, "a", "m", 1), (None, "a", "z", 1)} and len(got) == 3
    both = chat.preference_pairs(docs, F.col("pair_id"))
    assert both.count() == 6
    assert {r.rejected for r in both.collect() if r.rejected_id == "k"} == {"<|assistant|>\nk<|end|>\n"}
