"""Preference formatting of conversation pairs, with DataFrame functions only.

A pair is a chosen and a rejected conversation of one key.  The turns they have in common
from the start (same role, same text) are rendered once as the prompt; what
follows is rendered as two completions.  Each completion has a mask: runs of
characters with 1 where the model is trained (the assistant's text and its end
mark) and 0 elsewhere (headers, other roles).

A conversation is one training record; its turns come together in one row, as
the output demands.  Turns are ordered by (turn, role, text).

Results for edge cases: a null role is rendered and compared as an empty one,
a null text likewise; a turn row without a conversation id belongs to none and
is left out; repeated turn rows are turns of their own; two equal
conversations give a prompt and two empty completions; a key with one
conversation has a row with an empty prompt, a null id for the other and an
empty completion; conversations without a key pair with one another; a long text
is rendered whole; further columns, whatever their names, are not read; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>\n"
TRAINED = "assistant"


def _header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), _body(t))), "")


def _mask(turns: Column) -> Column:
    """Runs "characters:trained" of the rendered turns, separated by commas."""

    def runs(t):
        own = F.when(t["role"] == TRAINED, F.lit(":1")).otherwise(F.lit(":0"))
        return F.concat(F.char_length(_header(t)).cast("string"), F.lit(":0,"), F.char_length(_body(t)).cast("string"), own)

    return F.array_join(F.transform(turns, runs), ",")


def preference_pairs(turns: DataFrame, pair: Column, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                     text: str = "text") -> DataFrame:
    """(pair_id, chosen_id, rejected_id, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask).

    ``pair`` gives the key of a turn row.  Of a key's conversations the one with
    the most turns is chosen, the smallest id of equals; each other one is
    rejected against it in a row of its own.  Only a conversation's own turns
    are collected, so a key may hold any number of conversations.
    """
    rows = turns.where(F.col(conversation).isNotNull()).select(
        pair.alias("pair_id"), F.col(conversation).alias("conv"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    convs = rows.groupBy("pair_id", "conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    best = convs.groupBy("pair_id").agg(F.min_by(F.struct("conv", "turns"), F.struct(-F.size("turns"), "conv")).alias("best"))
    best = best.select("pair_id", F.col("best.conv").alias("chosen_id"), F.col("best.turns").alias("c"))
    others = convs.select(F.col("pair_id").alias("_pair"), F.col("conv").alias("rejected_id"), F.col("turns").alias("r"))
    pairs = best.join(others, F.col("pair_id").eqNullSafe(F.col("_pair")) & (F.col("rejected_id") != F.col("chosen_id")), "left")
    pairs = pairs.select("pair_id", "chosen_id", "rejected_id", "c", F.coalesce("r", F.slice("c", 1, 0)).alias("r"))
    least = F.least(F.size("c"), F.size("r"))
    differ = F.expr("""array_min(filter(sequence(0, greatest(least(size(c), size(r)) - 1, 0)),
        i -> NOT (get(c, i).role <=> get(r, i).role AND get(c, i).text <=> get(r, i).text)))""")
    pairs = pairs.withColumn("n", F.when(least == 0, F.lit(0)).otherwise(F.coalesce(differ, least)).cast("int"))
    left = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    return pairs.select(
        "pair_id", "chosen_id", "rejected_id", F.col("n").alias("prompt_turns"), _rendered(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        _rendered(left("c")).alias("chosen"), _rendered(left("r")).alias("rejected"),
        _mask(left("c")).alias("chosen_mask"), _mask(left("r")).alias("rejected_mask"))


#: DuckDB over ``conversations`` for neighbouring ids as pairs.
ORACLE = """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
size AS (SELECT pair_id, conv_id, count(*) AS n FROM t GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY n DESC, conv_id) AS k FROM size),
pair AS (
  SELECT pair_id, max(conv_id) FILTER (k = 1) AS chosen_id, max(conv_id) FILTER (k = 2) AS rejected_id,
         coalesce(min(n), 0) AS shorter, count(*) AS members FROM ranked GROUP BY pair_id),
differ AS (
  SELECT p.pair_id, min(a.pos) - 1 AS n
  FROM pair p JOIN t a ON a.conv_id = p.chosen_id JOIN t b ON b.conv_id = p.rejected_id AND b.pos = a.pos
  WHERE a.role <> b.role OR a.text <> b.text GROUP BY p.pair_id),
cut AS (
  SELECT p.*, CASE WHEN members = 1 THEN 0 ELSE coalesce(d.n, shorter) END AS n FROM pair p LEFT JOIN differ d USING (pair_id)),
piece AS (
  SELECT c.pair_id, t.conv_id = c.chosen_id AS is_chosen, t.pos <= c.n AS is_prompt, t.pos,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS body,
         (length(role) + 5) || ':0,' || (length(text) + 8) || CASE WHEN role = 'assistant' THEN ':1' ELSE ':0' END AS mask
  FROM cut c JOIN t USING (pair_id) WHERE t.conv_id IN (c.chosen_id, c.rejected_id))
SELECT c.pair_id, c.chosen_id, c.rejected_id, CAST(c.n AS INTEGER) AS prompt_turns,
  coalesce(string_agg(body, '' ORDER BY pos) FILTER (is_chosen AND is_prompt), '') AS prompt,
  coalesce(string_agg(body, '' ORDER BY pos) FILTER (is_chosen AND NOT is_prompt), '') AS chosen,
  coalesce(string_agg(body, '' ORDER BY pos) FILTER (NOT is_chosen AND NOT is_prompt), '') AS rejected,
  coalesce(string_agg(mask, ',' ORDER BY pos) FILTER (is_chosen AND NOT is_prompt), '') AS chosen_mask,
  coalesce(string_agg(mask, ',' ORDER BY pos) FILTER (NOT is_chosen AND NOT is_prompt), '') AS rejected_mask
FROM cut c JOIN piece USING (pair_id) GROUP BY ALL
"""
