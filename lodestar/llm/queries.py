"""Registered queries of this package: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestar.session import ensure_checkpoint_dir

from . import (chat, codes, decontamination, html, neardup, oracles, packing, quality, sharding, substring, suffixes, toxicity,
               training_order, whitening)

SHARD_BYTES = 32 << 20
DEEP_SHARD_BYTES = 16 << 10


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_sharding(spark, sf_dir):
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARD_BYTES)


def sharding_deep(spark, sf_dir):
    """Shards of at most 16 KB, which part the documents of every given scale at several depths."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), DEEP_SHARD_BYTES)


def op2_quality(spark, sf_dir):
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_decontamination(spark, sf_dir):
    return decontamination.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_minhash(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_substring(spark, sf_dir):
    return substring.substring_digest(_table(spark, sf_dir, "documents"))


def op6_chat(spark, sf_dir):
    """Neighbouring conversation ids (2k, 2k + 1) form a pair."""
    return chat.preference_pairs(_table(spark, sf_dir, "conversations"), F.floor(F.col("conv_id") / 2).cast("long"))


def op7_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", toxicity.held_out("doc_id"))


def op8_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer())


def op9_html(spark, sf_dir):
    return html.extract_text(_table(spark, sf_dir, "pages"))


def op10_training_order(spark, sf_dir):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/training-order-{uuid.uuid4().hex}"
    return training_order.materialise(_table(spark, sf_dir, "documents"), path, _tokenizer(), "epoch-0")


def op11_codes(spark, sf_dir):
    return codes.compress(_table(spark, sf_dir, "embeddings"))


def op12_suffixes(spark, sf_dir):
    return suffixes.suffix_digest(_table(spark, sf_dir, "documents"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_quality, op3_decontamination, op4_minhash, op5_substring, op6_chat, op7_toxicity, op8_packing,
    op9_html, op10_training_order, op11_codes, op12_suffixes, op13_whitening, sharding_deep)}

ORACLE_SQL: dict[str, str] = {
    "op1_sharding": oracles.sharding(SHARD_BYTES),
    "sharding_deep": oracles.sharding(DEEP_SHARD_BYTES),
    "op4_minhash": oracles.NEARDUP,
    "op5_substring": oracles.SUBSTRING,
    "op6_chat": chat.ORACLE,
    "op11_codes": oracles.CODES,
    "op12_suffixes": oracles.SUFFIXES,
}
