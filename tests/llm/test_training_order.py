import glob
import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from lodestar.llm import training_order as order

from .common import awkward, frame, prose
from .test_packing import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 65_537])
def test_permutation_is_a_keyed_bijection(n):
    one, two = order.Permutation(n, "a"), order.Permutation(n, "b")
    slots = one.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (slots[n // 2:] == one.slots(np.arange(n // 2, n))).all()
    if n >= 1000:
        assert (slots != two.slots(np.arange(n))).mean() > 0.99
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.1


def test_round_trip(spark, scratch):
    rows = awkward() + [(30 + i, prose(i, 20 + 40 * i)) for i in range(20)]
    frame(spark, rows).repartition(5).write.parquet(f"{scratch}/docs")
    docs = spark.read.parquet(f"{scratch}/docs")
    got = order.materialise(docs, f"{scratch}/out", PATH, "seed", shard_rows=16).collect()
    want = []
    for i, t in rows:
        ids = brute(t)
        want += [(i is None, i or 0, n, len(ids[at:at + 512]), zlib.crc32(np.array(ids[at:at + 512], "<u2").tobytes()))
                 for n, at in enumerate(range(0, len(ids), 512))]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert sorted(r.slot for r in got) == list(range(len(got)))
    stride = 2 * order.LENGTH + 1
    for r in got:
        (file,) = glob.glob(f"{scratch}/out/shards/shard={r.shard}/part-*")  # one file a shard
        data = open(file, "rb").read()
        assert len(data) % stride == 0 and r.offset == (r.slot % 16) * stride
        record = order.read_shard(data, r.offset // stride)[0]
        assert zlib.crc32(record[:r.n_tokens].tobytes()) == r.ids_crc32 and not record[r.n_tokens:].any()
    (file,) = glob.glob(f"{scratch}/out/order/part-*.json")
    assert json.load(open(file))["sequences"] == len(got)


def test_empty_table(spark, scratch):
    frame(spark, []).write.parquet(f"{scratch}/docs")
    assert order.materialise(spark.read.parquet(f"{scratch}/docs"), f"{scratch}/out", PATH, "s").count() == 0
