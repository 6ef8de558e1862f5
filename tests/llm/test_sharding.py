import pytest
from lodestar.llm import sharding

from .common import awkward, frame, prose


def check(rows, docs, limit):
    got = sharding.assign_shards(docs, limit).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode())) for i, t in rows)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    for name, members in shards.items():
        size = sum(r.n_bytes for r in members)
        assert {(r.shard_rows, r.shard_bytes) for r in members} == {(len(members), size)}
        assert all(r.fits == (size <= limit) for r in members)
        if size > limit:  # no bit can part them
            assert members[0].depth == 60
        if name:  # only oversized parents were split
            assert sum(r.n_bytes for r in got if r.shard.startswith(name[:-1])) > limit
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))


@pytest.mark.parametrize("limit", [300, 5_000, 10**9])
def test_shards_fit_and_only_oversized_buckets_split(spark, limit):
    rows = awkward() + [(100 + i, prose(i, 30)) for i in range(40)]
    check(rows, frame(spark, rows), limit)


def test_hot_key_and_empty_table(spark):
    rows = [(5, "abc")] * 50 + [(i, "abc") for i in range(50)]
    check(rows, frame(spark, rows), 40)
    assert sharding.assign_shards(frame(spark, []), 10).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(frame(spark, []), 0)


def test_written_shards_hold_all_rows(spark, scratch):
    docs = frame(spark, [(i, prose(i, 30)) for i in range(60)])
    sharding.write_shards(docs, f"{scratch}/out", 2_000)
    back = spark.read.parquet(f"{scratch}/out")
    assert sorted(r.doc_id for r in back.select("doc_id").collect()) == list(range(60))


def test_columns_of_the_same_names_are_kept(spark, scratch):
    docs = frame(spark, [(i, prose(i, 30)) for i in range(40)] + [(None, "x"), (7, "again")])
    for name in ("shard", "_key", "_row", "_own"):
        docs = docs.withColumn(name, docs["doc_id"] * 2)
    directory = sharding.write_shards(docs, f"{scratch}/out", 2_000)
    back = spark.read.parquet(f"{scratch}/out")
    assert "shard_" in back.columns and directory.columns == ["shard", "shard_rows", "shard_bytes"]
    assert sorted(map(str, back.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert {r["shard_"] for r in back.select("shard_").distinct().collect()} == {r.shard for r in directory.collect()}


def test_cells_are_never_broadcast(spark):
    plan = sharding.assign_shards(frame(spark, [(i, prose(i, 30)) for i in range(60)]), 2_000)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
