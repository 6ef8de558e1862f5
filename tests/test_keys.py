"""Packed keys come back as they were, and take half the space of a digest."""

from pyspark.sql import functions as F

from lodestar.functions.keys import pack_keys, packed, unpack_keys
from lodestar.operators.layout import cluster_by
from lodestar.operators.upsert import merge_rows

DIGEST = "0a" * 32
TEXTS = [DIGEST, DIGEST.upper(), DIGEST[:-1], "", "\0", "é 1", None, DIGEST + "\n", "\x01" + DIGEST[:31]]


def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, a_sk string").withColumn("b_sk", F.col("id"))


def test_texts_come_back(spark):
    df = frame(spark)
    kept = pack_keys(df)
    assert dict(kept.dtypes) == {"id": "int", "a_sk": "binary", "b_sk": "int"}
    assert unpack_keys(kept, df).collect() == df.collect()
    assert [len(r[0]) for r in kept.where("id < 2").orderBy("id").select("a_sk").collect()] == [33, 65]
    assert df.select(packed(F.col("a_sk")).alias("p")).distinct().count() == len(TEXTS)


def test_layout_and_merge_shuffle_packed_keys(spark):
    df = frame(spark)
    for out in (cluster_by(df, ["a_sk"], 3), cluster_by(df, ["a_sk", "id"], 3), merge_rows(df, df.where("id = 1"), ["a_sk"])):
        assert out.schema == df.schema and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    plan = cluster_by(df, ["a_sk", "id"], 3)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "unhex" in below and "hex(" in plan[:plan.index("RepartitionByExpression")]
