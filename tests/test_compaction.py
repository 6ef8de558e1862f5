"""Compaction merges small files, leaves large ones, and survives a crash at any step."""

import os

import pytest
from pyspark.sql import functions as F

from lodestar.operators import compaction
from lodestar.plans import registry


def stored(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and "_compaction" not in d)


def make(spark, path, partitioned=False):
    small = spark.range(0, 900, 1, 9).selectExpr("id", "cast(id % 2 as int) m", "if(id % 7 = 0, null, id) v")
    large = spark.range(1000, 200_000, 1, 1).selectExpr("id", "0 m", "id * 7919 % 100003 v")
    for df in (large, small):
        writer = df.write.mode("append")
        (writer.partitionBy("m") if partitioned else writer).parquet(path)
    return sorted(spark.read.parquet(path).select("id", "m", "v").collect(), key=lambda r: r.id)


@pytest.mark.parametrize("partitioned", [False, True])
def test_small_files_are_merged_and_large_ones_stay(spark, scratch, partitioned):
    path = f"{scratch}/t a"
    want = make(spark, path, partitioned)
    before = stored(path)
    large = [f for f in before if os.path.getsize(f) > 100_000]
    done = compaction.compact(spark, path, 200_000)
    after = stored(path)
    assert (done.files_before, done.files_after) == (len(before), len(after))
    assert set(large) <= set(after) and len(after) == len(large) + (2 if partitioned else 1)
    assert sorted(spark.read.parquet(path).select("id", "m", "v").collect(), key=lambda r: r.id) == want
    again = compaction.compact(spark, path, 200_000)
    assert again.rewritten == 0 and stored(path) == after


def test_bins_hold_about_the_target(spark):
    files = spark.createDataFrame([(f"file:/t/{i:03d}.parquet", 10 + i % 5) for i in range(100)] + [("file:/t/z.parquet", 99), ("file:/u/1.parquet", 3)],
                                  "file string, size long")
    found = compaction.bins(files, 100).join(files, "file").groupBy("bin").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in found) == 100 and all(r.s <= 114 and r.n > 1 for r in found) and sorted(r.bin for r in found) == list(range(len(found)))


def test_the_last_small_file_is_not_left_over(spark):
    files = spark.createDataFrame([("file:/t/1.parquet", 60), ("file:/t/2.parquet", 60), ("file:/t/3.parquet", 60), ("file:/u/1.parquet", 60)],
                                  "file string, size long")
    assert sorted((r.file[-11:], r.bin) for r in compaction.bins(files, 100).collect()) == [("t/1.parquet", 0), ("t/2.parquet", 0), ("t/3.parquet", 0)]


def star_tables(spark, path, orders):
    """Orders of two lines each, one in three with a key that 3 divides."""
    spark.range(1).selectExpr("0 n_nationkey", "'x' n_name").write.parquet(f"{path}/nation.parquet")
    spark.range(50).selectExpr("id c_custkey", "0 c_nationkey", "'a' c_mktsegment").write.parquet(f"{path}/customer.parquet")
    spark.range(20).selectExpr("id p_partkey", "'LARGE' p_type", "'n' p_name", "'b' p_brand", "1 p_size").write.parquet(f"{path}/part.parquet")
    spark.range(orders).selectExpr("id o_orderkey", "id % 50 o_custkey", "'O' o_orderstatus", "date'1997-03-01' + cast(id % 90 as int) o_orderdate") \
        .write.parquet(f"{path}/orders.parquet")
    spark.range(2 * orders).selectExpr("id div 2 l_orderkey", "cast(id % 2 as int) l_linenumber", "id * 7 % 20 l_partkey", "id % 5 l_suppkey",
                                       "cast(id % 100 as double) l_extendedprice", "0.05D l_tax", "0.1D l_discount").write.parquet(f"{path}/lineitem.parquet")


@pytest.mark.parametrize("orders", [600, 3000])
def test_no_file_of_the_query_grows_with_the_fact(spark, scratch, monkeypatch, orders):
    star_tables(spark, scratch, orders)
    monkeypatch.setattr(registry, "FOLDER_LINES", 1500, raising=False)
    real, tables = compaction.compact, []
    monkeypatch.setattr(compaction, "compact", lambda spark, path, target: tables.append(path) or real(spark, path, target))
    got = [tuple(r) for r in registry.QUERIES["compaction"](spark, scratch).collect()]
    assert got == [(2 * orders, sum(i % 100 for i in range(2 * orders)), 26, 24, True, True)]
    rows = spark.read.parquet(tables[0])
    files = rows.groupBy(F.col("_metadata.file_path").alias("file_path")).count().collect()
    assert len({os.path.dirname(r.file_path) for r in files}) == -(-2 * orders // 1500) and max(r["count"] for r in files) <= 750
    keys = [(r.order_id, r.order_item_id) for r in rows.collect()]
    assert sorted(keys) == sorted((str(i // 2), i % 2) for i in range(2 * orders))


def test_files_of_different_columns(spark, scratch):
    path = f"{scratch}/t"
    spark.range(3).coalesce(1).write.mode("append").parquet(path)
    spark.range(3, 6).selectExpr("id", "'x' AS note").coalesce(1).write.mode("append").parquet(path)
    compaction.compact(spark, path)
    assert len(stored(path)) == 1
    assert sorted((r.id, r.note) for r in spark.read.parquet(path).collect()) == [(0, None), (1, None), (2, None), (3, "x"), (4, "x"), (5, "x")]


@pytest.mark.parametrize("step", ["before", "after delete"])
def test_a_crash_is_completed_or_undone(spark, scratch, monkeypatch, step):
    path = f"{scratch}/t"
    want, before = make(spark, path), stored(path)
    real, calls = compaction.finish, []

    def crash(spark, path):
        calls.append(1)
        if len(calls) == 1:
            return
        if step == "after delete":  # some packed files are gone already
            for r in spark.read.parquet(f"{path}/_compaction/plan").limit(3).collect():
                os.remove(r.file.replace("file:", ""))
        raise OSError("driver lost")

    monkeypatch.setattr(compaction, "finish", crash)
    with pytest.raises(OSError):
        compaction.compact(spark, path, 200_000)
    monkeypatch.setattr(compaction, "finish", real)
    if step == "before":  # the new files are hidden until they are in place
        assert stored(path) == before and spark.read.parquet(path).count() == len(want)
    compaction.finish(spark, path)
    assert sorted(spark.read.parquet(path).select("id", "m", "v").collect(), key=lambda r: r.id) == want
    assert len(stored(path)) == 2 and not os.path.exists(f"{path}/_compaction")


def test_an_uncommitted_compaction_is_undone(spark, scratch):
    path = f"{scratch}/t"
    want, before = make(spark, path), stored(path)
    os.makedirs(f"{path}/_compaction/files/__bin=0")
    compaction.finish(spark, path)
    assert stored(path) == before and spark.read.parquet(path).count() == len(want)
    assert not os.path.exists(f"{path}/_compaction")
