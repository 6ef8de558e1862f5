"""Keyed upsert into stored tables (F8, T12, T13) and its properties."""

import datetime
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestar.operators.upsert import DuplicateKeyError, merge_rows, upsert, upsert_partitioned
from lodestar.sources import store

SCHEMA = "order_id string, order_item_id int, amount int"


KEYS = ["order_id", "order_item_id"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def fresh():
    return f"t_{uuid.uuid4().hex[:12]}"


def test_f8_update_insert_keep(spark, scratch):
    t = spark.createDataFrame([("o1", 1, 10), ("o1", 2, 20)], SCHEMA)
    u = spark.createDataFrame([("o1", 2, 99), ("o2", 1, 7)], SCHEMA)
    name = fresh()
    upsert(t, name, KEYS, scratch)
    once = rows(upsert(u, name, KEYS, scratch))
    assert once == [("o1", 1, 10), ("o1", 2, 99), ("o2", 1, 7)]
    assert rows(upsert(u, name, KEYS, scratch)) == once
    assert sorted(store.numbers(spark, f"{name}__v")) == [1, 2, 3]


def test_duplicate_source_keys_raise_in_both_branches(spark, scratch):
    dup = spark.createDataFrame([("o1", 1, 1), ("o1", 1, 2)], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert(dup, fresh(), KEYS, scratch)
    name = fresh()
    upsert(spark.createDataFrame([("o9", 1, 1)], SCHEMA), name, KEYS, scratch)
    with pytest.raises(DuplicateKeyError):
        upsert(dup, name, KEYS, scratch)
    assert rows(spark.table(name)) == [("o9", 1, 1)]


def test_input_is_evaluated_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    u = spark.createDataFrame([("o1", 1, 1), ("o2", 1, 2)], SCHEMA).mapInArrow(count, SCHEMA)
    name = fresh()
    upsert(u, name, KEYS, scratch)
    assert seen.value == 2
    upsert(u, name, KEYS, scratch)
    assert seen.value == 4


def test_absent_columns_keep_their_values_and_types_must_agree(spark, scratch):
    name = fresh()
    upsert(spark.createDataFrame([("o1", 1, 10, "keep")], SCHEMA + ", note string"), name, KEYS, scratch)
    out = upsert(spark.createDataFrame([("o1", 1, 11), ("o2", 1, 5)], SCHEMA), name, KEYS, scratch)
    assert rows(out.select("order_id", "amount", F.coalesce("note", F.lit("-")))) == [("o1", 11, "keep"), ("o2", 5, "-")]
    with pytest.raises(TypeError):
        upsert(spark.createDataFrame([("o1", 1, "x")], "order_id string, order_item_id int, amount string"), name, KEYS, scratch)


def test_null_keys_never_match(spark):
    t = spark.createDataFrame([(None, 1, 1)], SCHEMA)
    u = spark.createDataFrame([(None, 1, 2)], SCHEMA)
    assert len(rows(merge_rows(t, u, ["order_id", "order_item_id"]))) == 2


def test_new_source_columns_become_null_in_old_rows(spark):
    t = spark.createDataFrame([("o1", 1, 10)], SCHEMA)
    u = spark.createDataFrame([("o2", 1, 5, "x")], SCHEMA + ", note string")
    out = {r["order_id"]: r for r in merge_rows(t, u, ["order_id", "order_item_id"]).collect()}
    assert out["o1"]["note"] is None and out["o2"]["note"] == "x"


keys = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=st.dictionaries(keys, st.integers(0, 9), max_size=6),
       updates=st.dictionaries(keys, st.integers(0, 9), max_size=6))
def test_merge_properties(spark, target, updates):
    t = spark.createDataFrame([(k[0], k[1], v) for k, v in target.items()], SCHEMA)
    u = spark.createDataFrame([(k[0], k[1], v) for k, v in updates.items()], SCHEMA)
    once = merge_rows(t, u, ["order_id", "order_item_id"])
    twice = merge_rows(once, u, ["order_id", "order_item_id"])
    expect = dict(target)
    expect.update(updates)
    assert rows(once) == sorted((k[0], k[1], v) for k, v in expect.items())
    assert rows(twice) == rows(once)


PSCHEMA = "order_id string, order_item_id int, month int, amount int"


def files(spark, name, value):
    return {r[0] for r in spark.table(name).where(f"month <=> {value}").select("_metadata.file_path").distinct().collect()}


def test_partitioned_upsert_rewrites_touched_only(spark, scratch):
    name = fresh()
    t = spark.createDataFrame([("o1", 1, 201801, 10), ("o2", 1, 201802, 20), ("o3", 1, 201803, 30)], PSCHEMA)
    upsert_partitioned(t, name, KEYS, "month", scratch)
    before = {m: files(spark, name, m) for m in (201802, 201803)}
    # o1 moves from 201801 to 201802 (201801 becomes empty); o4 is new in 201804.
    u = spark.createDataFrame([("o1", 1, 201802, 11), ("o4", 1, 201804, 40)], PSCHEMA)
    columns = ["order_id", "order_item_id", "month", "amount"]
    out = upsert_partitioned(u, name, KEYS, "month").select(columns)
    want = [("o1", 1, 201802, 11), ("o2", 1, 201802, 20), ("o3", 1, 201803, 30), ("o4", 1, 201804, 40)]
    assert rows(out) == want
    assert "month=201801" not in {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert files(spark, name, 201803) == before[201803]          # untouched: same files
    assert not files(spark, name, 201802) & before[201802]
    assert rows(upsert_partitioned(u, name, KEYS, "month").select(columns)) == want


def test_null_text_and_grown_partitions(spark, scratch):
    name = fresh()
    first = "order_id string, order_item_id int, amount int, month string"
    upsert_partitioned(spark.createDataFrame([("o1", 1, 1, "01"), ("o2", 1, 2, None), ("o3", 1, 3, "a'b")], first), name, KEYS, "month", scratch)
    out = upsert_partitioned(spark.createDataFrame([("o1", 1, 5, None, "n"), ("o4", 1, 4, "02", "n")], "order_id string, order_item_id int, amount int, month string, note string"),
                             name, KEYS, "month")
    got = {r.order_id: (r.amount, r.month, r.note) for r in out.collect()}
    assert got == {"o1": (5, None, "n"), "o2": (2, None, None), "o3": (3, "a'b", None), "o4": (4, "02", "n")}
    upsert_partitioned(spark.createDataFrame([("o1", 1, 5, "02"), ("o2", 1, 5, "02"), ("o3", 1, 5, "02")], first), name, KEYS, "month")
    assert {r.month for r in spark.table(name).collect()} == {"02"}
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"month=02"}


def test_date_partitions(spark, scratch):
    name, day = fresh(), datetime.date(2020, 1, 2)
    kind = "order_id string, order_item_id int, day date"
    upsert_partitioned(spark.createDataFrame([("o1", 1, day)], kind), name, KEYS, "day", scratch)
    upsert_partitioned(spark.createDataFrame([("o1", 1, datetime.date(2020, 1, 3))], kind), name, KEYS, "day")
    assert [r.day for r in spark.table(name).collect()] == [datetime.date(2020, 1, 3)]


def test_files_follow_data_not_tasks(spark, scratch):
    counts = []
    for tasks in (2, 16):
        name = fresh()
        df = spark.range(0, 400, 1, tasks).selectExpr("cast(id as string) order_id", "1 order_item_id", "cast(id % 8 as int) month")
        store.write_table(df, name, scratch, partition_by=["month"])
        bucketed = fresh()
        store.write_table(df, bucketed, scratch, bucket_by=["order_id"], buckets=4)
        counts.append([spark.table(x).select("_metadata.file_path").distinct().count() for x in (name, bucketed)])
    assert counts[0] == counts[1] and counts[1][1] == 4


def test_release_is_current_only_when_published(spark, scratch):
    r = store.Releases(spark, fresh(), scratch)
    assert r.current() is None
    with pytest.raises(LookupError):
        r.read("t")
    for value in (1, 2):
        n = r.begin()
        r.save(spark.range(value), "t", n)
        r.save(spark.range(value), "u", n)
        if value == 1:
            r.publish(n)
    assert r.current() == 1 and r.read("t").count() == r.read("u").count() == 1 and r.begin() == 3


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_first_load_with_repeated_keys_leaves_no_table(spark, scratch, partitioned):
    import os

    rows = spark.createDataFrame([("a", 1, 1), ("a", 1, 2)], "k string, v int, p int")
    name = f"first_load_{partitioned}"
    with pytest.raises(DuplicateKeyError):
        if partitioned:
            upsert_partitioned(rows, name, ["k", "v"], "p", scratch)
        else:
            upsert(rows, name, ["k", "v"], scratch)
    assert not spark.sql(f"SHOW TABLES LIKE '{name}*'").collect() and not os.listdir(scratch)


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_shuffle_files_go_with_the_step_that_made_them(spark, scratch):
    import time

    rows = spark.range(5000).selectExpr("cast(id as string) order_id", "1 order_item_id", "cast(id % 8 as int) month")
    before, name = shuffle_files(spark), fresh()
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    store.stage(rows.repartition(6, "order_id"))
    upsert(rows, name, KEYS, scratch)
    upsert(rows.where("month = 1"), name, KEYS, scratch)
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == kept


def test_lines_of_an_order_travel_together_and_match_by_their_number(spark):
    t = spark.createDataFrame([("hot", i, i) for i in range(300)] + [("b", None, 1), (None, 3, 1), ("c", -1, 1)], SCHEMA)
    u = spark.createDataFrame([("hot", i, -i) for i in range(150, 310)] + [("b", None, 2), (None, 3, 2), ("c", -1, 2), ("c", 63, 2)], SCHEMA)
    out = merge_rows(t, u, KEYS)
    want = [("hot", i, i) for i in range(150)] + [("b", None, 1), (None, 3, 1)] + [tuple(r) for r in u.collect()]
    assert sorted(map(str, rows_of(out))) == sorted(map(str, want))
    partial = merge_rows(t.withColumn("x_sk", F.lit("ab" * 32)), u, KEYS)
    assert {r.order_id for r in partial.where("x_sk is not null").collect()} == {"hot", "b", "c", None}
    assert partial.where("order_id = 'hot' and x_sk is null").count() == 10
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright(order_item_id" in plan and "LeftAnti" in plan


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_a_copy_can_go_before_its_run_ends(spark):
    with store.Staging(spark, "t") as staging:
        a, b = staging.put(spark.range(3), "a"), staging.put(spark.range(4), "b")
        staging.drop("a")
        assert b.count() == 4
        with pytest.raises(Exception):
            a.count()
