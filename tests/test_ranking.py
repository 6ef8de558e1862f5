"""Scale-out ranking equals the single-window ranking."""

import random
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators.ranking import rank_globally


def rank_in_one_window(df, value, tiebreak):
    """The plain SQL form."""
    v, t = F.col(value), F.col(tiebreak)
    return df.withColumns({"ntile": F.ntile(10).over(Window.orderBy(v.desc(), t.asc())),
                           "dense_rank": F.dense_rank().over(Window.orderBy(v.desc()))})


def _both(spark, values, parts):
    df = spark.createDataFrame([(f"k{i:04d}", v) for i, v in enumerate(values)], "k string, v decimal(18,2)")
    a = {r["k"]: (r["ntile"], r["dense_rank"]) for r in rank_globally(df, "v", "k", num_partitions=parts).collect()}
    b = {r["k"]: (r["ntile"], r["dense_rank"]) for r in rank_in_one_window(df, "v", "k").collect()}
    return a, b


def test_many_ties_across_ranges(spark):
    rnd = random.Random(7)
    values = [Decimal(rnd.choice([1, 2, 2, 2, 3, 5, 8])) for _ in range(997)]
    a, b = _both(spark, values, 16)
    assert a == b


def test_one_hot_value(spark):
    values = [Decimal(5)] * 400 + [Decimal(i) for i in range(1, 30)]
    a, b = _both(spark, values, 8)
    assert a == b


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-3, 6), min_size=0, max_size=60), st.integers(1, 9))
def test_property_equal_to_window(spark, ints, parts):
    a, b = _both(spark, [Decimal(i) for i in ints], parts)
    assert a == b


def test_fewer_rows_than_tiles(spark):
    a, b = _both(spark, [Decimal(3), Decimal(1), Decimal(2)], 4)
    assert a == b and sorted(t for t, _ in a.values()) == [1, 2, 3]


def _numbers(spark, rows, parts):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from lodestar.operators.ranking import number_within_groups
    df = spark.createDataFrame(rows, "g int, o int, x string")
    a = {(r["g"], r["o"], r["x"]): r["row_in_group"]
         for r in number_within_groups(df, ["g"], ["o", "x"], num_partitions=parts).collect()}
    w = Window.partitionBy("g").orderBy("o", "x")
    b = {(r["g"], r["o"], r["x"]): r["n"] for r in df.withColumn("n", F.row_number().over(w)).collect()}
    return a, b


def test_numbering_hot_group_spans_ranges(spark):
    rows = [(1, i, f"v{i}") for i in range(300)] + [(g, i, "w") for g in range(2, 40) for i in range(3)]
    rows += [(None, 1, "n"), (None, 2, "n")]
    a, b = _numbers(spark, rows, 8)
    assert a == b


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50)), min_size=0, max_size=80, unique=True),
       st.integers(1, 7))
def test_numbering_property(spark, pairs, parts):
    a, b = _numbers(spark, [(g, o, "x") for g, o in pairs], parts)
    assert a == b


def test_cost_of_a_row_does_not_grow_with_the_ranges(spark, tmp_path):
    """Beside what 1,000 tasks take by themselves, 1,000 ranges take at most twice the time of 8."""
    import time

    from lodestar.operators.ranking import number_within_groups

    def stored(n):
        path = f"{tmp_path}/{n}"
        spark.range(n).select((F.xxhash64("id") % 250_000).alias("v"), F.col("id").alias("k")).write.parquet(path)
        return spark.read.parquet(path)

    few_rows, rows = stored(1000), stored(1_000_000)

    def seconds(df, ranges, make):
        start = time.perf_counter()
        make(df, ranges).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for make in (lambda df, n: rank_globally(df, "v", "k", num_partitions=n),
                 lambda df, n: number_within_groups(df, ["v"], ["k"], num_partitions=n)):
        seconds(rows, 8, make)
        seconds(few_rows, 1000, make)
        tasks = min(seconds(few_rows, 1000, make), seconds(few_rows, 1000, make))
        few = min(seconds(rows, 8, make), seconds(rows, 8, make))
        assert min(seconds(rows, 1000, make), seconds(rows, 1000, make)) - tasks <= 2 * few + 1


def test_numbering_sorts_the_dealt_rows_once(spark):
    from lodestar.operators.ranking import number_within_groups
    rows = [(None, i, "n") for i in range(400)] + [(g, i, None) for g in range(30) for i in range(4)] + [(7, 1, "x")] * 3
    df = spark.createDataFrame(rows, "g int, o int, x string")
    out = number_within_groups(df, ["g"], ["o", "x"], num_partitions=8)
    wide = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [row_number" in x or "Window [rank" in x]
    assert len(wide) == 1, wide
    want = df.withColumn("row_in_group", F.row_number().over(Window.partitionBy("g").orderBy("o", "x")))
    assert sorted(map(str, out.select(want.columns).collect())) == sorted(map(str, want.collect()))
