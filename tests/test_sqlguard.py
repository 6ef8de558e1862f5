"""Guarded read-only SQL."""

import pytest

from lodestar.plans.sqlguard import UnsafeSQLError, check_read_only, read_only_sql


@pytest.fixture(scope="module")
def view(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string").createOrReplaceTempView("guard_t")
    return "guard_t"


@pytest.mark.parametrize("q", [
    "SELECT * FROM guard_t",
    "WITH x AS (SELECT id FROM guard_t) SELECT * FROM x",
    "SELECT id FROM guard_t;",
    "/* note */ SELECT id FROM guard_t",
    "SELECT 1 AS a, 2 AS a",
    "SHOW TABLES",
    "/* note */ -- more\n SHOW TABLES",
    "EXPLAIN SELECT id FROM guard_t",
    "EXPLAIN FORMATTED /* c */ SELECT id FROM guard_t",
    "SELECT 'use reflect(x) or TRANSFORM' AS s",
])
def test_accepted(spark, view, q):
    check_read_only(spark, q)


@pytest.mark.parametrize("q", [
    "WITH x AS (SELECT 1 AS id) INSERT INTO guard_t SELECT id, 'z' FROM x",
    "/* c */ INSERT INTO guard_t VALUES (3, 'c')",
    "FROM guard_t INSERT INTO guard_t SELECT *",
    "DROP VIEW guard_t",
    "SELECT 1; DROP VIEW guard_t",
    "SET spark.sql.shuffle.partitions=1",
    "",
    "   ",
    "SELECT reflect('java.lang.System', 'getenv', 'HOME')",
    "SELECT java_method('java.lang.System', 'getenv', 'HOME')",
    "SELECT try_reflect('java.lang.System', 'getenv', 'HOME')",
    "SELECT TRANSFORM(1) USING 'cat' AS (x)",
    "SELECT " + ", ".join(f"id AS c{i}" for i in range(60)) + ", `reflect`('java.lang.System', 'getenv', 'HOME') FROM guard_t",
    "SELECT id FROM guard_t WHERE name = (SELECT `java_method`/* */('java.lang.System', 'getenv', 'HOME'))",
    "WITH x AS (SELECT TRANSFORM(id) USING 'cat' AS (y) FROM guard_t) SELECT * FROM x",
    "EXPLAIN DROP VIEW guard_t",
    "-- only a comment",
])
def test_refused(spark, view, q):
    with pytest.raises(UnsafeSQLError):
        check_read_only(spark, q)
    assert spark.table("guard_t").count() == 2


def test_runs_with_limit(spark, view):
    assert read_only_sql(spark, "SELECT * FROM guard_t ORDER BY id", limit=1).collect()[0]["id"] == 1


def test_relations_are_checked(spark, scratch):
    from lodestar.plans.sqlguard import UnsafeSQLError, read_only_sql, relations
    spark.range(3).write.parquet(f"{scratch}/f")
    spark.range(5).createOrReplaceTempView("rel_open")
    spark.range(7).createOrReplaceTempView("rel_shut")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW rel_inner AS SELECT * FROM rel_shut")
    ok = ["SELECT * FROM rel_open", "WITH rel_shut AS (SELECT 1 AS id) SELECT * FROM rel_shut", "SELECT * FROM VALUES (1), (2)",
          "SELECT id FROM REL_OPEN WHERE id IN (SELECT id FROM rel_open)", "SELECT * FROM range(4)", "SELECT * FROM rel_inner"]
    for text in ok:
        read_only_sql(spark, text, published=["rel_open", "rel_inner"]).collect()
    for text in ["SELECT * FROM rel_shut", "SELECT (SELECT max(id) FROM rel_shut)", "EXPLAIN SELECT * FROM rel_shut",
                 "SELECT * FROM rel_open WHERE EXISTS (SELECT 1 FROM rel_open o WHERE o.id IN (SELECT id FROM rel_shut))",
                 f"SELECT * FROM parquet.`{scratch}/f`"]:
        with pytest.raises(UnsafeSQLError):
            read_only_sql(spark, text, published=["rel_open", "rel_inner"])
    with pytest.raises(UnsafeSQLError):  # without a list as well: files are not tables
        read_only_sql(spark, f"SELECT * FROM text.`{scratch}/f`")
    assert read_only_sql(spark, "SELECT * FROM rel_shut").count() == 7
    spark.range(2).write.mode("overwrite").option("path", f"{scratch}/cat").saveAsTable("rel_table")
    assert relations(spark, "SELECT * FROM default.rel_table t JOIN rel_open USING (id)") == {"rel_table", "rel_open"}
