"""CSV ingest with declared vs inferred schema (F6/T8), schema evolution, JSON rows."""

import json
import uuid

import pytest

from pyspark.sql import functions as F

from lodestar.functions.json import rows_as_json
from lodestar.sources import schemas
from lodestar.sources.csv import MissingColumnError, ingest_csv, ingest_manifest, read_csv
from lodestar.sources.sinks import list_tables, overwrite_evolving, publish_views


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_zip_keeps_leading_zero(spark, scratch):
    p = f"{scratch}/customers.csv"
    _write(p, "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
              "c1,u1,01310,sao paulo,SP\nc2,u2,,rio,\n")
    declared = {r["customer_id"]: r for r in read_csv(spark, p, schemas.CUSTOMERS).collect()}
    assert declared["c1"]["customer_zip_code_prefix"] == "01310"
    assert declared["c2"]["customer_zip_code_prefix"] is None
    inferred = read_csv(spark, p, infer=True)
    assert inferred.where("customer_id = 'c1'").first()["customer_zip_code_prefix"] == 1310
    stamped = ingest_csv(spark, p, schemas.CUSTOMERS, as_of="2024-01-01 00:00:00")
    assert "_load_timestamp" in stamped.columns


def test_manifest_and_schema_evolution(spark, scratch):
    src = f"{scratch}/raw"
    import os
    os.makedirs(src)
    _write(f"{src}/t.csv", "a,b\n1,x\n")
    manifest = {"t.csv": ("bronze_t", "a int, b string")}
    from pyspark.sql.types import _parse_datatype_string
    manifest = {k: (t, _parse_datatype_string(s)) for k, (t, s) in manifest.items()}
    prefix = f"t_{uuid.uuid4().hex[:8]}_"
    (name,) = ingest_manifest(spark, src, prefix, manifest, path=scratch)
    assert name == prefix + "bronze_t" and spark.table(name).count() == 1
    # New load without column b: b is kept, as a typed null.
    overwrite_evolving(spark.createDataFrame([(2,)], "a int"), name, scratch)
    back = spark.table(name)
    assert set(back.columns) == {"a", "b", "_load_timestamp"}
    assert back.first()["b"] is None and back.first()["a"] == 2
    with pytest.raises(TypeError):
        overwrite_evolving(spark.createDataFrame([("2",)], "a string"), name, scratch)


def test_csv_columns_by_header_name(spark, scratch):
    p = f"{scratch}/items.csv"
    _write(p, "freight_value,order_id,shipping_limit_date,order_item_id,product_id,seller_id,price\n"
              "1.25,o1,2018-01-02,1,p1,s1,58.90\nbad,o2,,x,p2,s2,\n")
    rows = {r["order_id"]: r for r in read_csv(spark, p, schemas.ORDER_ITEMS).collect()}
    assert str(rows["o1"]["price"]) == "58.90" and str(rows["o1"]["freight_value"]) == "1.2500"
    assert rows["o1"]["shipping_limit_date"] == "2018-01-02" and rows["o1"]["order_item_id"] == 1
    assert rows["o2"]["price"] is None and rows["o2"]["freight_value"] is None and rows["o2"]["order_item_id"] is None
    _write(f"{scratch}/short.csv", "order_id,price\no1,2\n")
    with pytest.raises(MissingColumnError):
        read_csv(spark, f"{scratch}/short.csv", schemas.ORDER_ITEMS)


def test_rows_as_json_keeps_nulls_and_text_types(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string") \
        .withColumn("d", F.to_date(F.lit("2020-01-02"))).withColumn("m", F.lit(1.5).cast("decimal(18,2)"))
    obj = json.loads(rows_as_json(df).first()["json"])
    assert obj == {"a": 1, "b": None, "d": "2020-01-02", "m": "1.50"}


def test_publish_and_list(spark):
    publish_views(spark, {"one": spark.range(1)}, prefix="lodestar_test_")
    names = [r["tableName"] for r in list_tables(spark).collect()]
    assert "lodestar_test_one" in names


def test_bucketed_publish_avoids_order_shuffle(spark):
    import contextlib
    import io

    from lodestar.sources.sinks import save_bucketed
    df = spark.createDataFrame([(f"o{i % 50}", i % 7, i) for i in range(500)], "order_id string, m int, v int")
    save_bucketed(df, "lodestar_test_bucketed", ["order_id"], 4)
    second = save_bucketed(df, "lodestar_test_bucketed", ["order_id"], 4)
    assert second.endswith("__v2")
    t = spark.table("lodestar_test_bucketed")
    q = t.groupBy("m").agg(F.count_distinct("order_id").alias("n"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    assert buf.getvalue().count("Exchange (") == 1   # only the final (m) exchange
    assert sum(r["n"] for r in q.collect()) == sum(
        r["n"] for r in df.groupBy("m").agg(F.count_distinct("order_id").alias("n")).collect())


def _put(folder, name, text):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_files_keep_their_own_headers(spark, scratch):
    from lodestar.sources.csv import MissingColumnError, headers, read_csv, rejected
    from pyspark.sql.types import DecimalType, StringType, StructField, StructType
    kinds = StructType([StructField("order_id", StringType()), StructField("price", DecimalType(18, 2))])
    folder = f"{scratch}/two heads"
    _put(folder, "a.csv", "order_id,price\no1,10.00\no2,\"1,5\"\n")
    _put(folder, "b.csv", "price,order_id,\"a note, quoted\"\n20.00,o3,x\n30.00\n40.00,o5,y,z\n")
    _put(folder, "c.csv", "")
    assert {k: len(v) for k, v in headers(spark, folder).items()} == {("order_id", "price"): 1, ("price", "order_id", "a note, quoted"): 1}
    got = {(r.order_id, None if r.price is None else float(r.price), r["a note, quoted"]) for r in read_csv(spark, folder, kinds).collect()}
    assert got == {("o1", 10.0, None), ("o2", None, None), ("o3", 20.0, "x"), (None, 30.0, None), ("o5", 40.0, "y")}
    bad = sorted((r.source_file.rpartition("/")[2], r.column_name or "", r.cell) for r in rejected(spark, folder, kinds).collect())
    assert bad == [("a.csv", "price", "1,5"), ("b.csv", "", "30.00"), ("b.csv", "", "40.00,o5,y,z")]
    _put(folder, "d.csv", "order_id\no9\n")
    with pytest.raises(MissingColumnError, match="d.csv"):
        read_csv(spark, folder, kinds)
    _put(f"{scratch}/twice", "a.csv", "x,x\n1,2\n")
    with pytest.raises(ValueError):
        headers(spark, f"{scratch}/twice")
    _put(f"{scratch}/none", "a.csv", "")
    with pytest.raises(MissingColumnError):
        read_csv(spark, f"{scratch}/none")
