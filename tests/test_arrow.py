from __future__ import annotations

import datetime as dt
import glob
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.fixtures import people
from tessera.functions import payloads
from tessera.operators import batches
from tessera.schemas import PERSON, PERSON_COLUMNS, TYPE_NAME_KEY, register_type
from tessera.sources import arrow_ipc, versions
from tessera.sources.arrow_types import to_arrow_schema, to_spark_schema

SF = "/root/testdata/sf0.001"


def _files(path, ext="*"):
    return sorted(glob.glob(f"{path}/{ext}"))


def _open(f):
    data = open(f, "rb").read()
    return arrow_ipc.decode_ipc(data)


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_schema_mapping_roundtrip():
    s = T.StructType([T.StructField("a", T.LongType(), False, {"k": "v"}),
                      T.StructField("p", PERSON, True),
                      T.StructField("v", T.ArrayType(T.FloatType()), True),
                      T.StructField("m", T.MapType(T.StringType(), T.DoubleType()), True)])
    back = to_spark_schema(to_arrow_schema(s))
    assert back == s


def test_stream_and_file_flavours_are_real_ipc(spark, tmp_dir):
    p = people(spark, SF)
    for flavor, ext, magic in (("stream", "*.arrows", False), ("file", "*.arrow", True)):
        path = f"{tmp_dir}/{flavor}"
        p.repartition(2).write.format("arrow_ipc").mode("overwrite").option("flavor", flavor).save(path)
        files = _files(path, ext)
        assert len(files) == 2
        head = open(files[0], "rb").read(6)
        assert (head == b"ARROW1") is magic
        r = _open(files[0])
        assert r.schema.field("TermDate").type == pa.timestamp("us")
        assert r.schema.field("StartDate").type == pa.date32()
        assert _same(spark.read.format("arrow_ipc").load(path), p)


@pytest.mark.parametrize("codec", ["zstd", "lz4"])
def test_compression(spark, tmp_dir, codec):
    p = people(spark, SF)
    p.write.format("arrow_ipc").mode("overwrite").option("compression", codec) \
        .option("flavor", "file").save(tmp_dir)
    f = _files(tmp_dir, "*.arrow")[0]
    plain = f"{tmp_dir}-plain"
    p.write.format("arrow_ipc").mode("overwrite").option("flavor", "file").save(plain)
    import os
    assert os.path.getsize(f) < os.path.getsize(_files(plain, "*.arrow")[0])
    assert _same(spark.read.format("arrow_ipc").load(tmp_dir), p)


@pytest.mark.parametrize("n", [1, 1499, 1500, 1501, 400])
def test_batch_sizes_exact(spark, tmp_dir, n):
    """Batches of exactly n rows, the last one short, whatever the tasks."""
    p = people(spark, SF)
    b = batches.fixed_size_batches(p, "id", n)
    laid = b.repartition(3, "batch").sortWithinPartitions("batch", "id")
    laid.write.format("arrow_ipc").mode("overwrite").option("batch", str(n)) \
        .option("batchColumn", "batch").save(tmp_dir)
    sizes = [r["rows"] for r in spark.read.format("arrow_ipc").option("content", "batches")
             .load(tmp_dir).collect()]
    full, rest = divmod(1500, n)
    assert sorted(sizes) == sorted([n] * full + ([rest] if rest else []))
    back = spark.read.format("arrow_ipc").load(tmp_dir)
    assert back.columns == PERSON_COLUMNS          # the batch column is not written
    assert _same(back, p)


def test_append_adds_files_and_overwrite_replaces(spark, tmp_dir):
    p = people(spark, SF)
    p.coalesce(1).write.format("arrow_ipc").mode("append").save(tmp_dir)
    p.coalesce(1).write.format("arrow_ipc").mode("append").save(tmp_dir)
    assert len(_files(tmp_dir, "*.arrows")) == 2
    assert spark.read.format("arrow_ipc").load(tmp_dir).count() == 3000
    p.coalesce(1).write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    assert spark.read.format("arrow_ipc").load(tmp_dir).count() == 1500
    # The replaced files serve the older versions until these expire.
    assert spark.read.format("arrow_ipc").option("version", "2").load(tmp_dir).count() == 3000
    assert versions.expire(tmp_dir) == 0 and versions.expire(tmp_dir, min_age_hours=0) == 2
    assert len(_files(tmp_dir, "*.arrows")) == 1
    assert spark.read.format("arrow_ipc").load(tmp_dir).count() == 1500
    with pytest.raises(Exception, match="no version 2"):
        spark.read.format("arrow_ipc").option("version", "2").load(tmp_dir).count()


def test_named_struct_and_raw_struct(spark, tmp_dir):
    p = people(spark, SF)
    persons = p.select(F.struct(*PERSON_COLUMNS).alias("persons")) \
        .withMetadata("persons", {TYPE_NAME_KEY: "Person"})
    persons.write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    field = _open(_files(tmp_dir, "*.arrows")[0]).schema.field("persons")
    assert field.metadata[TYPE_NAME_KEY.encode()] == b"Person"
    typed = spark.read.format("arrow_ipc").load(tmp_dir)
    assert typed.schema["persons"].dataType == PERSON
    raw = spark.read.format("arrow_ipc").option("convert", "false").load(tmp_dir)
    assert all(f.nullable for f in raw.schema["persons"].dataType.fields)
    assert _same(typed.select("persons.*"), p)
    assert typed.select("persons").first()["persons"]["id"] is not None


def test_named_struct_required_field_enforced(spark, tmp_dir):
    rows = [(1, "a", "b", None, 1.0, dt.date(2020, 1, 1), None),
            (2, "c", "d", 5, None, None, None)]
    df = spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PERSON))
    persons = df.select(F.struct(*PERSON_COLUMNS).alias("persons")) \
        .withMetadata("persons", {TYPE_NAME_KEY: "Person"})
    persons.write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    with pytest.raises(Exception, match="required field StartDate"):
        spark.read.format("arrow_ipc").load(tmp_dir).collect()
    assert spark.read.format("arrow_ipc").option("convert", "false").load(tmp_dir).count() == 2


def test_incompatible_named_type_is_refused(spark, tmp_dir):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    df.select(F.struct("a", "b").alias("s")).withMetadata("s", {TYPE_NAME_KEY: "Person"}) \
        .write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    with pytest.raises(Exception, match="not record type"):
        spark.read.format("arrow_ipc").load(tmp_dir).schema


def test_runtime_registered_type_travels_with_read(spark, tmp_dir):
    t = register_type("Pair", T.StructType([T.StructField("a", T.LongType(), False),
                                            T.StructField("b", T.StringType(), True)]))
    df = spark.createDataFrame([(1, "x"), (2, None)], "a bigint, b string")
    df.select(F.struct("a", "b").alias("s")).withMetadata("s", {TYPE_NAME_KEY: "Pair"}) \
        .write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    assert arrow_ipc.read(spark, tmp_dir).schema["s"].dataType == t


def test_metadata_table_and_columns(spark, tmp_dir):
    p = people(spark, SF).withMetadata("Wage", {"unit": "per hour"})
    p.coalesce(1).write.format("arrow_ipc").mode("overwrite") \
        .option("metadata", json.dumps({"Source": "orders"})).save(tmp_dir)
    s = _open(_files(tmp_dir, "*.arrows")[0]).schema
    assert s.metadata[b"Source"] == b"orders"
    assert s.field("Wage").metadata[b"unit"] == b"per hour"
    rows = {(r["scope"], r["key"]): r["value"] for r in
            spark.read.format("arrow_ipc").option("content", "metadata").load(tmp_dir).collect()}
    assert rows == {("", "Source"): "orders", ("Wage", "unit"): "per hour"}
    # Column metadata also comes back on the schema of a normal read, and
    # survives Parquet.
    assert spark.read.format("arrow_ipc").load(tmp_dir).schema["Wage"].metadata == {"unit": "per hour"}
    p.write.mode("overwrite").parquet(f"{tmp_dir}-pq")
    assert spark.read.parquet(f"{tmp_dir}-pq").schema["Wage"].metadata == {"unit": "per hour"}


def test_column_projection_option(spark, tmp_dir):
    people(spark, SF).write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    df = spark.read.format("arrow_ipc").option("columns", "Wage,id").load(tmp_dir)
    assert df.columns == ["Wage", "id"] and df.count() == 1500


def test_large_file_split_by_batches(spark, tmp_dir):
    p = people(spark, SF)
    p.coalesce(1).write.format("arrow_ipc").mode("overwrite").option("flavor", "file") \
        .option("batch", "100").save(tmp_dir)
    df = spark.read.format("arrow_ipc").option("splitBytes", "1").option("batchesPerSplit", "4") \
        .load(tmp_dir)
    assert df.rdd.getNumPartitions() == 4          # 15 batches, 4 per split
    assert _same(df, p)


def test_payload_encode_decode(spark):
    p = people(spark, SF)
    b = batches.fixed_size_batches(p, "id", 400)
    enc = payloads.encode_payloads(b)
    rows = enc.collect()
    assert sorted(r["n"] for r in rows) == [300, 400, 400, 400]
    data = rows[0]["payload"]
    t = pa.ipc.open_stream(pa.py_buffer(data)).read_all()
    assert t.num_rows == rows[0]["n"] and t.column_names == PERSON_COLUMNS
    assert _same(payloads.decode_payloads(enc, PERSON), p)
    per_task = payloads.encode_payloads_per_task(p)
    assert per_task.agg(F.sum("n")).first()[0] == 1500
    assert _same(payloads.decode_payloads(per_task, PERSON), p)


def test_empty_and_one_row_tables(spark, tmp_dir):
    p = people(spark, SF)
    empty = p.where(F.lit(False))
    empty.write.format("arrow_ipc").mode("overwrite").save(f"{tmp_dir}/e")
    one = p.where(F.col("id") == 3)
    one.write.format("arrow_ipc").mode("overwrite").save(f"{tmp_dir}/o")
    assert _same(spark.read.format("arrow_ipc").load(f"{tmp_dir}/o"), one)
    # An empty write keeps the schema, also when it overwrites rows.
    back = spark.read.format("arrow_ipc").load(f"{tmp_dir}/e")
    assert back.schema.names == p.schema.names and back.count() == 0
    empty.write.format("arrow_ipc").mode("overwrite").save(f"{tmp_dir}/o")
    assert spark.read.format("arrow_ipc").load(f"{tmp_dir}/o").count() == 0


def test_overwrite_leaves_other_files(spark, tmp_dir):
    import os
    p = people(spark, SF)
    p.write.format("arrow_ipc").mode("overwrite").save(f"{tmp_dir}/d")
    with open(f"{tmp_dir}/d/notes.csv", "w") as f:
        f.write("keep")
    os.rename(f"{tmp_dir}/d/notes.csv", f"{tmp_dir}/d/_notes.csv")
    p.limit(10).write.format("arrow_ipc").mode("overwrite").save(f"{tmp_dir}/d")
    assert spark.read.format("arrow_ipc").load(f"{tmp_dir}/d").count() == 10
    assert os.path.exists(f"{tmp_dir}/d/_notes.csv") and not os.path.exists(f"{tmp_dir}/d/_temporary")


def test_filter_pushdown_matches_spark(spark, tmp_dir):
    p = people(spark, SF)
    p.repartition(2).write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    df = spark.read.format("arrow_ipc").load(tmp_dir)
    conds = ["id > 700", "id <= 3", "Lname = 'F'", "Lname <> 'F'", "Salary IS NULL",
             "TermDate IS NOT NULL", "Fname LIKE '1-%'", "Fname LIKE '%LOW'", "Fname LIKE '%MED%'",
             "id IN (1, 5, 9)", "NOT (id IN (1, 5, 9))", "Salary > 100000 AND Lname = 'O'",
             "StartDate >= DATE'1997-01-01'", "TermDate < TIMESTAMP_NTZ'1998-01-01 00:00:00'",
             "Wage > 100", "Salary <> 5 OR id = 3"]
    for c in conds:
        assert _same(df.where(c), p.where(c)), c
    q = df.where("id > 700 AND Wage > 1")
    plan = q._sc._jvm.PythonSQLUtils.explainString(q._jdf.queryExecution(), "formatted")
    assert "GreaterThan(id,700)" in plan          # pushed; the double filter stays in Spark


def test_nested_and_other_types_roundtrip(spark, tmp_dir):
    import decimal
    schema = T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("m", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("a", T.ArrayType(T.StructType([T.StructField("x", T.LongType()),
                                                     T.StructField("y", T.StringType())]))),
        T.StructField("dec", T.DecimalType(12, 3)),
        T.StructField("bin", T.BinaryType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("f", T.FloatType()),
        T.StructField("s", T.ShortType()),
    ])
    rows = [(1, {"a": 1.5, "b": None}, [(1, "p"), (None, None)], decimal.Decimal("123.456"),
             b"\x00\x01", dt.datetime(2020, 1, 1, 12, 0, 0, 123456), 1.25, 7),
            (2, None, None, None, None, None, None, None),
            (3, {}, [], decimal.Decimal("-0.001"), b"", dt.datetime(1999, 12, 31, 23, 59, 59), -0.5, -3)]
    df = spark.createDataFrame(rows, schema)
    for flavor in ("stream", "file"):
        path = f"{tmp_dir}/{flavor}"
        df.write.format("arrow_ipc").mode("overwrite").option("flavor", flavor).save(path)
        back = spark.read.format("arrow_ipc").load(path)
        assert [f.dataType for f in back.schema.fields] == [f.dataType for f in schema.fields]
        got = sorted(back.collect(), key=lambda r: r["id"])
        want = sorted(df.collect(), key=lambda r: r["id"])
        assert got == want


def test_reader_without_pushdown_when_disabled(spark, tmp_dir):
    p = people(spark, SF)
    p.write.format("arrow_ipc").mode("overwrite").save(tmp_dir)
    key = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(key, "false")
    try:
        df = spark.read.format("arrow_ipc").option("pushFilters", "false").load(tmp_dir).where("id > 700")
        assert _same(df, p.where("id > 700"))
    finally:
        spark.conf.set(key, "true")


def test_unread_columns_are_not_decoded(spark, tmp_dir):
    from tessera.sources.arrow_ipc import filesystem, open_reader
    p = people(spark, SF)
    for flavor in ("stream", "file"):
        path = f"{tmp_dir}/{flavor}"
        p.coalesce(1).write.format("arrow_ipc").mode("append").option("flavor", flavor).save(path)
        file = _files(path, "*.arrow*")[0]
        with open_reader(filesystem(file)[0], file, ["Wage"]) as (kind, r, stored):
            b = r.get_batch(0) if kind == "file" else r.read_next_batch()
            assert kind == flavor and b.schema.names == ["Wage"] and stored == PERSON_COLUMNS
        back = spark.read.format("arrow_ipc").option("columns", "Wage,id").load(path)
        assert back.columns == ["Wage", "id"] and _same(back, p.select("Wage", "id"))


def test_rows_name_their_file_and_batch(spark, tmp_dir):
    p = people(spark, SF)
    for flavor in ("stream", "file"):
        path = f"{tmp_dir}/{flavor}"
        p.coalesce(1).write.format("arrow_ipc").mode("append").options(flavor=flavor, batch="400").save(path)
        df = (spark.read.format("arrow_ipc").options(batchOf="file,batch", columns="id", splitBytes="1", batchesPerSplit="1")
              .load(path))
        assert df.columns == ["id", "file", "batch"]
        sizes = {r["batch"]: r["n"] for r in df.groupBy("file", "batch").agg(F.count("*").alias("n")).collect()}
        assert sizes == {0: 400, 1: 400, 2: 400, 3: 300}
        assert df.where("batch = 3").count() == 300
    with pytest.raises(Exception, match="stored columns"):
        spark.read.format("arrow_ipc").option("batchOf", "id,batch").load(path).schema


def test_columns_of_a_later_append_raise_or_merge(spark, tmp_dir):
    p = people(spark, SF)
    p.select("id").coalesce(1).write.format("arrow_ipc").mode("append").save(tmp_dir + "/d")
    p.select("id", "Wage").coalesce(1).write.format("arrow_ipc").mode("append").save(tmp_dir + "/d")
    with pytest.raises(Exception, match="mergeSchema"):
        spark.read.format("arrow_ipc").load(tmp_dir + "/d").collect()
    assert spark.read.format("arrow_ipc").option("columns", "id").load(tmp_dir + "/d").count() == 3000
    both = spark.read.format("arrow_ipc").option("mergeSchema", "true").load(tmp_dir + "/d")
    assert both.columns == ["id", "Wage"] and both.count() == 3000
    assert both.where("Wage IS NOT NULL").count() == p.where("Wage IS NOT NULL").count()


def test_files_are_bounded_in_bytes(spark, tmp_dir):
    p = people(spark, SF)
    p.coalesce(1).write.format("arrow_ipc").mode("append").options(batch="100", maxBytesPerFile="20000").save(tmp_dir + "/d")
    assert len(_files(tmp_dir + "/d", "*.arrows")) > 2
    assert _same(spark.read.format("arrow_ipc").load(tmp_dir + "/d"), p)


def test_hadoop_paths_as_pyarrow_takes_them():
    from tessera.sources.arrow_ipc import _uri
    assert _uri("s3a://b/k") == _uri("s3n://b/k") == "s3://b/k"
    assert _uri("file:/a b/c%20d") == _uri("file:///a b/c%20d") == "/a b/c%20d"
    assert _uri("/x") == "/x" and _uri("hdfs://n:1/p") == "hdfs://n:1/p"
